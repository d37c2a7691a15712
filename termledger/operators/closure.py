"""Transitive closure of a directed graph, and lookups in it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termledger.session import StepFolder, remove_at_end, work_dir


def transitive_closure(
    edges: DataFrame, sub: str = "sub_concept_id", super_: str = "super_concept_id"
) -> DataFrame:
    """All (sub, super) pairs joined by a path of one or more edges.

    Path doubling over shortest distances. After a round every pair whose
    shortest path has at most ``reach`` edges is known. A longer shortest path,
    up to twice ``reach``, passes a node at distance exactly ``reach`` from its
    start, so a round joins only that thin layer with the known pairs instead
    of the known pairs with themselves: logarithmic rounds, yet a pair is
    derived once per node of one layer and not once per node of its path.

    The pairs are stored by distance, a folder each, and a layer is read by its
    folder. A round appends the pairs that it is the first to derive and writes
    no other pair again. One aggregation finds those: the minimum over known and
    derived pairs is the shortest distance, beyond ``reach`` for new pairs alone,
    and map-side combining drops repeats before the shuffle. A cycle ends like
    any other graph and leaves (x, x) pairs, which :func:`closure_cycles` reports.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(sub).alias("sub"), F.col(super_).alias("super")).dropna()
    store = LayerStore(spark, "closure", pairs.schema)
    store.append(pairs.distinct().withColumn("distance", F.lit(1)))
    reach = 1
    while True:
        known = store.read()
        layer = known.where(F.col("distance") == reach).select(F.col("sub"), F.col("super").alias("via"))
        derived = layer.join(known.withColumnRenamed("sub", "via"), "via").select(
            "sub", "super", (F.col("distance") + reach).alias("distance")
        )
        shortest = known.unionByName(derived).groupBy("sub", "super").agg(F.min("distance").alias("distance"))
        longest = store.append(shortest.where(F.col("distance") > reach))
        reach *= 2
        # A longer path would start with one of exactly `reach` edges.
        if longest < reach:
            break
    return store.read().select(F.col("sub").alias(sub), F.col("super").alias(super_))


class LayerStore:
    """Pairs in a private folder, partitioned by distance; rounds are appended."""

    def __init__(self, spark: SparkSession, name: str, schema: StructType):
        self._spark, self.schema = spark, schema
        self.path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._new = True

    def append(self, pairs: DataFrame) -> int:
        """Add pairs at new distances; the largest of these, 0 if there is none."""
        seen = Observation()
        found = pairs.observe(seen, F.max("distance").alias("longest"))
        found.write.mode("append").partitionBy("distance").parquet(self.path)
        if self._new:
            remove_at_end(self._spark, self.path)
            self._new = False
        return seen.get["longest"] or 0

    def read(self) -> DataFrame:
        pairs = [f"{f.name} {f.dataType.simpleString()}" for f in self.schema]
        return self._spark.read.schema(", ".join([*pairs, "distance int"])).parquet(self.path)


def ancestors(closure: DataFrame, concept_id: int) -> DataFrame:
    """From the stored closure; a copy sorted by the sub-concept reads some pages."""
    return closure.where(F.col("sub_concept_id") == concept_id).select("super_concept_id")


def descendants(closure: DataFrame, concept_id: int) -> DataFrame:
    """From the stored closure; a copy sorted by the super-concept reads some pages."""
    return closure.where(F.col("super_concept_id") == concept_id).select("sub_concept_id")


def reachable(edges: DataFrame, concept_id: int, start: str, end: str) -> DataFrame:
    """Concepts at the end of a path of one or more edges from a concept, as the
    column ``end``; without a stored closure.

    A frontier moves from the concept, one level a round, so the work follows the
    answer and not the graph. As many rounds as the longest of the shortest paths
    has edges. The concept itself is part of the answer only if it is on a cycle.
    """
    steps = StepFolder(edges.sparkSession, "reachable", keep=True)
    edges = edges.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(start, end)
    frontier = steps.write(edges.where(F.col(start) == concept_id).select(end).distinct())
    found = frontier
    while not frontier.isEmpty():
        here = frontier.withColumnRenamed(end, start)
        beyond = edges.join(here, start, "left_semi").select(end).distinct()
        frontier = steps.write(beyond.join(found, end, "left_anti"))
        found = found.unionByName(frontier)
    return found


def closure_cycles(closure: DataFrame) -> DataFrame:
    """Concepts that are their own ancestor; empty for a sound hierarchy."""
    return closure.where(F.col("sub_concept_id") == F.col("super_concept_id"))


def two_hop_edges(edges: DataFrame) -> DataFrame:
    """Distinct pairs joined by a path of exactly two edges."""
    first = edges.withColumnRenamed("super_concept_id", "via")
    second = edges.withColumnRenamed("sub_concept_id", "via")
    return first.join(second, "via").select("sub_concept_id", "super_concept_id").distinct()
