"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termledger.llm.common import WORD, global_rank, seeded
from termledger.session import StepFolder

#: Documents that a draw bucket holds on average; only one bucket a source is sorted.
PER_BUCKET = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple, folder) -> DataFrame:
    """Give the sources, by code point and null last, the weights in turn."""
    ordered = global_rank(
        sources, F.struct(F.col("source").isNull().alias("last"), F.col("source").alias("name")), folder
    )
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    return ordered.select("source", turn.cast("double").alias("weight"))


def water_fill(sources: DataFrame, total: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    All sources rise with one level times their weight; those above
    ``max_epochs`` of their size are clamped there, and what they leave is
    shared by the others' weights, until none is above. One round is one
    aggregate over the sources; a clamped source stays clamped, since the level
    only rises. Weights must not be negative.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") > cap
        row = sources.agg(
            F.sum(F.when(above, cap).otherwise(0.0)).alias("given"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("clamped"),
        ).first()
        if row["clamped"] == clamped or not row["weight"]:
            break
        clamped, level = row["clamped"], (total - row["given"]) / row["weight"]
    return sources.withColumn("target", F.when(above, cap).otherwise(F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame,
    weights,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    per_bucket: int = PER_BUCKET,
) -> DataFrame:
    """Decide how often a mix takes each document.

    ``weights`` is a table (source, weight), where a missing source weighs 0,
    or a tuple dealt in turn to the sources by code point. The targets share
    ``share`` of all words. A source whose target is 2.3 times its size takes
    each document twice and three tenths of its words a third time: the
    documents come in an order drawn from the seed, the id and a digest of the
    text, and those before the point nearest to the target are taken, so a source
    misses its target by half a document at most.

    Returns per row of ``docs``: id, source, size, source_size, target, repeats,
    taken. Null texts and empty ones have size 0; a null source is a source of
    its own, the last. Repeated rows are drawn one by one. Other columns are
    left out. Reruns agree.

    Texts are read once, for their sizes. Sums per source and draw bucket
    combine before the shuffle; only the one bucket in which a source's point
    lies is sorted, some ``per_bucket`` documents at every size of the source.
    Rows of one id and text are one line of it with a count, so copies without
    end, also without an id, are one row a task when they meet.
    """
    folder = StepFolder(docs.sparkSession, "mix", keep=True)
    sized = folder.write(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            seeded(seed, F.col(id_col), F.md5(text_col)).alias("draw"),
        )
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = folder.write(sources)
    if isinstance(weights, tuple):
        weights = cyclic_weights(sources.select("source"), weights, folder)
    w = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double"))
    sources = folder.write(
        sources.join(w, F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .fillna(0.0, ["weight"])
    )
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    filled = water_fill(sources, total, max_epochs).select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("whole"),
        F.ceil(F.col("n") / per_bucket).alias("buckets"),
    )
    filled = folder.write(filled.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")))

    bucket = F.floor(F.col("draw") / F.lit(float(2**52)) * F.col("buckets"))
    same = F.col("source").eqNullSafe(F.col("_source"))
    placed = sized.join(filled, same).withColumn("bucket", bucket)
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("part").alias("part"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    edges = sums.withColumn("end", upto).where("end - words <= part and part < end")
    edges = folder.write(
        edges.groupBy("source").agg(
            F.min(F.struct("bucket", (F.col("end") - F.col("words")).alias("before"))).alias("edge")
        ).select(F.col("source").alias("_edge_source"), "edge.*").withColumnRenamed("bucket", "edge")
    )
    points = folder.write(
        filled.join(edges, F.col("_source").eqNullSafe(F.col("_edge_source")), "left").drop("_edge_source")
    )
    placed = sized.join(points, same).withColumn("bucket", bucket)
    # no bucket reaches past the part only if the source has no words, or all are taken
    clear = placed.where("edge is null or bucket != edge").withColumn(
        "more", (F.col("part") > 0) & F.coalesce(F.col("bucket") < F.col("edge"), F.lit(True))
    )
    # rows that are equal in all that is returned stand in the order one by one
    lines = placed.where("bucket = edge").groupBy(
        "id", "source", "size", "draw", "source_size", "target", "whole", "part", "before"
    ).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("source").orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("before") + F.sum(F.col("size") * F.col("n")).over(order) - F.col("size") * F.col("n")
    # a line of very many rows is written out by several tasks
    runs = lines.withColumn("start", start).withColumn(
        "first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(per_bucket).cast("long")))
    ).repartition("source", "draw", "first")
    last = F.least(F.col("n"), F.col("first") + per_bucket - 1)
    edge = runs.withColumn("copy", F.explode(F.sequence("first", last)))
    edge = edge.withColumn(
        "more", (F.col("part") > 0) & (F.col("start") + F.col("copy") * F.col("size") - F.col("size") / 2 <= F.col("part"))
    )
    clear, edge = (
        rows.select("id", "source", "size", "source_size", "target", "whole", "more") for rows in (clear, edge)
    )
    repeats = F.col("whole") + F.col("more").cast("long")
    return clear.unionByName(edge).select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        repeats.alias("repeats"),
        (F.col("size") * repeats).alias("taken"),
    )
