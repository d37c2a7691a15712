"""From raw documents to placed training documents, in written stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termledger.llm import decontaminate, mixing, sharding, simhash, toxicity
from termledger.llm.common import broadcast_if_small, load, quoted
from termledger.llm.queries import MIX_WEIGHTS, SHARDS
from termledger.session import StepFolder

# Each stage takes a row as one struct, so no column of the documents can clash
# with a helper column. Rows are told apart by their id and text, in one digest.


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, key, doc_id, text): the key is a digest of id and text, nulls apart
    from all values."""
    part = lambda c: F.concat(F.col(c).isNull().cast("string"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    key = F.md5(F.concat_ws("|", part("doc_id"), part("text")))
    return docs.select(F.struct("*").alias("row"), key.alias("key"), "doc_id", "text")


def _among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    return rows.join(broadcast_if_small(keys, keys.count()), "key", how)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject. The model learns from
    all labels of the documents. A row without an id is judged by its text too."""
    folder = StepFolder(spark, "pipeline-toxicity", keep=True)
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    keyed = _keyed(docs)
    gone = toxicity.score(keyed.select("key", "text"), model, id_col="key").where("predicted = 1")
    return _among(keyed, folder.write(gone.select("key").distinct()), "left_anti").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one of the smallest id;
    rows without an id come last. Groups are the components of the SimHash
    operator, with its own shingle length and bit distance."""
    folder = StepFolder(spark, "pipeline-dedup", keep=True)
    keyed = _keyed(docs)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    found = simhash.near_duplicates(keyed.select(place.alias("place"), "text"), id_col="place")
    found = folder.write(found.groupBy("place", "component_id").count())
    gone = folder.write(found.where("place != component_id").select("place.key"))
    again = folder.write(found.where("place = component_id and count > 1").select("place.key"))
    kept = _among(keyed, gone, "left_anti")
    if again.isEmpty():
        return kept.select("row.*")
    # rows that repeat an id and its text: one stands for all
    one = _among(kept, again, "left_semi").dropDuplicates(["key"])
    return _among(kept, again, "left_anti").unionByName(one).select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    folder = StepFolder(spark, "pipeline-benchmark", keep=True)
    keyed = _keyed(docs)
    found = decontaminate.contaminated(keyed.select("key", "text"), load(spark, sf_dir, "benchmark"), id_col="key")
    return _among(keyed, folder.write(found.select("key").distinct()), "left_anti").select("row.*")


def _whole_row(docs: DataFrame) -> Column:
    """A digest of all columns, of maps by their entries in order."""
    named = [(F.col(quoted(c)), kind) for c, kind in docs.dtypes]
    parts = [
        F.sort_array(F.transform(F.map_entries(c), lambda e: F.to_json(e))) if kind.startswith("map<") else c
        for c, kind in named
    ]
    return F.md5(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it. Rows are drawn by a digest of all
    their columns, so rows that share an id, or have none, are drawn apart."""
    folder = StepFolder(spark, "pipeline-mix", keep=True)
    keyed = docs.select(F.struct("*").alias("row"), _whole_row(docs).alias("key"), "text", "source")
    taken = mixing.mix(keyed.select("key", "text", "source"), MIX_WEIGHTS, id_col="key").groupBy("key").agg(
        F.sum("repeats").alias("repeats"), F.count(F.lit(1)).alias("rows")
    )
    taken = folder.write(taken.where("repeats > 0"))
    again = taken.where("rows > 1").select("key", "repeats")
    once = taken.where("rows = 1").select("key", "repeats")

    def repeated(keys: DataFrame, merge: bool) -> DataFrame:
        rows = _among(keyed.select("row", "key"), keys, "inner")
        # rows of one key are the same in every column: one stands for all
        rows = rows.dropDuplicates(["key"]) if merge else rows
        copies = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))
        return rows.select("row", copies.alias("copy")).select("row.*")

    out = repeated(once, False)
    return out if again.isEmpty() else out.unionByName(repeated(again, True))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard each goes to."""
    return sharding.place(docs, SHARDS)


STAGES = [
    ("toxicity", not_toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The classifier of the first stage can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and
    read again."""
    docs = load(spark, sf_dir, "documents")
    folder = StepFolder(spark, "pipeline", keep=True)
    for _, stage in STAGES:
        docs = folder.write(stage(spark, docs, sf_dir))
    return docs
