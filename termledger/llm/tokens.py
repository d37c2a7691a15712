"""Token counts with a cache of digests."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from importlib.metadata import version
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termledger.llm.common import BROADCAST_ROWS, broadcast_if_small
from termledger.session import StepFolder


class Tokenizer:
    """A vocabulary file with the library that reads it. The file's bytes travel
    with the tasks, so executors need not see its path."""

    def __init__(self, path: str):
        self.data = Path(path).read_bytes()
        self.library = "sentencepiece" if path.endswith(".model") else "tokenizers"
        self.version = hashlib.sha256(
            self.data + f"|{self.library}|{version(self.library)}".encode()
        ).hexdigest()[:32]


@lru_cache(maxsize=2)
def _counter(library: str, data: bytes):
    if library == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda text: len(model.encode(text))
    import tokenizers

    model = tokenizers.Tokenizer.from_buffer(data)
    model.no_truncation()
    model.no_padding()
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


def encode(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(digest, n_tokens) for rows (digest, text), one text at a time."""
    library, data = tokenizer.library, tokenizer.data

    def run(batches):
        count = _counter(library, data)
        for batch in batches:
            counts = [count(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens bigint")


def _cached(spark: SparkSession, path: str) -> DataFrame:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    schema = "digest binary, n_tokens bigint"
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    # two runs at a time may both have stored a digest
    return spark.read.schema(schema).parquet(path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    tokenizer: Tokenizer,
    cache: str,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, n_bytes, n_tokens, over_limit.

    ``cache`` is a shared folder with one part per tokenizer version. Contents
    (a null text is the empty one) meet it by SHA-256 digest; of those it
    lacks, each is encoded once, however many rows repeat it, and appended.
    Null and repeated ids and rows are fine; other columns are left out.

    Only ids and digests are shuffled. The rows to encode are picked by a
    broadcast of the rows to skip, or of those to encode, if either is counted
    to be small, and by a shuffled join beyond that.
    """
    spark = docs.sparkSession
    folder = StepFolder(spark, "tokens", keep=True)
    store = f"{cache.rstrip('/')}/version={tokenizer.version}"
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text")
    )
    known = folder.write(rows.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes")))

    # of a digest's rows the one to encode, one that no other row equals if there is any
    rows_of = known.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n"))
    chosen = rows_of.groupBy("digest").agg(F.min(F.struct("n", "id")).alias("row"))
    stored = _cached(spark, store).select("digest")
    wanted = folder.write(chosen.join(stored, "digest", "left_anti").select("digest", "row.*"))
    keys = wanted.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "n")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    once, repeated = keys.where("n = 1").drop("n"), keys.where("n > 1").drop("n")
    skipped = folder.write(rows_of.select("id", "digest").join(once, same, "left_anti").toDF("_id", "_digest"))
    n_once, n_repeated, n_skipped = once.count(), repeated.count(), skipped.count()
    if n_once:
        if n_skipped <= min(n_once, BROADCAST_ROWS):
            misses = rows.join(F.broadcast(skipped), same, "left_anti")
        else:
            misses = rows.join(broadcast_if_small(once, n_once), same, "left_semi")
        encode(misses, tokenizer).write.mode("append").parquet(store)
    if n_repeated:
        copies = rows.join(broadcast_if_small(repeated, n_repeated), same, "left_semi")
        one = copies.groupBy("digest").agg(F.first("text").alias("text"))
        encode(one, tokenizer).write.mode("append").parquet(store)
    return known.join(_cached(spark, store), "digest").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
