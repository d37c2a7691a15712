"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than blank, tab, line feeds, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows of a narrow table (ids, digests) that may be broadcast; it must be counted first.
BROADCAST_ROWS = 1_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a narrow table whose counted size is below the limit; beyond it
    the planner is left to shuffle."""
    return F.broadcast(df) if rows <= limit else df


def never_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Keep the planner from broadcasting either side of a join with a table of
    more counted rows than the limit. It goes by bytes as stored, so it takes a
    packed table, and what an explode makes of one, for much smaller than it is."""
    return df.hint("merge") if rows > limit else df


def quoted(name: str) -> str:
    """A column's name as Spark reads it, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def seeded(seed: str, *parts: Column) -> Column:
    """52 uniform bits that depend on the seed and the parts alone. A null part
    counts as a word of its own."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("<null>")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def parts(batch: pa.RecordBatch, column: int, most: int):
    """Slices of an Arrow batch whose values of one column, texts or lists, have
    some ``most`` bytes together, one row at least."""
    ends = np.asarray(batch.column(column).offsets if pa.types.is_list(batch.column(column).type) else
                      pa.array(np.cumsum([0, *pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()])))
    size = 4 if pa.types.is_list(batch.column(column).type) else 1
    start = 0
    while start < len(batch):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + most // size, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def global_rank(df: DataFrame, order: Column, folder, name: str = "rank") -> DataFrame:
    """Add the position of each row, from 0, in the order of distinct values.

    The rows are dealt by range and numbered inside their part; the parts'
    sizes, one row each, give the offsets. No task sees all rows.
    """
    dealt = folder.write(
        df.withColumn("_order", order).repartitionByRange("_order").withColumn("_part", F.spark_partition_id())
    )
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before")
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_order"))
    return (
        dealt.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before") + within - 1)
        .drop("_part", "_before", "_order")
    )
