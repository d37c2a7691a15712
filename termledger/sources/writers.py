"""Tables as Parquet stages, and release files in their printed form."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from termledger.functions.text import rf2_date
from termledger.schemas import Component
from termledger.session import remove
from termledger.sources.readers import HEADER_FILE

# Rows of one part of a printed table at most.
ROWS_PER_FILE = 2_000_000
LINE_END = "\r\n"
# Rows of a page of a sorted table: the least that a lookup in it reads.
PAGE_ROWS = 2_000


def materialize(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> DataFrame:
    """Write a derived table and read it back; a rerun replaces it.

    Histories are partitioned by release date, of which there are few, so that
    the delta of one release reads its own files only. Rows of a date are
    brought together first, else every task would write a file per date; a date
    that holds much of the history is split into files of the advisory size.

    ``sort_by`` orders the rows of each file, of the whole table if it isn't
    partitioned: the files' statistics then let a lookup by the first of these
    columns skip all pages but those that may hold its rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif sort_by:
        df = df.repartitionByRange(*sort_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    _lookup_pages(df.write.mode("overwrite"), sort_by).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize_bucketed(
    df: DataFrame, path: str, key: Sequence[str], buckets: int, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write a table dealt to buckets by its key and sorted in each, and read it
    back; a rerun replaces it.

    Aggregations and joins by the key then read the buckets as they lie: the
    table is shuffled once, when it is written, and not by the releases that
    follow. A partition's rows are spread over the buckets, so a date that holds
    much of the history is not one file. The number of buckets must be at least
    that of the shuffle partitions, or Spark prefers to shuffle.

    Buckets are known to the session's catalog, under a name made of the path.
    """
    spark, name = df.sparkSession, stage_table(path)
    spark.sql(f"drop table if exists {name}")
    remove(spark, path)
    writer = df.repartition(buckets, *key).write.option("path", path)
    _lookup_pages(writer, key).partitionBy(*partition_by).bucketBy(buckets, *key).sortBy(*key).saveAsTable(name)
    return spark.table(name).select(*df.columns)


def replace_bucketed_release(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Add the rows of a release to a bucketed history; other dates stay untouched
    on disk, and a rerun replaces what the failed run left."""
    spark, table = df.sparkSession, df.sparkSession.table(stage_table(path))
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*table.columns).repartition(buckets, *key).write.insertInto(stage_table(path), overwrite=True)
    finally:
        spark.conf.set(mode, before)
    return spark.table(stage_table(path)).select(*df.columns)


def stage_table(path: str) -> str:
    """The catalog's name of the bucketed table at a path."""
    return f"stage_{hashlib.md5(path.encode()).hexdigest()}"


def _lookup_pages(writer: DataFrameWriter, sort_by: Sequence[str]) -> DataFrameWriter:
    return writer.option("parquet.page.row.count.limit", PAGE_ROWS) if sort_by else writer


def replace_release(df: DataFrame, path: str, version: str, sort_by: Sequence[str] = ()) -> None:
    """Add the rows of a release to a date-partitioned history.

    Only the partitions of the dates in ``df`` are written. Older history stays
    untouched on disk, and a rerun replaces what the failed run left. Rows of a
    date are brought together first, and sorted, as in :func:`materialize`.
    """
    df = df.hint("rebalance", version)
    if sort_by:
        df = df.sortWithinPartitions(version, *sort_by)
    (
        _lookup_pages(df.write.mode("overwrite"), sort_by)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(version)
        .parquet(path)
    )


def to_rf2(df: DataFrame, component: Component) -> DataFrame:
    """Columns in printed order under their printed names, dates as digits."""
    return df.select(
        *[
            (rf2_date(F.col(field.name)) if isinstance(field.dataType, DateType) else F.col(field.name))
            .alias(printed)
            for field, printed in zip(component.schema.fields, component.header, strict=True)
        ]
    )


def write_rf2(
    df: DataFrame, path: str, component: Component, rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Print a table in its order: header, tabs, CRLF, every field as it is.

    The result has one form at every size: a folder ``path`` that holds the
    header in ``_header`` and the lines in ordered parts of ``rows_per_file`` rows
    at most. Joined in name order, its files are the release file byte for byte;
    an empty table is its header. :func:`read_rf2` reads the folder as it reads a
    file. The table is dealt by ranges of the print order, so no task sorts all of
    it. The id breaks ties, which makes the output the same on every run.

    Lines are written as text because a CSV writer would quote a field that
    holds a carriage return. Rows are counted while they are written. Returns
    their number.
    """
    order = list(dict.fromkeys([*component.order, component.id_column]))
    written = Observation()
    printed = to_rf2(df.orderBy(*order).observe(written, F.count(F.lit(1)).alias("rows")), component)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in printed.columns]
    lines = printed.select(F.concat_ws("\t", *fields).alias("value"))
    staged = f"{path}.staged"
    (
        lines.write.mode("overwrite")
        .option("lineSep", LINE_END)
        .option("maxRecordsPerFile", rows_per_file)
        .text(staged)
    )
    _publish(df.sparkSession, staged, path, "\t".join(component.header) + LINE_END)
    return written.get["rows"]


def _publish(spark: SparkSession, staged: str, path: str, header: str) -> None:
    """Complete the written folder and give it the final name. What had that name
    is moved aside and deleted last, so a failure loses no release."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    source, target, aside = Path(staged), Path(path), Path(f"{path}.previous")
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(Path(source, HEADER_FILE))
    out.write(bytearray(header.encode()))
    out.close()
    if files.exists(target):
        files.delete(aside, True)
        _rename(files, target, aside)
    _rename(files, source, target)
    files.delete(aside, True)


def _rename(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")
