"""Readers for release files and comma-separated inputs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

# Position of a line: number of its path, file, start of its block, rank in the block.
LINE = "_line"
# Holds the header of a printed table; Spark's readers pass over its name.
HEADER_FILE = "_header"

# Columns beside those of the schema: what is wrong with a line, and the line itself.
REASON, TEXT = "_reason", "_text"
# What an empty day is printed as; it reads as null.
ZERO_DATE = "00000000"


@dataclass(frozen=True)
class Lines:
    """The lines of some files. Each is a row of the schema or a reject, whose
    reason names the columns that can't be read, or ``fields`` if the line has
    too few or too many of them."""

    parsed: DataFrame
    columns: tuple[str, ...]
    with_line: bool = False

    @property
    def rows(self) -> DataFrame:
        """The readable lines."""
        return self._picked(self.parsed.where(F.col(REASON).isNull()))

    @property
    def strict(self) -> DataFrame:
        """All lines as rows; one that can't be read ends the job that meets it."""
        where = F.concat_ws(": ", F.lit("unreadable line"), f"{LINE}.path", REASON, TEXT)
        sound = F.when(F.col(REASON).isNotNull(), F.raise_error(where).cast("boolean")).otherwise(F.lit(True))
        return self._picked(self.parsed.where(sound))

    def counted(self, observation) -> DataFrame:
        """The readable lines; while they are read, ``observation`` counts all
        ``lines`` and the ``rejects``."""
        seen = self.parsed.observe(
            observation, F.count(F.lit(1)).alias("lines"), F.count(REASON).alias("rejects")
        )
        return replace(self, parsed=seen).rows

    @property
    def has_rejects(self) -> bool:
        return not self.parsed.where(F.col(REASON).isNotNull()).isEmpty()

    def refuse(self, reason: str, bad: Column) -> Lines:
        """Also reject the readable lines for which a condition holds."""
        named = F.when(F.col(REASON).isNull() & F.coalesce(bad, F.lit(False)), F.lit(reason))
        return replace(self, parsed=self.parsed.withColumn(REASON, F.coalesce(named, REASON)))

    @property
    def rejects(self) -> DataFrame:
        """(file, line, reason, text): the lines that are no rows, by their number
        in the file, the header included and empty lines left out.

        A line's number is the lines of the earlier blocks of its file and its
        rank in its own, so files are split as ever. A line of a file with quotes
        is given as an equal record, if its number of fields is right.
        """
        at = F.col(LINE)
        placed = self.parsed.select(
            at["path"].alias("file"), at["block"].alias("block"), at["rank"].alias("rank"), at["header"].alias("header"),
            REASON, F.col(TEXT).alias("text"),
        )
        blocks = placed.groupBy("file", "block").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
        blocks = blocks.withColumn("before", before).drop("n")
        number = F.col("header") + F.col("before") + F.col("rank") - F.col("first") + 1
        bad = placed.where(F.col(REASON).isNotNull())
        return bad.join(blocks, ["file", "block"]).select(
            "file", number.alias("line"), F.col(REASON).alias("reason"), "text"
        )

    def _picked(self, rows: DataFrame) -> DataFrame:
        position = [F.struct(*[f"{LINE}.{f}" for f in ("file", "path", "block", "rank")]).alias(LINE)]
        return rows.select(*self.columns, *(position if self.with_line else []))


def scan_rf2(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    columns: Sequence[str] | None = None,
    with_line: bool = False,
) -> Lines:
    """Tab-separated, CRLF, one header line, columns bound by position.

    Nothing is a quote or an escape. The explicit line separator keeps a lone
    carriage return inside its field and leaves the file splittable. ``columns``
    picks columns by name; ``with_line`` adds the position of each line, which
    orders rows as the files do. A folder printed by ``write_rf2`` keeps its header
    in a file of its own, so its parts are read whole.

    Empty fields are readable, and a zero date is null; checks report either
    where a value must be. All other fields must be of their column's type.
    """
    options = {"sep": "\t", "header": True, "quote": "\u0000", "escape": "\u0000"}
    return _scan(spark, paths, schema, options, columns, with_line)


def scan_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    header: bool = False,
    columns: Sequence[str] | None = None,
    with_line: bool = False,
) -> Lines:
    """Comma-separated with optional double quotes, CRLF, with or without header."""
    options = {"sep": ",", "header": header, "quote": '"', "escape": '"'}
    return _scan(spark, paths, schema, options, columns, with_line)


def read_rf2(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    columns: Sequence[str] | None = None,
    with_line: bool = False,
) -> DataFrame:
    """The rows of :func:`scan_rf2`; a line that can't be read is an error."""
    return scan_rf2(spark, paths, schema, columns, with_line).strict


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    header: bool = False,
    columns: Sequence[str] | None = None,
    with_line: bool = False,
) -> DataFrame:
    """The rows of :func:`scan_delimited`; a line that can't be read is an error."""
    return scan_delimited(spark, paths, schema, header, columns, with_line).strict


def _scan(spark, paths, schema, options, columns, with_line) -> Lines:
    """Plain files are one scan, and so are the printed folders among the paths."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if len(set(paths)) < len(paths):
        raise ValueError("name each file once")
    texts = StructType([StructField(f.name, StringType()) for f in schema] + [StructField(TEXT, StringType())])

    def scan(numbered: list[tuple[int, str]], header: bool) -> DataFrame:
        lines = (
            spark.read.schema(texts)
            .options(**options)
            # a line is judged by all its fields, whatever columns are picked
            .options(enforceSchema=True, lineSep="\r\n", header=header, columnNameOfCorruptRecord=TEXT, columnPruning=False)
            .csv([path for _, path in numbered])
        )
        position = F.struct(
            _path_number(spark, numbered).alias("file"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("rank"),
            F.lit(int(header)).alias("header"),
        )
        return lines.select(*texts.fieldNames(), position.alias(LINE))

    numbered = list(enumerate(paths))
    printed = [(n, path) for n, path in numbered if _is_printed(spark, path)]
    plain = [at for at in numbered if at not in printed]
    scans = [scan(*kind) for kind in ((plain, options["header"]), (printed, False)) if kind[0]]
    lines = reduce(DataFrame.unionByName, scans)
    parsed = lines.select(
        *[_typed(field) for field in schema], _reason(schema).alias(REASON), _record(schema, options).alias(TEXT), LINE
    )
    return Lines(parsed, tuple(columns or schema.fieldNames()), with_line)


def _path_number(spark: SparkSession, numbered: Sequence[tuple[int, str]]) -> Column:
    """The number of the path that a line's file was read by: files are looked up
    in a literal map, folders and patterns by what they begin with."""
    at = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    files, folders = [], []
    for number, path in numbered:
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.globStatus(hadoop_path) or []:
            place = status.getPath().toString().replace("file:///", "file:/")
            (folders if status.isDirectory() else files).append((place, number))
    known = F.lit(None).cast("int")
    for place, number in sorted(folders, key=lambda f: len(f[0])):
        known = F.when(at.startswith(f"{place}/"), F.lit(number)).otherwise(known)
    if files:
        found = F.create_map(*[F.lit(x) for pair in files for x in pair])
        known = F.coalesce(F.try_element_at(found, at), known)
    return known


def _is_printed(spark: SparkSession, path: str) -> bool:
    header = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{HEADER_FILE}")
    return header.getFileSystem(spark._jsc.hadoopConfiguration()).exists(header)


def _value(field: StructField) -> Column:
    """A field's text in its column's type, null if it can't be read."""
    text = F.col(field.name)
    if isinstance(field.dataType, DateType):
        return F.try_to_date(text, "yyyyMMdd")
    return text.try_cast(field.dataType)


def _typed(field: StructField) -> Column:
    """An absent text is empty, as a text load has no nulls; code columns lose
    the blanks that pad them."""
    if not isinstance(field.dataType, StringType):
        return _value(field).alias(field.name)
    column = F.rtrim(F.col(field.name)) if field.metadata.get("char") else F.col(field.name)
    return F.coalesce(column, F.lit("")).alias(field.name)


def _reason(schema: StructType) -> Column:
    """What is wrong with a line, null if nothing is."""
    unread = []
    for field in schema:
        if not isinstance(field.dataType, StringType):
            bad = (F.trim(field.name) != "") & (F.col(field.name) != ZERO_DATE) & _value(field).isNull()
            unread.append(F.when(bad, F.lit(field.name)))
    columns = F.nullif(F.concat_ws(", ", *unread), F.lit("")) if unread else F.lit(None).cast("string")
    return F.when(F.col(TEXT).isNotNull(), F.lit("fields")).otherwise(columns)


def _record(schema: StructType, options: dict) -> Column:
    """The line as the file has it: Spark keeps those whose fields don't fit the
    columns, the others are made again from their fields."""
    if options["quote"] == "\u0000":
        fields = F.concat_ws(options["sep"], *[F.coalesce(F.col(name), F.lit("")) for name in schema.fieldNames()])
    else:
        fields = F.to_csv(F.struct(*schema.fieldNames()), {k: options[k] for k in ("sep", "quote", "escape")})
    return F.coalesce(F.col(TEXT), fields)
