"""Checks and profiles of identifier columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termledger.functions.check_digit import check_digit, check_remainder

# Shortest identifier that carries a namespace.
NAMESPACED_LENGTH = 10


def invalid_ids(df: DataFrame, column: str) -> DataFrame:
    """Rows whose identifier is missing, no bigint, or fails its check digit."""
    return df.where(~check_remainder(F.col(column)).eqNullSafe(F.lit(0)))


def add_check_digit(df: DataFrame, column: str, name: str) -> DataFrame:
    """Append the check digit that completes the identifier body in a column."""
    return df.withColumn(name, check_digit(F.col(column)))


def id_profile(df: DataFrame, column: str, *extra: str) -> DataFrame:
    """Distinct (namespace, partition, check result) of an identifier column.

    The namespace is seven digits ending three before the last, the partition
    the two before the last. Shorter identifiers have no namespace.
    """
    text = F.col(column).cast("string")
    size = F.length(text)
    long_enough = size >= NAMESPACED_LENGTH
    return df.select(
        F.when(long_enough, F.substring(text, size - 9, F.lit(7))).alias("namespace_id"),
        F.when(size >= 3, F.substring(text, size - 2, F.lit(2))).alias("partition_id"),
        *extra,
        check_remainder(F.col(column)).alias("check_digit"),
    ).distinct()
