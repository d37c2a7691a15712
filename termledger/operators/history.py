"""Versioned tables: snapshot, delta, roll-forward and member identity.

A history ("Full" table) holds one row per (id, version). All operators are
generic over the id, the key an id stands for, and the values a member carries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termledger.functions.text import member_uuid

VERSION = "effective_date"
MODULE = "module_id"

# Classes of a key when a history meets the target set of a new release.
INACTIVATED = "inactivated"
ADDED = "added"
UPDATED = "updated"
UNCHANGED = "unchanged"
CHANGES = (INACTIVATED, ADDED, UPDATED)


def snapshot(full: DataFrame, id_cols: Sequence[str], version: str = VERSION) -> DataFrame:
    """Latest row of every id, inactive ones included.

    One aggregation replaces the usual maximum-and-rejoin. Columns that never
    change for an id (its key) belong in ``id_cols``: then only flags, numbers
    and dates are aggregated and the plan is a hash aggregate with map-side
    combining, whatever the number of versions of one id. (id, version) must be
    unique; check with ``duplicates``.
    """
    payload = [c for c in full.columns if c not in {*id_cols, version}]
    latest = full.groupBy(*id_cols).agg(
        F.max(version).alias(version), *[F.max_by(c, version).alias(c) for c in payload]
    )
    return latest.select(*full.columns)


def snapshot_asof(
    full: DataFrame, id_cols: Sequence[str], day: dt.date, version: str = VERSION
) -> DataFrame:
    """Snapshot of the versions up to a day."""
    return snapshot(full.where(F.col(version) <= F.lit(day)), id_cols, version)


def latest_version(full: DataFrame, keys: Sequence[str], version: str = VERSION) -> DataFrame:
    return full.groupBy(*keys).agg(F.max(version).alias(version))


def delta(full: DataFrame, release: dt.date, version: str = VERSION) -> DataFrame:
    """Rows of one release; a date-partitioned history reads one partition."""
    return full.where(F.col(version) == F.lit(release))


def assign_member_ids(
    df: DataFrame, key_cols: Sequence[str], id_col: str = "member_id"
) -> DataFrame:
    """Give every row the id that belongs to its key."""
    return df.withColumn(id_col, member_uuid(*[F.col(c) for c in key_cols]))


def compare(
    full: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    values: Sequence[str] = (),
    id_col: str = "member_id",
    supplied_id: bool = False,
    version: str = VERSION,
    colocated: bool = False,
) -> DataFrame:
    """Meet a history with the active set a new release should have.

    One full outer join of the snapshot with the target replaces the set
    differences and the intersection. Each side is dealt by the key once, and
    a history that is stored so, ``colocated``, not at all. The snapshot groups
    by the key and the id it stands for, where the rows lie: its buffers are
    flags, numbers and dates, so it is a hash aggregate, and it arrives at the
    join partitioned. A key has one row a release at most, and both sides hold a
    key once when they meet, so no key can be frequent. Name the most selective
    key column first: the sorts compare it first. A stored snapshot may stand in
    for the history; it has the same latest versions.

    Returns one row per key: ``change``, the id, the version it had, and for
    ``active`` and each value the state after the release. A member is

    * ``inactivated`` when it is active and not in the target (keeps its values),
    * ``added`` when its key was never seen; the id is the one the target
      supplies or, by default, follows from the key,
    * ``updated`` when it was inactive or a value differs (keeps its id),
    * ``unchanged`` otherwise.

    The module of the history, if it has one, goes along for the snapshot.

    Keys must be non-null and stand for one id, the target must hold a key
    once; ``nulls``, ``fd_violations`` and ``duplicates`` check that.
    """
    key, values = list(key), list(values)
    module = [MODULE] if MODULE in full.columns else []
    rows = full.select(id_col, version, "active", *key, *values, *module)
    before = snapshot(rows if colocated else rows.repartition(*key), [*key, id_col], version)
    after = target.select(
        *key,
        F.lit(True).alias("_wanted"),
        *[F.col(v).alias(f"_new_{v}") for v in [*values, *([id_col] if supplied_id else [])]],
    )
    met = before.withColumnRenamed("active", "_active").join(after, key, "full")

    known, wanted = F.col(id_col).isNotNull(), F.col("_wanted").isNotNull()
    was_active = F.col("_active") != 0
    same_values = F.lit(True)
    for value in values:
        same_values = same_values & F.col(value).eqNullSafe(F.col(f"_new_{value}"))
    change = (
        F.when(~known, ADDED)
        .when(~wanted, F.when(was_active, INACTIVATED).otherwise(UNCHANGED))
        .when(was_active & same_values, UNCHANGED)
        .otherwise(UPDATED)
    )
    new_id = F.col(f"_new_{id_col}") if supplied_id else member_uuid(*[F.col(c) for c in key])
    return met.select(
        change.alias("change"),
        F.when(known, F.col(id_col)).otherwise(new_id).alias(id_col),
        version,
        F.when(wanted, 1).otherwise(0).alias("active"),
        *key,
        *[F.when(wanted, F.col(f"_new_{v}")).otherwise(F.col(v)).alias(v) for v in values],
        *module,
    )


def release_rows(
    compared: DataFrame,
    release: dt.date,
    module_id: int,
    changes: Sequence[str] = CHANGES,
    version: str = VERSION,
) -> DataFrame:
    """History rows a release appends, optionally of some change classes."""
    id_col = compared.columns[1]
    rest = [c for c in compared.columns if c not in {"change", id_col, version, "active", MODULE}]
    return compared.where(F.col("change").isin(*changes)).select(
        id_col,
        F.lit(release).alias(version),
        "active",
        F.lit(module_id).alias(MODULE),
        *rest,
    )


def release_snapshot(
    compared: DataFrame, release: dt.date, module_id: int | None = None, version: str = VERSION
) -> DataFrame:
    """Snapshot after the release, from the same single pass. Unchanged members
    keep their version and module, the others have the release's."""
    same = F.col("change") == UNCHANGED
    stamped = compared.withColumn(version, F.when(same, F.col(version)).otherwise(F.lit(release)))
    if MODULE in compared.columns:
        stamped = stamped.withColumn(MODULE, F.when(same, F.col(MODULE)).otherwise(F.lit(module_id)))
    return stamped.drop("change")


def roll_forward(
    full: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    values: Sequence[str] = (),
    *,
    release: dt.date,
    module_id: int,
    id_col: str = "member_id",
    supplied_id: bool = False,
) -> DataFrame:
    """Rows to append to a history so that its active set becomes the target."""
    compared = compare(full, target, key, values, id_col, supplied_id)
    return release_rows(compared, release, module_id)


def changed(active: Column, old: Column, new: Column) -> Column:
    """A member needs a new row: it is inactive or its value differs."""
    return (active == 0) | ~old.eqNullSafe(new)


def carry_forward(
    dependencies: DataFrame, previous: dt.date, release: dt.date, target: dt.date
) -> DataFrame:
    """Rows of the previous release again, under the same ids, for a new one."""
    return dependencies.where(F.col(VERSION) == F.lit(previous)).withColumns(
        {
            VERSION: F.lit(release),
            "active": F.lit(1),
            "source_effective_date": F.lit(release),
            "target_effective_date": F.lit(target),
        }
    )


def component_history(full: DataFrame, order_by: Sequence[str] = (VERSION, "active"), **where) -> DataFrame:
    """All versions of one component, oldest first."""
    for column, value in where.items():
        full = full.where(F.col(column) == value)
    return full.orderBy(*order_by)
