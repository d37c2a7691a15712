"""Checks as queries that return the violating rows; no rows means pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termledger import constants as K
from termledger.operators.history import VERSION, delta
from termledger.operators.relational import anti_join, count_by, enrich, semi_join
from termledger.session import StepFolder


def duplicates(df: DataFrame, keys: Sequence[str], nulls_equal: bool = True) -> DataFrame:
    """Keys that occur more than once. A unique constraint, unlike a primary
    key, lets null keys repeat: ``nulls_equal=False``."""
    rows = df if nulls_equal else df.dropna(subset=list(keys))
    return count_by(rows, keys).where("n > 1")


def orphans(
    child: DataFrame,
    parent: DataFrame,
    keys: Sequence[str],
    parent_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Child rows whose key, if complete, is not in the parent.

    The child is reduced to its distinct keys before any shuffle, so neither
    its width nor a key that many rows share matters. The missing keys, mostly
    none, are written; their file size then tells the planner whether they can
    be broadcast to the child or must be shuffled with it.
    """
    keys = list(keys)
    named = dict(zip(parent_keys or keys, keys, strict=True))
    referenced = parent.select(*[F.col(p).alias(c) for p, c in named.items()])
    complete = child.dropna(subset=keys)
    missing = anti_join(complete.select(*keys).distinct(), referenced, keys)
    written = StepFolder(child.sparkSession, "orphans").write(missing)
    return semi_join(complete, written, keys)


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that break a check; as in SQL, an unknown result passes."""
    return df.where(~predicate)


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in a column that must have a value."""
    return df.where(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def too_long(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Rows with a text that is longer, in characters, than its declared width."""
    return df.where(reduce(Column.__or__, [F.char_length(c) > n for c, n in widths.items()], F.lit(False)))


@dataclass(frozen=True)
class Constraints:
    """What a table declares of its rows, each under the name of its check.

    ``keys`` are primary keys, in which nulls are equal; a null in a ``unique``
    key repeats nothing. ``checks`` are predicates, of which an unknown result
    passes. ``widths`` are in characters. ``row`` names a row in the result.
    """

    row: Sequence[str]
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    not_null: Sequence[str] = ()
    widths: Mapping[str, int] = field(default_factory=dict)
    checks: Mapping[str, Column] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [*self.keys, *self.unique, *["nulls"] * bool(self.not_null), *["width"] * bool(self.widths), *self.checks]


def broken(df: DataFrame, declared: Constraints) -> DataFrame:
    """(check, key, n): all constraints of a table in one scan.

    A row becomes one entry per key and one per check that it breaks, tagged
    with the check's name. One aggregation over the entries, combined before the
    only shuffle, counts them; what is left are keys that repeat, and the rows,
    by the columns that name them, which break a check. A frequent key is one
    entry a task when it is shuffled.
    """
    def entry(name: str, columns: Sequence[str], is_key: bool) -> Column:
        key = F.array(*[F.col(c).cast("string") for c in columns])
        return F.struct(F.lit(name).alias("check"), key.alias("key"), F.lit(is_key).alias("is_key"))

    def row(name: str, bad: Column) -> Column:
        return F.when(bad, entry(name, declared.row, False))

    either = lambda conditions: reduce(Column.__or__, conditions)
    entries = [entry(name, columns, True) for name, columns in declared.keys.items()]
    for name, columns in declared.unique.items():
        entries.append(F.when(~either([F.col(c).isNull() for c in columns]), entry(name, columns, True)))
    if declared.not_null:
        entries.append(row("nulls", either([F.col(c).isNull() for c in declared.not_null])))
    if declared.widths:
        entries.append(row("width", either([F.char_length(c) > n for c, n in declared.widths.items()])))
    entries += [row(name, ~predicate) for name, predicate in declared.checks.items()]
    tagged = df.select(F.explode(F.array_compact(F.array(*entries))).alias("entry")).select("entry.*")
    counted = tagged.groupBy("check", "key", "is_key").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(~F.col("is_key") | (F.col("n") > 1)).drop("is_key")


class Checks(Mapping[str, DataFrame]):
    """Checks by name, each a table of violations that is planned when it is
    asked for: to build the checks starts no job, and one that is never asked for
    costs nothing. Declared constraints of a table share one scan in ``counts``."""

    def __init__(self):
        self._steps: dict[str, Callable[[], DataFrame]] = {}
        self._declared: dict[str, tuple[DataFrame, Constraints]] = {}
        self._built: dict[str, DataFrame] = {}

    def add(self, name: str, step: Callable[[], DataFrame]) -> None:
        self._steps[name] = step

    def declare(self, table: str, df: DataFrame, declared: Constraints) -> None:
        """The constraints of a table, as the checks ``table constraint``."""
        if not declared.names:
            return
        self._declared[table] = (df, declared)
        for name in declared.names:
            self.add(f"{table} {name}", lambda name=name: self.broken(table).where(F.col("check") == name))

    def broken(self, table: str) -> DataFrame:
        """All violations of a table's declared constraints, from one scan."""
        return broken(*self._declared[table])

    def counts(self) -> DataFrame:
        """(name, n) for every check: repeated keys, or violating rows. What a
        table declares takes one scan of it."""
        parts = []
        for table, (_, declared) in self._declared.items():
            keys = [*declared.keys, *declared.unique]
            n = F.when(F.col("check").isin(keys), 1).otherwise(F.col("n"))
            named = [F.sum(F.when(F.col("check") == c, n).otherwise(0)).alias(c) for c in declared.names]
            counted = self.broken(table).agg(*named).unpivot([], declared.names, "name", "n")
            parts.append(counted.select(F.concat_ws(" ", F.lit(table), "name").alias("name"), F.coalesce("n", F.lit(0)).alias("n")))
        declared = {f"{table} {name}" for table, (_, own) in self._declared.items() for name in own.names}
        others = {name: self[name] for name in self if name not in declared}
        return reduce(DataFrame.unionByName, [*parts, *([check_counts(others)] if others else [])])

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._steps[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._steps)

    def __len__(self) -> int:
        return len(self._steps)


def fd_violations(df: DataFrame, lhs: Sequence[str], rhs: Sequence[str]) -> DataFrame:
    """Left values that stand for more than one right value.

    Distinct pairs are built first, so a left value with many rows is spread
    over tasks by its right values.
    """
    return count_by(df.select(*lhs, *rhs).distinct(), lhs).where("n > 1")


def not_in(sub: DataFrame, sup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a set that should be within another and are not."""
    return anti_join(sub, sup, keys)


def date_profile(df: DataFrame) -> DataFrame:
    """Rows per refset and date; a missing date shows as null."""
    return count_by(df, ["refset_id", VERSION])


def inactive_references(
    members: DataFrame, active_concepts: DataFrame, key: str = "concept_id"
) -> DataFrame:
    """Members on concepts that are not active."""
    return orphans(members, active_concepts, [key])


def active_counts(snapshot: DataFrame) -> DataFrame:
    """Active members per refset."""
    return count_by(snapshot.where(F.col("active") == 1), ["refset_id"])


def release_change_counts(full: DataFrame, release: dt.date) -> DataFrame:
    """Members activated and inactivated by a release, per refset."""
    return count_by(delta(full, release), ["refset_id", "active"])


def must_be_active(
    ids: DataFrame, members: DataFrame, key: str, strict: bool = True
) -> DataFrame:
    """Ids whose member is not active. The strict form also reports ids that
    have no member at all, which a plain inequality lets pass."""
    inactive = F.col("active") != 1
    if strict:
        inactive = F.col("active").isNull() | inactive
    return enrich(ids.select(key), members, [key]).where(inactive)


def preferred_cardinality(members: DataFrame) -> DataFrame:
    """Preferred members per refset, next to their distinct descriptions."""
    preferred = members.where((F.col("active") == 1) & (F.col("acceptability_id") == K.PREFERRED))
    return preferred.groupBy("refset_id").agg(
        F.count(F.lit(1)).alias("n_members"),
        F.count_distinct("description_id").alias("n_descriptions"),
    )


def preferred_per_concept(members: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(refset, concept) pairs with more than one preferred term among the
    given descriptions. Full names are preferred too, so leave them out."""
    preferred = members.where((F.col("active") == 1) & (F.col("acceptability_id") == K.PREFERRED))
    named = preferred.join(descriptions.select("description_id", "concept_id"), "description_id")
    return count_by(named, ["refset_id", "concept_id"]).where("n > 1")


def reconcile(source: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Counts that must agree: source rows, those with an active member, those
    without, and the active members. The source meets the members once."""
    active = members.where(F.col("active") == 1)
    hits = active.select(key).distinct().withColumn("hit", F.lit(True))
    met = source.join(hits, key, "left").agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count("hit").alias("present"),
        F.count_if(F.col("hit").isNull()).alias("missing"),
    )
    names = ["source_rows", "present", "missing"]
    return met.unpivot([], names, "name", "n").unionByName(check_counts({"active_members": active}))


def count_mismatch(parts: Sequence[DataFrame], whole: DataFrame) -> DataFrame:
    """One row (parts, whole) if the rows of the parts don't add up to those of
    the whole, else none. Each table is counted where it lies."""
    counted = check_counts({**{f"part {k}": df for k, df in enumerate(parts)}, "whole": whole})
    is_whole = F.col("name") == "whole"
    return counted.agg(
        F.sum(F.when(is_whole, 0).otherwise(F.col("n"))).alias("parts"),
        F.sum(F.when(is_whole, F.col("n")).otherwise(0)).alias("whole"),
    ).where("parts != whole")


def check_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(name, n) for every table, counted in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
