"""Joins, appends and de-duplication with the semantics release work relies on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termledger.session import StepFolder


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns of the same name, each kept once and put first.

    Without a shared column this would be a product, so that is an error here;
    :func:`release_calendar` builds the one product that is wanted.
    """
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return left.join(right, shared, how)


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows with a match; the right side shrinks to its keys."""
    return left.join(right.select(*keys), list(keys), "left_semi").select(*left.columns)


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a match. A null key matches nothing."""
    return left.join(right.select(*keys), list(keys), "left_anti").select(*left.columns)


def enrich(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every left row, with the right columns where there is a match."""
    return left.join(right, list(keys), "left")


def append(target: DataFrame, rows: DataFrame, by_position: bool = False) -> DataFrame:
    """Rows added to a table, columns matched by name in the table's order.

    Columns the rows do not have stay null; a column the table does not have
    is an error. ``by_position`` takes the columns in order whatever their
    names, and needs all of them.
    """
    if by_position:
        return target.unionByName(rows.toDF(*target.columns))
    extra = set(rows.columns) - set(target.columns)
    if extra:
        raise ValueError(f"not columns of the table: {sorted(extra)}")
    return target.unionByName(rows, allowMissingColumns=True)


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second).distinct()


def role_view(df: DataFrame, role: str, id_col: str, *columns: str) -> DataFrame:
    """The table under role names, so that it joins by the role's key."""
    return df.select(*[F.col(c).alias(f"{role}_{c}") for c in (id_col, *columns)])


def flag(predicate: Column) -> Column:
    """1 where the predicate holds, else 0; null counts as not holding."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def is_active(column: str = "active") -> Column:
    return F.col(column) != 0


def outside_range(column: str, low, high) -> Column:
    """Not within the inclusive range."""
    return ~F.col(column).between(low, high)


def without_tags(column: str, tags: Sequence[str]) -> Column:
    """The text ends with none of the tags."""
    return reduce(Column.__and__, [~F.col(column).endswith(f" {tag}") for tag in tags])


def release_calendar(modules: DataFrame, releases: Sequence[dt.date]) -> DataFrame:
    """Every module with every release date.

    The dates are a handful of literals, so each module row is fanned out in
    place instead of being joined.
    """
    dates = F.array(*[F.lit(day) for day in releases])
    return modules.withColumn("effective_date", F.explode(dates))


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def max_length(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Longest text of each column, in bytes."""
    return df.agg(
        *[F.max(F.octet_length(c)).cast("bigint").alias(f"max_length_{c}") for c in columns]
    )


def _same_key(df: DataFrame, keys: Sequence[str], table: DataFrame, how: str) -> DataFrame:
    """A semi- or anti-join on keys of which nulls are equal."""
    other = table.select(*[F.col(k).alias(f"_key_{n}") for n, k in enumerate(keys)])
    same = reduce(Column.__and__, [df[k].eqNullSafe(other[f"_key_{n}"]) for n, k in enumerate(keys)])
    return df.join(other, same, how)


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row of every key in the given order; null keys are equal.

    Keys are counted first, without the rest of the row, in a hash aggregate.
    Those that repeat are written, so their size is known; if it is small, the
    rows of single keys pass as they lie, neither shuffled nor sorted. Only rows
    of repeated keys are ordered: the minimum over a struct combines before the
    shuffle, so a key that holds a large part of the rows sends one row per task.
    """
    steps = StepFolder(df.sparkSession, "dedupe-first", keep=True)
    repeated = steps.write(count_by(df, keys).where("n > 1").select(*keys))
    rest = [c for c in df.columns if c not in {*keys, *order_by}]
    several = _same_key(df, keys, repeated, "left_semi")
    first = several.groupBy(*keys).agg(F.min(F.struct(*order_by, *rest)).alias("first"))
    single = _same_key(df, keys, repeated, "left_anti")
    return single.unionByName(first.select(*keys, "first.*").select(*df.columns))


#: Rows whose bits, one a row, are broadcast at most: 64 MB.
FLAGGED_ROWS = 1 << 29
#: Rows of the table for each part that is sorted: a part is sorted in memory.
PLACED_ROWS = 250_000
_ID, _PLACE = "_load_id", "_load_place"


def load_unique(
    df: DataFrame, unique: Sequence[Sequence[str]], order_by: str | Sequence[str]
) -> DataFrame:
    """Rows in order, skipping one that repeats a unique key of a kept row.

    Rows whose keys all occur once are kept as they are. Among the others a
    skipped row blocks no later one, so keys cannot be handled one after the
    other. A round decides every row that is the first under all its keys, which
    is kept, and every row behind it along a chain on which each has one row
    before it under its keys: it is kept if that one is not. Chains are followed
    by pointer doubling, so a chain takes rounds by the logarithm of its length.
    Rows that a kept row blocks go, and the next round meets what is left; the
    earliest row left is always decided, so the rounds end. A key with a null in
    it repeats nothing, as in a unique constraint.

    ``order_by``, one column or several, must be unique. Rows are written once at
    the start so that positions taken from a file scan stay as they are, and no
    whole row is shuffled: rows are found again by bits, one for each, which are
    broadcast up to 64 MB. Rows that repeat a key are put in order once; the
    rounds know them by their place and by those of their keys that repeat. What
    a step has read goes before the next. The two earliest rows of a key are
    taken in each task before the shuffle, so no key is too frequent.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    steps = StepFolder(df.sparkSession, "load-unique", keep=True)
    rows = steps.write(df.withColumn(_ID, F.monotonically_increasing_id()), free=True)
    n_rows = rows.count()
    marked, marks = rows, []
    for number, keys in enumerate(unique):
        marks.append(f"_repeats_{number}")
        keyed = rows.select(*dict.fromkeys(keys), _ID).dropna(subset=list(keys))
        counting = StepFolder(df.sparkSession, "load-unique-keys")
        repeated = counting.write(count_by(keyed, keys).where("n > 1").select(*keys), free=True)
        bits = counting.write(_bits(semi_join(keyed, repeated, keys).select(_ID)), free=True)
        marked = _flagged(marked, bits, marks[-1], n_rows)
    named = [[f"_key_{number}_{n}" for n in range(len(keys))] for number, keys in enumerate(unique)]
    repeating = marked.where(reduce(Column.__or__, map(F.col, marks)))
    placed = steps.write(_placed(repeating, order, unique, marks, named, n_rows), free=True)

    left, kept = placed.drop(_ID), []
    rounds = StepFolder(df.sparkSession, "load-unique-rounds")
    while not left.isEmpty():
        kept.append(_decided(left, named))
        held = left.join(kept[-1], _PLACE, "left_semi").drop(_PLACE)
        held = StepFolder(df.sparkSession, "load-unique-held").write(held, free=True)
        for keys in named:
            whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
            left = left.where(~whole).unionByName(anti_join(left.where(whole), held.where(whole), keys))
        left = rounds.write(left, free=True)
    if not kept:
        return rows.select(*df.columns)
    skipped = placed.select(_PLACE, _ID).join(reduce(DataFrame.unionByName, kept), _PLACE, "left_anti")
    skipped = steps.write(_bits(skipped.select(F.explode(_ID).alias(_ID))), free=True)
    return _flagged(rows, skipped, "_skipped", n_rows).where("not _skipped").select(*df.columns)


def _bits(ids: DataFrame) -> DataFrame:
    """One bit for each id that is there, in pieces of 4 kB."""
    dealt = ids.select(F.bitmap_bucket_number(_ID).alias("_piece"), F.bitmap_bit_position(_ID).alias("_at"))
    return dealt.repartition("_piece").groupBy("_piece").agg(F.bitmap_construct_agg("_at").alias("_bits"))


def _flagged(rows: DataFrame, bits: DataFrame, name: str, n_rows: int) -> DataFrame:
    """Rows with whether their id has its bit set."""
    found = bits.select(F.col("_piece").alias(f"{name}_piece"), F.col("_bits").alias(f"{name}_bits"))
    found = F.broadcast(found) if n_rows <= FLAGGED_ROWS else found
    at = F.bitmap_bit_position(_ID).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(f"{name}_bits"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    flagged = rows.join(found, F.bitmap_bucket_number(_ID) == F.col(f"{name}_piece"), "left")
    is_set = F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    return flagged.withColumn(name, is_set).drop(f"{name}_piece", f"{name}_bits")


def _placed(
    marked: DataFrame, order: Sequence[str], unique: Sequence[Sequence[str]], marks: Sequence[str],
    named: Sequence[Sequence[str]], n_rows: int,
) -> DataFrame:
    """(place, ids, keys): a number that grows with the order, the ids of the rows
    of that place, which are the same in order and keys, and the keys that repeat,
    others as null. One shuffle, to parts that fit into memory, serves the
    grouping and the sort."""
    columns = dict.fromkeys([*order, *(k for keys in unique for k in keys)])
    dealt = marked.select(*columns, *marks, _ID).repartitionByRange(n_rows // PLACED_ROWS + 1, *order)
    same = dealt.groupBy(*columns, *marks).agg(F.collect_list(_ID).alias(_ID)).orderBy(*order)
    parts = [
        F.when(F.col(mark), F.col(k)).alias(name)
        for keys, mark, names in zip(unique, marks, named)
        for k, name in zip(keys, names)
    ]
    return same.select(F.monotonically_increasing_id().alias(_PLACE), _ID, *parts)


def _decided(left: DataFrame, unique: Sequence[Sequence[str]]) -> DataFrame:
    """The places of rows that are kept whatever happens to the others."""
    whole = [reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]) for keys in unique]
    n_keys = reduce(Column.__add__, [flag(w) for w in whole])
    met = None
    for keys, complete in zip(unique, whole):
        row = left.where(complete).select(F.struct(F.col(_PLACE).alias("_row"), n_keys.alias("_keys")).alias("_at"), *keys)
        earliest = F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))
        two = row.withColumn("_nth", earliest).where("_nth <= 2").groupBy(*keys)
        two = two.agg(F.min("_at").alias("_first"), F.max("_at").alias("_second"))
        seen = F.array(
            F.struct("_first._row", "_first._keys", F.lit(None).cast("long").alias("_before")),
            F.struct("_second._row", "_second._keys", F.col("_first._row").alias("_before")),
        )
        seen = two.select(F.explode(F.when(F.col("_first") == F.col("_second"), F.slice(seen, 1, 1)).otherwise(seen)).alias("_s"))
        seen = seen.select("_s.*")
        met = seen if met is None else met.unionByName(seen)
    # a row hangs on the one before it, the same under all its keys
    one = met.where("_keys = 1").select("_row", F.col("_before").alias("_on"))
    more = met.where("_keys > 1").groupBy("_row").agg(
        F.first("_keys").alias("_keys"), F.count(F.lit(1)).alias("_n"), F.min("_before").alias("_on"), F.max("_before").alias("_last")
    ).where("_n = _keys and (_on is null or _on = _last)").select("_row", "_on")
    steps = StepFolder(left.sparkSession, "load-unique-first", keep=True)
    nodes = steps.write(one.unionByName(more), free=True)
    roots = nodes.where("_on is null").select(F.col("_row").alias("_root"))
    # _odd: it is kept if the one it hangs on is not
    hung = nodes.where("_on is not null").withColumn("_odd", F.lit(True))
    chains = StepFolder(left.sparkSession, "load-unique-chains")
    while True:
        hung = chains.write(_jump(_jump(hung.withColumn("_moved", F.lit(False)))), free=True)
        if hung.where("_moved").isEmpty():
            break
        hung = hung.drop("_moved")
    even = hung.where("not _odd").join(roots, F.col("_on") == F.col("_root"), "left_semi")
    return chains.write(roots.unionByName(even.select(F.col("_row").alias("_root"))).toDF(_PLACE), free=True)


def _jump(nodes: DataFrame) -> DataFrame:
    """Each row hangs on what the row it hung on hangs on, if that is anything."""
    on = nodes.where("_on is not null").select(
        F.col("_row").alias("_at"), F.col("_on").alias("_next"), F.col("_odd").alias("_next_odd")
    )
    met = nodes.join(on, F.col("_on") == F.col("_at"), "left")
    moves = F.col("_next").isNotNull()
    return met.select(
        "_row",
        F.when(moves, F.col("_next")).otherwise(F.col("_on")).alias("_on"),
        F.when(moves, F.col("_odd") != F.col("_next_odd")).otherwise(F.col("_odd")).alias("_odd"),
        (F.col("_moved") | moves).alias("_moved"),
    )
