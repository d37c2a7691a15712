"""Shard placement by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termledger.llm.common import quoted, seeded

#: Slots for each shard at least; no shard then holds 1 % more slots than another.
SLOTS_PER_SHARD = 100
#: A table is broadcast, so the number of its slots is bounded.
MAX_SLOTS = 2_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def table_size(shards: int) -> int:
    """The smallest prime with SLOTS_PER_SHARD slots a shard."""
    size = max(2, shards * SLOTS_PER_SHARD)
    while not _is_prime(size):
        size += 1
    return size


def _number(*parts: str) -> int:
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16)


def lookup_table(shards: list[str], size: int | None = None, seed: str = "shard") -> list[int]:
    """The shard's place in ``shards`` for each slot.

    Each shard has a permutation of the slots, offset + k * skip modulo the prime
    size. The shards take turns, and each claims the first slot of its
    permutation that is still free, so their numbers of slots differ by one at
    most, and a change of the shard list moves few slots between the others.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("name each shard once, and one at least")
    size = size or table_size(len(shards))
    if not _is_prime(size) or size < len(shards) or size > MAX_SLOTS:
        raise ValueError(f"the table needs a prime size from the number of shards to {MAX_SLOTS}")
    at = [_number(seed, s, "offset") % size for s in shards]
    skip = [_number(seed, s, "skip") % (size - 1) + 1 for s in shards]
    table, free, turn = [-1] * size, size, 0
    while free:
        while table[at[turn]] >= 0:
            at[turn] = (at[turn] + skip[turn]) % size
        table[at[turn]] = turn
        free -= 1
        turn = (turn + 1) % len(shards)
    return table


def place(
    docs: DataFrame,
    shards: list[str],
    size: int | None = None,
    seed: str = "shard",
    id_col: str = "doc_id",
) -> DataFrame:
    """``docs`` with the columns ``slot`` and ``shard`` added (replacing columns
    of these names).

    The slot is a hash of the id modulo the table size; the table, whose size is
    a checked parameter, is broadcast, and a lookup takes constant time. Rows
    are never shuffled. Null ids all go to one slot, as one value; repeated ids
    go together.
    """
    table = lookup_table(shards, size, seed)
    slots = docs.sparkSession.createDataFrame(
        [(slot, shards[turn]) for slot, turn in enumerate(table)], "slot long, shard string"
    )
    docs = docs.drop("slot", "shard")
    keyed = docs.withColumn("slot", seeded(seed, F.col(id_col)) % len(table))
    return keyed.join(F.broadcast(slots), "slot").select(*map(quoted, docs.columns), "slot", "shard")
