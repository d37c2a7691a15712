"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints that
differ in two bits at most differ in one bit at most in one of the segments, so
either a segment is the same, or it becomes the same once one bit is wiped out.
Each distinct fingerprint is indexed under its two segments and the 64 variants
with one wildcard bit; equality joins find the pairs, a bit count verifies them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termledger.llm.common import BROADCAST_ROWS, never_broadcast
from termledger.llm.components import connected_components
from termledger.session import StepFolder

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Hashes that are unpacked into bits at once: bounds memory for very long texts.
BLOCK = 65_536
#: Distinct fingerprints below one key that are compared pair by pair. Keys with
#: more go the refined way, which is exact too.
PAIRED = 256
#: Keys of a fingerprint.
KEYS = 66


def word_hashes(text: str | None, shingle: int, seed: int = 42) -> np.ndarray:
    """The XXH64 of all shingles, repeats included. Fewer words than a shingle
    count as one shingle."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    shingle = min(shingle, len(words))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash over the XXH64 of all shingles, repeats included, as a signed
    64-bit number. A bit is 1 if it is set in over half the hashes. Fewer words
    than a shingle count as one shingle; no word gives zero."""
    hashes = word_hashes(text, shingle, seed)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), BLOCK):
        part = hashes[k : k + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long) per row of whole texts, null texts as empty ones."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            prints = [fingerprint(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], names=["id", "fingerprint"]
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, fingerprint bigint")


# Keys: 0-31 wipe a bit of the low segment, 32-63 of the high one, 64 and 65
# are the whole segments. A key is its number and the 32 bits that are left.
_VARIANTS = """
  explode(concat(
    transform(sequence(0, 31), j -> named_struct(
      'k', shiftleft(bigint(j), 32) | (fp & 4294967295L & ~shiftleft(1L, j)), 'one', shiftright(fp, j) & 1L)),
    transform(sequence(0, 31), j -> named_struct(
      'k', shiftleft(bigint(j + 32), 32) | (shiftrightunsigned(fp, 32) & ~shiftleft(1L, j)),
      'one', shiftright(fp, j + 32) & 1L)),
    array(
      named_struct('k', shiftleft(64L, 32) | (fp & 4294967295L), 'one', 2L),
      named_struct('k', shiftleft(65L, 32) | shiftrightunsigned(fp, 32), 'one', 2L))
  )) as e"""

# The other segment's bits, wiped two at a time, for keys of whole segments.
_TWO_BITS = """
  explode(flatten(transform(sequence(0, 30), i -> transform(sequence(i + 1, 31), j ->
    shiftleft(1L, if(shiftrightunsigned(k, 32) = 64L, 32, 0) + i)
    | shiftleft(1L, if(shiftrightunsigned(k, 32) = 64L, 32, 0) + j))))) as mask"""
# The other segment's bits, wiped one at a time or not at all, for wildcard keys.
_ONE_BIT = """
  explode(concat(array(0L), transform(sequence(0, 31), j ->
    shiftleft(1L, if(shiftrightunsigned(k, 32) < 32L, 32, 0) + j)))) as mask"""


def near_pairs(distinct: DataFrame, folder, paired: int = PAIRED, limit: int = BROADCAST_ROWS) -> DataFrame:
    """(u, v) pairs of distinct fingerprints (column fp), within two bits, that
    link the same classes as all such pairs do.

    The keys are counted first, combined before the shuffle; most hold one
    fingerprint and end there. A pair that shares a whole segment is met once,
    a pair one bit apart in a segment once too: the side with that bit off
    joins the side with it on. Keys with more than ``paired`` fingerprints are
    never paired: their members are indexed further by the wiped bits of the
    other segment, which leaves four fingerprints a key at most, all linked.

    No table of more than ``limit`` counted rows is broadcast: the planner takes
    the keys for no larger than the fingerprints they are made of.
    """
    keyed = distinct.selectExpr("fp", _VARIANTS).select("fp", "e.k", "e.one")
    counts = keyed.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("one").alias("lo"), F.max("one").alias("hi")
    ).where("n > 1 and (lo < hi or lo = 2)").select("k", "n")
    shared = folder.write(never_broadcast(keyed, KEYS * distinct.count(), limit).join(counts, "k"))
    few = never_broadcast(shared.where(F.col("n") <= paired), shared.count(), limit)
    a = few.select("k", F.col("fp").alias("u"), F.col("one").alias("p"))
    b = few.select("k", F.col("fp").alias("v"), F.col("one").alias("q"))
    off = a.where("p = 0").join(b.where("q = 1"), "k").select("u", "v")
    whole = a.where("p = 2").join(b.where("q = 2"), "k").where("u < v").select("u", "v")
    close = off.unionAll(whole).where("bit_count(u ^ v) <= 2")

    many = shared.where(F.col("n") > paired)
    wiped = many.where("one < 2").selectExpr("k", "fp", _ONE_BIT).unionAll(
        many.where("one = 2").selectExpr("k", "fp", _TWO_BITS)
    )
    # Members of one refined key differ in wiped bits only, two at most.
    refined = wiped.selectExpr("k", "mask", "fp & ~mask as rest", "fp")
    refined = refined.selectExpr(
        "k", "mask", "fp",
        # the bit the key itself wiped stays open
        "rest & ~(case when shiftrightunsigned(k, 32) < 64L"
        " then shiftleft(1L, int(shiftrightunsigned(k, 32))) else 0L end) as rest",
    )
    least = refined.groupBy("k", "mask", "rest").agg(
        F.min("fp").alias("v"), F.collect_set("fp").alias("members")
    ).where("size(members) > 1")
    linked = least.select(F.explode("members").alias("u"), "v").where("u != v")
    return close.unionAll(linked)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paired: int = PAIRED
) -> DataFrame:
    """Per row of ``docs``: id, fingerprint (long) and component_id, the
    smallest id among the rows whose fingerprints can be reached by steps of two
    bits at most.

    Null and empty texts have fingerprint zero and link like any other. Repeated
    rows stay repeated. A null id is never the smallest unless a component has no
    other. Other columns are left out, whatever their names. An empty table gives
    an empty result.
    """
    spark: SparkSession = docs.sparkSession
    folder = StepFolder(spark, "simhash", keep=True)
    prints = folder.write(fingerprints(docs, id_col, text_col))
    distinct = folder.write(
        prints.groupBy("fingerprint").agg(F.min("id").alias("least")).withColumnRenamed("fingerprint", "fp")
    )
    roots = connected_components(near_pairs(distinct.select("fp"), folder, paired), folder)
    rooted = distinct.join(roots.select(F.col("u").alias("fp"), "v"), "fp", "left").select(
        "fp", F.coalesce("v", "fp").alias("root"), "least"
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = folder.write(rooted.join(smallest, "root").select("fp", "component_id"))
    rows = never_broadcast(prints, prints.count())
    return rows.join(classes, rows["fingerprint"] == classes["fp"]).select(
        F.col("id").alias(id_col), "fingerprint", "component_id"
    )


def hex_fingerprint(column: str = "fingerprint"):
    return F.lpad(F.lower(F.hex(column)), 16, "0")
