"""The divergence audit against nested loops, and its perfect hashes."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termledger.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "text string, lang string, source string"


def brute(rows, top):
    rows = [(TERM.findall((t or "").translate(LOWER)), a or "", b or "") for t, a, b in rows]
    out = []
    for lang in {a for _, a, _ in rows}:
        own = [(words, b) for words, a, b in rows if a == lang]
        kept = [t for t in {t for w, _ in own for t in w} if sum(t in w for w, _ in own) >= 3]
        count = {b: {t: sum(w.count(t) for w, s in own if s == b) for t in kept} for _, b in own}
        count[None] = {t: sum(c[t] for c in count.values()) for t in kept}
        share = {b: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for b, c in count.items()}
        gain = lambda p, q: (p - q) ** 2 // q
        for b in count:
            if b is None:
                continue
            pairs = [(-sum(gain(share[b][t], share[o][t]) for t in kept), o.encode()) for o in count if o not in (None, b)]
            held = [
                (-gain(share[b][t], share[None][t]), t.encode()) for t in kept if count[b][t] and share[b][t] > share[None][t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(held)[:top])):
                out += [(lang, b, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(map(str, out))


def case():
    draw = random.Random(4)
    words = ["The", "the", "Ä", "é", "x1y", "B2"] + [f"{a}{b}" for a in "abcd" for b in "klmn"]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    rows = [(text(draw.randrange(0, 40)), draw.choice(["en", "de", None]), draw.choice(["s1", "s2", "s3", "Z", None])) for _ in range(120)]
    rows += [(None, "en", "silent"), ("", "en", "s1"), ("only words of one", "lone", "s1"), ("12 34", "lone", "s2"), ("", None, "")]
    return rows + rows[:4] + [("hot " + text(5000), "en", "s1")]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("rank", "value", "item", "part", "shard", "slot", "n"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_audit_by_nested_loops(spark, monkeypatch, small):
    if small:  # many shards, passes, blocks and flushes
        values = {"SHARD_KEYS": 4, "PASS_BYTES": 150, "HELD": 5, "CELLS": 12, "PART_BYTES": 60, "ADDED": 2}
        for name, value in values.items():
            monkeypatch.setattr(divergence, name, value)
    rows = case()
    found = divergence.audit(frame(spark, rows), top_terms=6)
    got = [tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert sorted(map(str, got)) == brute(rows, 6)


def test_nothing_is_kept(spark):
    docs = frame(spark, [("one", "en", "a"), ("two", "en", "b"), (None, None, None)])
    found = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert found == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence.audit(docs.limit(0)).count() == 0


@pytest.mark.parametrize("skipped", [0, 1, 4])
def test_terms_of_many_texts_at_once(skipped):
    """No term joins two texts; nulls, empty texts, slices and signs beyond ASCII."""
    draw = random.Random(9)
    texts = ["".join(draw.choice("aZ\u00e9\u4e2d\U0001d400\u00a0 .9[`{@\x7f\n") for _ in range(draw.randrange(12))) for _ in range(400)]
    texts += [None, "", "end", None, "begin", "", "12"]
    batch = pa.array(["x", *texts])[1:][skipped:]
    text, code, words = divergence.coded_terms(batch)
    got = [(int(t), words[c].as_py().decode()) for t, c in zip(text, code.tolist())]
    assert got == [(k, w) for k, t in enumerate(texts[skipped:]) for w in TERM.findall((t or "").translate(LOWER))]
    assert len(set(words.to_pylist())) == len(words)
    for none in ([], [None], ["", "1 2"]):
        assert [len(x) for x in divergence.coded_terms(pa.array(none, pa.string()))] == [0, 0, 0]


def test_perfect_hashes_are_minimal():
    for n in (1, 2, 3, 100, 5000):
        _, _, slots = divergence.build([f"en\0w{k}".encode() for k in range(n)])
        assert sorted(slots.tolist()) == list(range(n))


def test_shares_beyond_64_bits():
    counts = np.array([3 * 10**12, 0])
    assert divergence.shares(counts, np.array([4 * 10**12, 5]), 7).tolist() == [
        1 + 10**9 * (3 * 10**12 + 1) // (4 * 10**12 + 7), 1 + 10**9 // 12,
    ]
