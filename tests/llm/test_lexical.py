"""Ranked search against nested loops."""

from __future__ import annotations

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from termledger.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top):
    read = [(doc, split(text)) for doc, text in docs]
    n, total = sum(bool(t) for _, t in read), sum(len(t) for _, t in read)
    out = []
    for item, text in dict.fromkeys(items):
        if item is None:
            continue
        scores = []
        for doc, words in read:
            m, score = (100 - 50 + 50 * len(words) * n // total), 0
            for term in set(split(text)):
                df, tf = sum(term in w for _, w in read), words.count(term)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 20 * m)) if tf else 0
            if score:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if none else doc, -s) for k, (s, none, doc) in enumerate(sorted(scores)[:top])]
    return sorted(map(str, out))


def case():
    draw = random.Random(9)
    words = ["the", "of", "Ä", "Zed", "x1", "ß-9"] + [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    docs = [(k, text(draw.randrange(1, 60))) for k in range(90)]
    docs += [(5, docs[3][1]), (None, docs[3][1]), (None, docs[3][1]), (200, None), (201, ""), (202, "!?"), (203, text(3000))]
    docs += [(k, docs[7][1]) for k in range(300, 306)]
    items = [(k, text(draw.randrange(2, 12))) for k in range(12)]
    items += [(50, items[2][1]), (51, items[2][1] + " unheard"), (51, items[2][1] + " unheard"), (52, None), (53, "..."), (None, "the"),
              (2, "another text of the same id")]
    return docs, items


def frames(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    for name in ("item", "rank", "score", "terms", "doc"):
        docs, items = docs.withColumn(name, F.lit("clash")), items.withColumn(name, F.lit(0))
    return docs, items


def test_ranks_by_nested_loops(spark, monkeypatch):
    docs, items = case()
    for cells, terms in ((lexical.CELLS, lexical.PLAN_TERMS), (900, 25)):
        monkeypatch.setattr(lexical, "CELLS", cells)
        found = lexical.search(*frames(spark, docs, items), top=7, plan_terms=terms)
        assert sorted(str(tuple(r)) for r in found.select("item_id", "rank", "doc_id", "score").collect()) == brute(docs, items, 7)


def test_empty_tables(spark):
    docs, items = frames(spark, *case())
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.where("text is null"), items).count() == 0


def test_shared_nodes_are_added_once():
    """Items that share terms share nodes; every item is the sum of its terms."""
    draw = random.Random(2)
    owned = {i: {f"b{k}" for k in range(30) if draw.random() < 0.5} | {f"own{i}"} for i in range(40)}
    owned[100] = owned[3]
    holders = {}
    for item, terms in owned.items():
        for t in terms:
            holders.setdefault(t, []).append(item)
    sets = {}
    for t, own in holders.items():
        sets.setdefault(tuple(sorted(own)), []).append(t)
    asked = lexical.plan([(list(own), sorted(ts)) for own, ts in sets.items()])
    single = np.random.default_rng(1).integers(0, 1000, (len(asked.places), 5))
    scores = lexical.accumulate(asked.graph, asked.starts, single)
    for k, item in enumerate(asked.items.tolist()):
        assert (scores[k] == sum(single[asked.places[t.encode()]] for t in owned[item])).all()
    made = [pair for a, b in asked.graph.levels for pair in zip(a.tolist(), b.tolist())]
    assert made and len(made) == len(set(made))
    additions = len(made) + sum(len(p) - 1 for p in asked.graph.parts)
    assert additions < sum(len(t) - 1 for t in owned.values())
