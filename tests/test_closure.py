"""Closure against brute force, on graphs with and without cycles."""

from __future__ import annotations

import random

import pytest

from termledger.operators import closure
from termledger.plans import fixtures as fx
from termledger.plans import queries as Q

SCHEMA = "sub_concept_id bigint, super_concept_id bigint"


def brute_force(edges):
    step = {}
    for a, b in edges:
        step.setdefault(a, set()).add(b)
    pairs = set()
    for start in step:
        seen, stack = set(), [start]
        while stack:
            for nxt in step.get(stack.pop(), ()):
                if nxt not in seen:
                    seen.add(nxt)
                    stack.append(nxt)
        pairs |= {(start, end) for end in seen}
    return pairs


def closed(spark, edges):
    df = spark.createDataFrame(edges, SCHEMA)
    rows = closure.transitive_closure(df).collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(25), rng.randrange(25)) for _ in range(30 + 10 * seed)]
    assert closed(spark, edges) == brute_force(edges)


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 8, 9, 17])
def test_chains(spark, length):
    edges = [(i, i + 1) for i in range(length)]
    assert closed(spark, edges) == brute_force(edges)


def test_shortcuts_and_repeats(spark):
    edges = [(i, i + 1) for i in range(12)] + [(0, 12), (0, 5), (3, 9), (0, 5)]
    assert closed(spark, edges) == brute_force(edges)


def test_cycle_of_two_is_reported(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], SCHEMA)
    loops = closure.closure_cycles(closure.transitive_closure(df)).collect()
    assert {tuple(r) for r in loops} == {(1, 1), (2, 2)}


def test_no_edges(spark):
    assert closure.transitive_closure(spark.createDataFrame([], SCHEMA)).count() == 0


def test_known_count(spark, small):
    assert Q.is_a_closure(spark, small).count() == 53_002


def test_lookups(spark, small):
    pairs = brute_force([tuple(r) for r in fx.fx_is_a(spark, small).collect()])
    table = Q.is_a_closure(spark, small)
    up = {r[0] for r in closure.ancestors(table, 100).collect()}
    down = {r[0] for r in closure.descendants(table, 100).collect()}
    assert up == {b for a, b in pairs if a == 100}
    assert down == {a for a, b in pairs if b == 100}


@pytest.mark.parametrize("seed", range(2))
def test_reachable_is_a_slice_of_the_closure(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(25), draw.randrange(25)) for _ in range(35)] + [(None, 3), (3, None)]
    pairs = brute_force([e for e in edges if None not in e])
    df = spark.createDataFrame(edges, SCHEMA)
    for concept in (0, 3, 99):
        up = closure.reachable(df, concept, "sub_concept_id", "super_concept_id").collect()
        down = closure.reachable(df, concept, "super_concept_id", "sub_concept_id").collect()
        assert sorted(r[0] for r in up) == sorted(b for a, b in pairs if a == concept)
        assert sorted(r[0] for r in down) == sorted(a for a, b in pairs if b == concept)


def test_no_pair_is_written_twice(spark, monkeypatch):
    """Each round appends new pairs alone, and reads a layer by its folder."""
    stores = []

    class Kept(closure.LayerStore):
        def __init__(self, *args):
            super().__init__(*args)
            stores.append(self)

    monkeypatch.setattr(closure, "LayerStore", Kept)
    rng = random.Random(8)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(70)] + [(100 + n, 101 + n) for n in range(20)]
    assert closed(spark, edges) == brute_force(edges)
    (store,) = stores
    written = store.read()
    assert written.count() == written.select("sub", "super").distinct().count() == len(brute_force(edges))
    plan = written.where("distance = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(distance" in plan
