"""Snapshot and roll-forward: known counts, laws, and brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from termledger import constants as K
from termledger.operators import history
from termledger.operators.relational import append
from termledger.plans import fixtures as fx
from termledger.plans import queries as Q

MAP_ID = ["member_id", *Q.MAP_KEY]
LANGUAGE_ID = ["member_id", *Q.LANGUAGE_KEY]


def split(compared):
    rows = compared.groupBy("change").count().collect()
    return {row["change"]: row["count"] for row in rows}


def test_known_map_counts(spark, small):
    full, target = fx.fx_map_full(spark, small), fx.fx_map_active(spark, small)
    before = history.snapshot(full, MAP_ID)
    assert before.count() == 51_731
    assert before.where("active = 1").count() == 34_401
    counts = split(history.compare(full, target, Q.MAP_KEY))
    assert counts["inactivated"] == 12_576
    assert counts["added"] == 5_866
    assert counts["updated"] == 10_995


def test_known_language_counts(spark, small):
    full, target = fx.fx_lang_full(spark, small), fx.fx_lang_active(spark, small)
    before = history.snapshot(full, LANGUAGE_ID)
    assert before.count() == 1_500
    assert before.where("active = 1").count() == 997
    counts = split(history.compare(full, target, Q.LANGUAGE_KEY, ["acceptability_id"]))
    assert (counts["added"], counts["inactivated"], counts["updated"]) == (135, 162, 761)


@pytest.mark.parametrize("kind", ["map", "language", "refset"])
def test_laws(spark, small, kind):
    full, target, key, values, supplied = {
        "map": (fx.fx_map_full, fx.fx_map_active, Q.MAP_KEY, [], False),
        "language": (fx.fx_lang_full, fx.fx_lang_active, Q.LANGUAGE_KEY, ["acceptability_id"], False),
        "refset": (fx.fx_refset_full, fx.fx_refset_active, Q.REFSET_KEY, [], True),
    }[kind]
    full, target = full(spark, small), target(spark, small)
    ids = ["member_id", *key]
    compared = history.compare(full, target, key, values, supplied_id=supplied)
    new = history.release_rows(compared, Q.RELEASE, K.EXTENSION_MODULE).drop("module_id")
    counts = split(compared)

    after = append(full, new)
    before, final = history.snapshot(full, ids), history.snapshot(after, ids)
    # The snapshot grows by the new members alone.
    assert final.count() == before.count() + counts["added"]
    # Activated rows are the new and the reactivated or updated ones.
    assert new.where("active = 1").count() == counts["added"] + counts["updated"]
    assert new.where("active = 0").count() == counts["inactivated"]
    # The active set is the target set.
    columns = [*key, *values]
    active = final.where("active = 1").select(columns)
    assert active.exceptAll(target.select(columns)).count() == 0
    assert target.select(columns).exceptAll(active).count() == 0
    # The one-pass snapshot is the recomputed one.
    one_pass = history.release_snapshot(compared, Q.RELEASE).select(final.columns)
    assert one_pass.exceptAll(final).count() == 0 and final.exceptAll(one_pass).count() == 0
    # A second release with the same target changes nothing, and ids stay.
    again = history.roll_forward(
        after,
        target,
        key,
        values,
        release=dt.date(2002, 6, 1),
        module_id=K.EXTENSION_MODULE,
        supplied_id=supplied,
    )
    assert again.count() == 0
    assert final.select("member_id").distinct().count() == final.select(key).distinct().count()


def three_statements(history_rows, target, release):
    """The row-by-row meaning: inactivate, add, reactivate or update."""
    latest = {}
    for member, day, active, key, value in sorted(history_rows, key=lambda r: r[1]):
        latest[key] = (member, active, value)
    out = set()
    for key, (member, active, value) in latest.items():
        if key not in target and active:
            out.add((member, 0, key, value))
        if key in target and (not active or value != target[key]):
            out.add((member, 1, key, target[key]))
    for key, value in target.items():
        if key not in latest:
            out.add((None, 1, key, value))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_roll_forward_is_the_three_statements(spark, seed):
    rng = random.Random(seed)
    days = [dt.date(2018, m, 1) for m in (1, 4, 8)]
    rows = [
        (f"m{key}", day, rng.randint(0, 1), key, rng.randint(0, 2))
        for key in range(60)
        for day in days
        if rng.random() < 0.5
    ]
    target = {key: rng.randint(0, 2) for key in range(40, 110) if rng.random() < 0.6}
    full = spark.createDataFrame(rows, "member_id string, effective_date date, active int, k int, v int")
    wanted = spark.createDataFrame(list(target.items()), "k int, v int")
    out = history.roll_forward(
        full, wanted, ["k"], ["v"], release=dt.date(2019, 2, 1), module_id=1
    ).collect()
    known = {row[0] for row in rows}
    found = {(r.member_id if r.member_id in known else None, r.active, r.k, r.v) for r in out}
    assert found == three_statements(rows, target, dt.date(2019, 2, 1))
    assert len(found) == len(out)


def test_member_that_reverts_keeps_its_id(spark):
    """Changed, retired, wanted again: the shape of the reference examples."""
    rows = [
        ("a", dt.date(2017, 7, 1), 1, 41, 1376001, "X1"),
        ("a", dt.date(2018, 8, 1), 0, 41, 1376001, "X1"),
        ("b", dt.date(2018, 8, 1), 1, 41, 1376001, "X2"),
    ]
    full = spark.createDataFrame(
        rows,
        "member_id string, effective_date date, active int, refset_id bigint, concept_id bigint, map_target string",
    )
    target = spark.createDataFrame(
        [(41, 1376001, "X1")], "refset_id bigint, concept_id bigint, map_target string"
    )
    out = history.roll_forward(
        full, target, Q.MAP_KEY, release=dt.date(2019, 2, 1), module_id=1
    ).collect()
    assert {(r.member_id, r.active, r.map_target) for r in out} == {("a", 1, "X1"), ("b", 0, "X2")}


def test_null_value_is_a_difference(spark):
    full = spark.createDataFrame(
        [("a", dt.date(2018, 1, 1), 1, 1, None), ("b", dt.date(2018, 1, 1), 1, 2, None)],
        "member_id string, effective_date date, active int, k int, v int",
    )
    target = spark.createDataFrame([(1, 5), (2, None)], "k int, v int")
    out = history.roll_forward(full, target, ["k"], ["v"], release=dt.date(2019, 1, 1), module_id=1)
    assert [(r.member_id, r.v) for r in out.collect()] == [("a", 5)]


def test_member_ids_are_stable_uuids(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (11, "a")], "k int, t string")
    ids = [r.member_id for r in history.assign_member_ids(df, ["k", "t"]).collect()]
    again = [r.member_id for r in history.assign_member_ids(df.repartition(3), ["k", "t"]).collect()]
    assert len(set(ids)) == 3 and set(ids) == set(again)
    import uuid

    assert all(str(uuid.UUID(i)) == i and uuid.UUID(i).version == 3 for i in ids)


def test_carry_forward(spark, small):
    rows = fx.fx_dep(spark, small)
    new = history.carry_forward(rows, dt.date(2018, 11, 1), dt.date(2019, 2, 1), dt.date(2019, 1, 31))
    # As many rows as the release before, under the same ids.
    assert new.count() * 2 == rows.count()
    assert new.select("dep_id").exceptAll(rows.where("effective_date = '2018-11-01'").select("dep_id")).count() == 0
    assert {str(r.target_effective_date) for r in new.collect()} == {"2019-01-31"}


def test_changed_expression(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 1, 1), (1, 1, 2), (1, None, 1)], "a int, o int, n int")
    flags = [r[0] for r in df.select(history.changed(F.col("a"), F.col("o"), F.col("n"))).collect()]
    assert flags == [True, False, True, True]


def test_two_keys_that_read_alike_have_two_ids(spark):
    keys = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a1:b", ""), ("", "a1:b")], "x string, y string")
    ids = history.assign_member_ids(keys, ["x", "y"]).select("member_id").distinct()
    assert ids.count() == 4


def test_a_key_with_a_null_part_is_refused(spark):
    keys = spark.createDataFrame([("a", None)], "x string, y string")
    with pytest.raises(Exception, match="null part"):
        history.assign_member_ids(keys, ["x", "y"]).collect()


def test_unchanged_members_keep_their_module(spark):
    full = spark.createDataFrame(
        [("m1", dt.date(2018, 1, 1), 1, 7, "k1"), ("m2", dt.date(2018, 1, 1), 1, 7, "k2")],
        "member_id string, effective_date date, active int, module_id long, concept string",
    )
    target = full.where("concept = 'k1'").select("concept").unionByName(spark.createDataFrame([("k3",)], "concept string"))
    compared = history.compare(full, target, ["concept"])
    after = history.release_snapshot(compared, dt.date(2019, 1, 1), 9)
    assert {r.concept: r.module_id for r in after.collect()} == {"k1": 7, "k2": 9, "k3": 9}
    added = history.release_rows(compared, dt.date(2019, 1, 1), 9)
    assert {(r.concept, r.module_id) for r in added.collect()} == {("k2", 9), ("k3", 9)}
