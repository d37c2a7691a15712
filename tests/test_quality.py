"""Checks are empty on clean rows and report seeded errors."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from termledger import constants as K
from termledger.operators import identifiers, quality
from termledger.operators import relational as rel
from termledger.plans import fixtures as fx
from termledger.plans import queries as Q


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def members(spark):
    rows = [
        ("a", dt.date(2018, 8, 1), 1, 1, 10),
        ("a", dt.date(2018, 11, 1), 0, 1, 10),
        ("b", dt.date(2018, 8, 1), 1, 1, 11),
        ("c", None, 1, 2, 11),
    ]
    return spark.createDataFrame(
        rows, "member_id string, effective_date date, active int, refset_id bigint, concept_id bigint"
    )


def test_clean_fixture(spark, small):
    full = fx.fx_map_full(spark, small)
    assert quality.duplicates(full, ["member_id", "effective_date"]).count() == 0
    assert quality.fd_violations(full, ["member_id"], Q.MAP_KEY).count() == 0
    assert quality.fd_violations(full, Q.MAP_KEY, ["member_id"]).count() == 0
    assert quality.nulls(full, full.columns).count() == 0
    assert Q.dq_check(spark, small).count() == 133
    ids = fx.fx_ids(spark, small)
    assert ids.count() - identifiers.invalid_ids(ids, "sctid").count() == 150


def test_duplicate_key(members):
    assert rows_of(quality.duplicates(members, ["member_id"])) == [("a", 2)]
    assert rows_of(quality.duplicates(members, ["member_id", "effective_date"])) == []


def test_unique_lets_nulls_repeat(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert quality.duplicates(df, ["k"]).count() == 1
    assert quality.duplicates(df, ["k"], nulls_equal=False).count() == 0


def test_orphans(spark, members):
    parent = spark.createDataFrame([(10,)], "id bigint")
    found = quality.orphans(members, parent, ["concept_id"], ["id"])
    assert {r.member_id for r in found.collect()} == {"b", "c"}


def test_release_outside_the_calendar(spark, members):
    calendar = rel.release_calendar(
        spark.createDataFrame([(1,), (2,)], "refset_id bigint"), [dt.date(2018, 8, 1)]
    )
    found = quality.orphans(members, calendar, ["refset_id", "effective_date"])
    # The row without a date is reported by the null check, not as an orphan.
    assert rows_of(found.select("member_id", "effective_date")) == [("a", dt.date(2018, 11, 1))]
    assert rows_of(quality.nulls(members, ["effective_date"]).select("member_id")) == [("c",)]


def test_member_and_key_do_not_agree(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("b", 1, 10), ("c", 1, 11), ("c", 2, 11)],
        "member_id string, refset_id bigint, concept_id bigint",
    )
    key = ["refset_id", "concept_id"]
    assert rows_of(quality.fd_violations(df, key, ["member_id"])) == [(1, 10, 2)]
    assert rows_of(quality.fd_violations(df, ["member_id"], key)) == [("c", 2)]


def test_subset_with_a_missing_row(spark):
    sup = spark.createDataFrame([(1, "A", "00"), (2, "B", "00")], "c int, r string, t string")
    sub = spark.createDataFrame([(1, "A", "00"), (2, "B", "11")], "c int, r string, t string")
    assert rows_of(quality.not_in(sub, sup, ["c", "r", "t"])) == [(2, "B", "11")]


def test_check_lets_unknown_pass(spark):
    df = spark.createDataFrame([("",), ("x",), (None,)], "t string")
    assert rows_of(quality.violations(df, F.col("t") != "")) == [("",)]


def test_must_be_active_strict_and_plain(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "description_id bigint")
    found = spark.createDataFrame([(1, 1), (2, 0)], "description_id bigint, active int")
    strict = quality.must_be_active(ids, found, "description_id")
    plain = quality.must_be_active(ids, found, "description_id", strict=False)
    assert sorted(r.description_id for r in strict.collect()) == [2, 3]
    assert [r.description_id for r in plain.collect()] == [2]


def test_two_preferred_terms_of_a_concept(spark):
    members = spark.createDataFrame(
        [(7, d, 1, K.PREFERRED) for d in (1, 2, 3)] + [(7, 4, 0, K.PREFERRED), (7, 5, 1, K.ACCEPTABLE)],
        "refset_id bigint, description_id bigint, active int, acceptability_id bigint",
    )
    described = spark.createDataFrame(
        [(1, 100), (2, 100), (3, 101), (4, 101), (5, 101)], "description_id bigint, concept_id bigint"
    )
    assert rows_of(quality.preferred_per_concept(members, described)) == [(7, 100, 2)]
    # The plain cardinality does not see it: descriptions are unique.
    assert rows_of(quality.preferred_cardinality(members)) == [(7, 3, 3)]


def test_date_profile_shows_missing_dates(members):
    found = {(r.refset_id, r.effective_date): r.n for r in quality.date_profile(members).collect()}
    assert found[(2, None)] == 1


def test_tags(spark):
    df = spark.createDataFrame([("A (product)",), ("B (medicinal product)",), ("C (substance)",)], "n string")
    assert rows_of(df.where(rel.without_tags("n", K.PRODUCT_TAGS))) == [("C (substance)",)]


def test_too_long(spark):
    df = spark.createDataFrame([("ab", "é" * 3), ("abc", "x"), (None, "xxxx")], "a string, b string")
    assert rows_of(quality.too_long(df, {"a": 2, "b": 3}).select("b")) == [("x",), ("xxxx",)]
    assert quality.too_long(df, {}).count() == 0


def test_counts_that_must_add_up(spark):
    assert rows_of(quality.count_mismatch([spark.range(3), spark.range(2)], spark.range(5))) == []
    assert rows_of(quality.count_mismatch([spark.range(3), spark.range(0)], spark.range(5))) == [(3, 5)]


def test_reconcile(spark):
    source = spark.createDataFrame([(1,), (2,), (3,)], "description_id bigint")
    members = spark.createDataFrame([(1, 1), (2, 0), (9, 1)], "description_id bigint, active int")
    found = {r.name: r.n for r in quality.reconcile(source, members, "description_id").collect()}
    assert found == {"source_rows": 3, "present": 1, "missing": 2, "active_members": 2}


def declared():
    return quality.Constraints(
        row=["id"], keys={"key": ["id"], "pair": ["a", "b"]}, unique={"code": ["c"]}, not_null=["a", "b"],
        widths={"c": 3}, checks={"positive": F.col("a") > 0},
    )


def test_declared_constraints_in_one_scan(spark, tmp_path):
    rows = [(1, 5, 6, "x"), (1, 5, 7, None), (2, 5, 6, None), (3, None, 8, "long"), (4, -1, 9, "x"), (None, 2, 1, "y"),
            (None, 2, 2, "z")]
    spark.createDataFrame(rows, "id int, a int, b int, c string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = quality.broken(df, declared())
    assert {(r.check, tuple(r.key), r.n) for r in found.collect()} == {
        ("key", ("1",), 2), ("key", (None,), 2), ("pair", ("5", "6"), 2), ("code", ("x",), 2),
        ("nulls", ("3",), 1), ("width", ("3",), 1), ("positive", ("4",), 1),
    }
    plan = quality.broken(df, declared())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1

    checks = quality.Checks()
    checks.declare("t", df, declared())
    checks.add("other", lambda: df.where("id = 2"))
    assert list(checks) == ["t key", "t pair", "t code", "t nulls", "t width", "t positive", "other"]
    assert rows_of(checks["t pair"]) == [("pair", ["5", "6"], 2)]
    counts = checks.counts()
    assert counts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert {r.name: r.n for r in counts.collect()} == {
        "t key": 2, "t pair": 1, "t code": 1, "t nulls": 1, "t width": 1, "t positive": 1, "other": 1,
    }


def test_checks_are_planned_when_they_are_asked_for():
    checks = quality.Checks()
    checks.add("never", lambda: 1 / 0)
    assert list(checks) == ["never"] and len(checks) == 1
    with pytest.raises(ZeroDivisionError):
        checks["never"]
