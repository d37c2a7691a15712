"""Plans are what they should be at any size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termledger.operators import history, quality, refsets
from termledger.operators import relational as rel
from termledger.plans import fixtures as fx
from termledger.plans import queries as Q
from termledger.sources.writers import materialize, materialize_bucketed, replace_bucketed_release


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def no_automatic_broadcast(spark):
    """Tables are tiny here; plans are judged as if they were not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_products_and_no_python(name, spark, tiny):
    text = plan(Q.QUERIES[name](spark, tiny))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert word not in text


@pytest.fixture(scope="module")
def stored(spark, tiny, tmp_path_factory):
    base = tmp_path_factory.mktemp("stored")
    yearly = fx.fx_map_full(spark, tiny).withColumn("effective_date", F.trunc("effective_date", "year"))
    return (
        materialize(yearly, f"{base}/full", ["effective_date"]),
        materialize(fx.fx_map_active(spark, tiny), f"{base}/target"),
    )


def test_snapshot_is_one_hash_aggregate(stored):
    text = plan(history.snapshot(stored[0], ["member_id", *Q.MAP_KEY]))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_max_by" in text and "SortAggregate" not in text


def test_comparison_shuffles_each_side_once(stored):
    text = plan(history.compare(*stored, Q.MAP_KEY))
    assert text.count("Exchange") == 2
    assert text.count("SortMergeJoin") == 1 and "partial_max_by" in text and "SortAggregate" not in text


def test_a_bucketed_history_stays_where_it_lies(spark, stored, tmp_path):
    """Only the target moves, also after a release was added; no sort aggregate."""
    full, target = stored
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = str(tmp_path / "history")
    bucketed = materialize_bucketed(full, path, Q.MAP_KEY, buckets, ["effective_date"])
    plain = history.compare(full, target, Q.MAP_KEY)
    moved = history.compare(bucketed, target, Q.MAP_KEY, colocated=True)
    assert plain.exceptAll(moved).isEmpty() and moved.exceptAll(plain).isEmpty()
    added = [tuple(r) for r in history.release_rows(moved, Q.RELEASE, 1).select(*bucketed.columns).collect()]
    for _ in range(2):  # a rerun of the release replaces it
        compared = history.compare(bucketed, target, Q.MAP_KEY, colocated=True)
        text = plan(compared)
        assert text.count("Exchange") == 1 and "SortAggregate" not in text
        latest = plan(history.snapshot(bucketed, ["member_id", *Q.MAP_KEY]))
        assert "Exchange" not in latest and "SortAggregate" not in latest
        bucketed = replace_bucketed_release(spark.createDataFrame(added, bucketed.schema), path, Q.MAP_KEY, buckets)
        known = history.delta(bucketed, Q.RELEASE)
        assert "PartitionFilters: [isnotnull(effective_date" in plan(known)
        assert sorted(map(tuple, known.collect())) == sorted(added)
        assert bucketed.count() == full.count() + len(added)
    again = history.compare(bucketed, target, Q.MAP_KEY, colocated=True)
    assert again.where(F.col("change") != history.UNCHANGED).isEmpty()


def test_filters_and_columns_reach_the_scan(spark, tiny):
    text = plan(Q.rf_lang_snapshot(spark, tiny))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal" in text
    assert "o_totalprice" not in text and "c_name" not in text


def test_delta_reads_one_partition(stored):
    text = plan(history.delta(stored[0], Q.DELTA_DAY))
    assert "PartitionFilters: [isnotnull(effective_date" in text


def test_missing_keys_are_broadcast_only_by_their_size(spark, stored):
    parent = stored[1].select("concept_id").distinct()
    found = quality.orphans(stored[0], parent, ["concept_id"])
    assert "SortMergeJoin" in plan(found)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    found = quality.orphans(stored[0], parent, ["concept_id"])
    text = plan(found)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_a_name_layer_is_one_join(spark, tiny, tmp_path):
    described = materialize(Q._described(spark, tiny), str(tmp_path / "described"))
    from termledger.operators import terms

    for names in (terms.preferred_terms, terms.synonyms, terms.active_descriptions):
        assert "Exchange" not in plan(names(described))


def test_descriptors_fan_out_in_place(spark, tiny):
    new = fx.fx_concept(spark, tiny)
    found = refsets.refsets_of(fx.fx_relationship(spark, tiny), 5)
    text = plan(refsets.describe_refsets(found, new, Q.RELEASE, 1, refsets.SIMPLE_MAP_ATTRIBUTES))
    assert text.count("SortMergeJoin") == 1 and "Generate explode" in text


def test_count_of_a_hot_group_is_spread(spark, tiny):
    """Distinct values of one refset are combined under (refset, value) first."""
    rows = fx.fx_map_full(spark, tiny).select("refset_id", F.col("concept_id"))
    text = plan(rows.groupBy("refset_id").agg(F.count_distinct("concept_id")))
    assert "hashpartitioning(refset_id" in text and text.count("HashAggregate") >= 4


@pytest.fixture()
def small_skew_limits(spark):
    """Limits of the adaptive skew handling, scaled down to test data."""
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16384",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield
    for name in limits:
        spark.conf.unset(name)


@pytest.mark.parametrize("join", [rel.semi_join, rel.anti_join, rel.enrich])
def test_a_concept_with_a_third_of_the_members_is_split(spark, join, small_skew_limits):
    members = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("member_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("concept_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    concepts = spark.range(0, 40_000, 1, 4).select(F.col("id").alias("concept_id"))
    joined = join(members, concepts, ["concept_id"])
    missing = sum(1 for n in range(40_000, 60_000) if n % 3)
    expected = {rel.semi_join: 60_000 - missing, rel.anti_join: missing, rel.enrich: 60_000}[join]
    assert len(joined.collect()) == expected
    assert "skew=true" in plan(joined)


def test_many_versions_of_one_member_leave_a_task_once(spark):
    """A member with a third of the history is combined before the shuffle."""
    hot = spark.range(0, 200_000, 1, 8).select(
        F.lit("hot").alias("member_id"),
        F.date_add(F.lit(Q.DELTA_DAY), F.col("id").cast("int") % 900).alias("effective_date"),
        (F.col("id") % 2).cast("int").alias("active"),
        F.lit(0).cast("bigint").alias("refset_id"),
        F.lit(7).cast("bigint").alias("concept_id"),
        F.lit("hot").alias("map_target"),
    )
    found = history.snapshot(hot, ["member_id", *Q.MAP_KEY])
    rows = found.collect()
    assert len(rows) == 1
    final = found._jdf.queryExecution().executedPlan()
    spark_plan = final.toString()
    assert "partial_max_by" in spark_plan
    written = _shuffled_rows(final)
    assert written <= 8


def _shuffled_rows(physical) -> int:
    """Rows written by the only shuffle of an adaptive plan that has run."""
    node = physical.executedPlan() if "AdaptiveSparkPlan" in physical.nodeName() else physical
    todo, total = [node], 0
    while todo:
        node = todo.pop()
        if "ShuffleQueryStage" in node.nodeName():
            node = node.plan()
        metrics = node.metrics()
        if metrics.contains("shuffleRecordsWritten"):
            total += metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return total
