"""The pipeline, stage by stage, against what each stage promises."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from termledger.llm import simhash
from termledger.llm.common import load
from termledger.llm.queries import SHARDS
from termledger.session import StepFolder


def test_stages(spark, tiny, tmp_path):
    docs = load(spark, tiny, "documents")
    item = load(spark, tiny, "benchmark").first().text
    toxic = load(spark, tiny, "labels").where("toxic = 1")
    extra = spark.createDataFrame(
        [(None, None, None, None, None), (None, "a text of its own without an id", None, None, None), (900001, "", "en", "src1", 0), (900002, f"Before.\n{item}\nAfter", "en", "src2", 9),
         (900003, docs.first().text, "en", "src3", 1)],
        docs.schema,
    )
    seen, after = docs.unionByName(extra), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(pipeline.STAGES):
        seen.write.parquet(f"{tmp_path}/{k}")
        seen = after[name] = stage(spark, spark.read.parquet(f"{tmp_path}/{k}"), tiny)
        assert set(columns) <= set(seen.columns)
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in after.items()}
    assert ids["toxicity"] >= ids["near_duplicates"] >= ids["decontamination"] >= ids["mixing"] == ids["sharding"]
    # the null text is a near copy of the empty one: fingerprint zero
    texts = {(r.doc_id, r.text) for r in after["near_duplicates"].select("doc_id", "text").collect()}
    assert (None, None) not in texts and (None, "a text of its own without an id") in texts
    assert None in ids["decontamination"] and 900001 in ids["toxicity"]
    clean = docs.join(toxic, "doc_id", "left_anti").count()
    assert len(ids["toxicity"]) >= 0.95 * clean
    assert 900002 in ids["near_duplicates"] and 900002 not in ids["decontamination"]
    assert 900003 in ids["toxicity"] and 900003 not in ids["near_duplicates"]
    kept = simhash.near_duplicates(after["near_duplicates"].where("doc_id is not null"))
    assert kept.where("doc_id != component_id").count() == 0
    assert {r.shard for r in after["sharding"].select("shard").distinct().collect()} <= set(SHARDS)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), tiny).count() == 0


def test_clashing_columns_and_repeated_rows(spark, tiny):
    """Columns named like helpers, and a map, come through; repeated rows and
    rows without an id are told apart by their texts."""
    docs = load(spark, tiny, "documents").limit(60)
    extra = spark.createDataFrame(
        [(None, "a row without an id, the first of two", "en", "src1", 1),
         (None, "another text that has no id either, quite unlike it", "en", "src1", 1),
         (700001, "twice the same row with the same id", "de", "src2", 2),
         (700001, "twice the same row with the same id", "de", "src2", 2)],
        docs.schema,
    )
    docs = docs.unionByName(extra)
    for name in ("_key", "_copy", "_repeats", "_digest", "key", "row", "place", "a.b", "component_id"):
        docs = docs.withColumn(name, F.lit("kept"))
    docs = docs.withColumn("tags", F.create_map(F.lit("x"), F.lit(1), F.lit("y"), F.lit(None).cast("int")))
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, tiny)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        rows = out.collect()
        assert all(r["_key"] == r["row"] == r["a.b"] == "kept" and r["tags"] == {"x": 1, "y": None} for r in rows), name
        if name == "near_duplicates":
            assert sum(r["doc_id"] is None for r in rows) == 2
            assert sum(r["doc_id"] == 700001 for r in rows) == 1


def test_near_duplicates_stage_broadcasts_no_keys(spark, tiny, monkeypatch):
    """20,000 texts have 1.3 million keys, which the planner takes for as small as
    the texts' fingerprints; the driver would hold them all."""
    rows = spark.range(20_000).selectExpr("id as doc_id", "concat('word', id % 19000, ' of a text') as text")
    rows = rows.selectExpr("doc_id", "text", "'en' as lang", "'src' as source", "1L as n_chars")
    joined, write = [], StepFolder.write

    def kept(self, df, *args, **kwargs):
        if df.columns[0] == "k":
            joined.append(df)
        return write(self, df, *args, **kwargs)

    monkeypatch.setattr(StepFolder, "write", kept)
    assert pipeline.near_duplicates(spark, rows, tiny).count() == 19_000
    (shared,) = joined
    shared.collect()
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "BroadcastExchange" not in plan
