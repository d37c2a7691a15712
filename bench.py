"""Time the headline queries and print one JSON line.

Every query runs to the end through the no-op sink, so all rows and columns
are computed. Each runs twice and the better time counts; the first run pays
for class loading and code generation.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from termledger import schemas
from termledger.plans import queries as Q
from termledger.sources.writers import write_rf2

HEADLINE = [
    "snapshot_map",
    "snapshot_lang",
    "snapshot_asof",
    "append_union",
    "rf_map_snapshot",
    "rf_lang_updated",
    "rf_refset_add",
    "release_change_counts",
    "active_counts",
    "is_a_closure",
    "concept_synonym",
    "description_active",
    "attribute_pairs",
    "map_target_set",
    "dedupe_first",
    "fd_violations",
    "count_distinct",
    "dq_inactive_refs",
    "reconcile_counts",
    "invalid_ids",
    "generated_check_digits",
]
RUNS = 2


def export_map(spark, sf_dir: str, folder: str) -> None:
    """Print the map history as a release file."""
    members = Q.fx.fx_map_full(spark, sf_dir).selectExpr(
        "member_id",
        "effective_date",
        "active",
        "21000210109 as module_id",
        "refset_id",
        "concept_id as referenced_component_id",
        "map_target",
    )
    write_rf2(members, f"{folder}/map.txt", schemas.SIMPLE_MAP)


def best(run) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="termledger-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {
        name: best(
            lambda name=name: Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
        for name in HEADLINE
    }
    times["export_map"] = best(lambda: export_map(spark, sf_dir, folder))
    result = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
