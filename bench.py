"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Flow, as in production: the six raw marketplace tables are written once as
Parquet, bucketed on their layout keys (``materialize_sources``, timed once and
shown beside the total), then every query reads them. Each query is built and
executed to completion with the ``noop`` sink three times, and its median counts;
the graph is built anew each time, so nothing is kept between runs.

``--oracle`` additionally times the DuckDB oracle SQL on the same host and
prints it to stderr.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

RUNS = 3
HEADLINE = (
    "fct_jobs",
    "fct_payouts",
    "fct_adjustments",
    "dim_contractors",
    "contractor_performance_summary",
    "customer_health_summary",
    "service_category_performance",
    "kpi_marketplace",
    "reconcile_payouts",
    "adjustments_after_payout",
    "integrity_sources",
    "integrity_rules",
    "profile_table",
    "dq_summary",
)
#: Timed over the stored fact; their figures up to round 2 include computing it.
READ_STORED_FACT = (
    "contractor_performance_summary",
    "customer_health_summary",
    "service_category_performance",
    "kpi_marketplace",
)


def _sf_of(path: str) -> str:
    m = re.search(r"sf([0-9.]+)", path)
    return m.group(1) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    with_oracle = "--oracle" in sys.argv

    from bazaar.plans import Marketplace
    from bazaar.plans.registry import queries, run_on
    from bazaar.session import build_session
    from bazaar.sources import load_sources, read_bucketed, write_bucketed

    scratch = tempfile.mkdtemp(prefix="bazaar-bench-", dir=os.environ.get("BENCH_TMP", "/tmp"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="bazaar-bench",
        shuffle_partitions=cpus * 2,
        conf={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
        },
    )
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    registry = queries()
    # warm-up on the smallest fixture: JVM start-up, JIT and class loading, not timed
    registry["fct_jobs"](spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")).write.format(
        "noop"
    ).mode("overwrite").save()

    timings: dict[str, float] = {}
    sources_dir = os.path.join(scratch, "sources")
    t0 = time.perf_counter()
    write_bucketed(load_sources(spark, sf_dir), sources_dir, buckets=cpus)
    timings["materialize_sources"] = round(time.perf_counter() - t0, 3)

    # as in a build, the scorecards and KPIs read the stored fact
    t0 = time.perf_counter()
    fact = Marketplace(read_bucketed(spark, sources_dir, buckets=cpus)).fct_jobs
    fact.write.parquet(os.path.join(scratch, "fct_jobs"))
    stored = {"fct_jobs": spark.read.schema(fact.schema).parquet(os.path.join(scratch, "fct_jobs"))}
    materialize_fact = round(time.perf_counter() - t0, 3)

    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            graph = Marketplace(
                read_bucketed(spark, sources_dir, buckets=cpus), stored if name in READ_STORED_FACT else None
            )
            run_on(graph, name).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(median(runs), 3)

    total = round(sum(v for k, v in timings.items() if k != "materialize_sources"), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_sec",
                "value": total,
                "unit": "sec",
                "materialize_sources": timings["materialize_sources"],
                "materialize_fact": materialize_fact,
                "read_stored_fact": READ_STORED_FACT,
                "queries": timings,
                "sf": _sf_of(sf_dir),
                "cpus": cpus,
            }
        )
    )
    spark.stop()

    if with_oracle:
        from oracle import oracle_queries
        from tests.oracle_compare import duck_connection

        con = duck_connection(sf_dir)
        sqls = oracle_queries()
        duck = {}
        for name in HEADLINE:
            t0 = time.perf_counter()
            con.sql(sqls[name]).to_arrow_table()
            duck[name] = round(time.perf_counter() - t0, 3)
        print(json.dumps({"oracle": "duckdb", "total": round(sum(duck.values()), 3), "queries": duck}), file=sys.stderr)


if __name__ == "__main__":
    main()
