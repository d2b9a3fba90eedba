"""Plan-shape regressions: the properties the scale design relies on.

Broadcasting is disabled so that every join is planned as it would be when
the dimensions are too large to broadcast (the 100 TB case).
"""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL

from bazaar.plans.graph import Marketplace
from bazaar.plans.registry import queries

LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def written_sources(spark, tmp_path_factory):
    from bazaar.sources import load_sources, write_sources

    path = str(tmp_path_factory.mktemp("sources"))
    write_sources(load_sources(spark, SF_SMALL), path)
    return path


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# the declared data tests write models, test the files and return held rows
LAZY = sorted(
    n for n in queries() if n not in ("dq_unique", "dq_not_null", "dq_accepted_values", "dq_relationships", "dq_summary")
)


def _exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_or_nested_loop_join(no_broadcast, name):
    plan = _plan(queries()[name](no_broadcast, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fct_jobs_on_plain_files(no_broadcast, written_sources):
    plan = _plan(queries()["fct_jobs"](no_broadcast, written_sources))
    # jobs, payouts and adjustments on job_id, then the fact and a dimension for each of three lookups
    assert _exchanges(plan) == 9 and plan.count("SortMergeJoin") == 5
    # both job-grain roll-ups aggregate map-side before their shuffle
    assert plan.count("HashAggregate(keys=[job_id") >= 4


def test_fct_jobs_on_bucketed_files_has_no_job_id_exchange(no_broadcast, tmp_path):
    from bazaar.sources import load_sources, read_bucketed, write_bucketed

    folder = f"file://{tmp_path}/bucketed"
    m = Marketplace(write_bucketed(load_sources(no_broadcast, SF_SMALL), folder, buckets=4))
    plan = _plan(m.fct_jobs)
    # the fact moves for its three lookups only; the job-grain tables meet where they are
    assert "Exchange hashpartitioning(job_id" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\((?:service|contractor|customer)_id", plan)) <= 6
    assert m.fct_jobs.count() == 1500
    again = Marketplace(read_bucketed(no_broadcast, folder, buckets=4))
    assert "Exchange" not in _plan(again.payouts_by_job)
    assert Marketplace.load(no_broadcast, folder).fct_jobs.exceptAll(again.fct_jobs).count() == 0


def test_scans_are_pruned_and_filters_pushed(spark, written_sources):
    m = Marketplace.load(spark, written_sources)
    from bazaar.operators import quality
    from bazaar.operators.kpis import marketplace_kpis

    plan = _plan(marketplace_kpis(m.fct_jobs))
    jobs_scan = [line for line in plan.splitlines() if "jobs.parquet" in line][0]
    assert "estimated_hours" not in jobs_scan and "job_requested_at" not in jobs_scan
    plan = _plan(quality.singular_test_rows(m.model, "assert_adjustment_amounts_positive"))
    assert "PushedFilters: [IsNotNull(adjustment_amount)" in plan


def test_scorecards_read_the_fact(spark, tmp_path):
    """What the fact holds is what they aggregate, whatever the raw tables say."""
    m = Marketplace.load(spark, SF_SMALL)
    half = m.replaced({"fct_jobs": m.fct_jobs.where("job_id % 2 = 0")})
    n = half.fct_jobs.count()
    assert half.contractor_performance_summary.agg({"total_jobs": "sum"}).first()[0] == n
    assert half.service_category_performance.agg({"total_jobs": "sum"}).first()[0] == n
    assert half.customer_health_summary.agg({"total_jobs": "sum"}).first()[0] == n


def test_never_ordered_combines_customers_before_the_exchange(no_broadcast, written_sources):
    plan = _plan(queries()["customers_never_ordered"](no_broadcast, written_sources))
    assert len(re.findall(r"HashAggregate\(keys=\[(?:customer_id|user_id)", plan)) >= 2


def test_profile_never_shuffles_rows(no_broadcast, written_sources):
    plan = _plan(queries()["profile_table"](no_broadcast, written_sources))
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "h1" in line and "h2" in line


def test_integrity_scans_each_table_once(no_broadcast, written_sources):
    plan = _plan(queries()["integrity_sources"](no_broadcast, written_sources))
    assert plan.count("FileScan") == 6 and _exchanges(plan) == 1 and "Join" not in plan
    plan = _plan(queries()["integrity_rules"](no_broadcast, written_sources))
    assert plan.count("FileScan") <= 13


def test_data_tests_scan_each_model_once(no_broadcast, written_sources):
    from bazaar.operators import quality
    from bazaar.session import RunFolder

    m = Marketplace.load(no_broadcast, written_sources)
    with RunFolder(no_broadcast, "plan") as run:
        files = m.as_files(run)
        files.register_views(prefix="planned_")
        plan = _plan(no_broadcast.sql(quality.suite_sql(singular=True, view="planned_")))
        # one scan per tested model and parent, and what the models that are read once join
        assert plan.count("FileScan") <= 38
        assert "DISTINCT CASE" not in quality.suite_sql()  # which would copy every row per column
        for name in m.files_for(quality.models_under_test()):
            no_broadcast.catalog.dropTempView(f"planned_{name}")


def test_reconciliation_writes_nothing(no_broadcast, written_sources):
    import glob

    before = set(glob.glob(f"{no_broadcast.sparkContext.getCheckpointDir()}/**", recursive=True))
    df = queries()["reconcile_payouts"](no_broadcast, written_sources)
    df.collect()
    assert set(glob.glob(f"{no_broadcast.sparkContext.getCheckpointDir()}/**", recursive=True)) == before
