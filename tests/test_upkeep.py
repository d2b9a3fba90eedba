"""Roll-ups in one pass, and the upkept store against models built anew."""

from __future__ import annotations

import os
import random

import pytest
from builders import adjustment, contractor, job, payout, raw_tables, service, user
from conftest import SF_SMALL

from bazaar.operators import kpis, rollups
from bazaar.plans.graph import Marketplace
from bazaar.plans.upkeep import JOB_TABLES, STATES, MarketStore
from bazaar.sources import SnapshotConflict, manifest
from bazaar.sources.schemas import RAW_SCHEMAS

SCORECARDS = ("contractor_performance_summary", "customer_health_summary", "service_category_performance")


def rows(df):
    return sorted(map(repr, df.collect()))


def assert_same(view, plain, names=("fct_jobs", *SCORECARDS)):
    for name in names:
        got, want = view.model(name), plain.model(name)
        assert got.schema.simpleString() == want.schema.simpleString(), name
        assert rows(got) == rows(want), name
    assert rows(view.kpis) == rows(kpis.marketplace_kpis(plain.fct_jobs))
    assert rows(view.reference_date) == rows(plain.reference_date)


def made(rng):
    """Rows of the six tables: jobs without service, payouts before their job, jobs with many adjustments."""
    day = lambda: f"2024-{rng.randint(1, 6):02d}-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:00:00"
    status = lambda: rng.choice(["completed", "completed", "canceled_by_customer", "canceled_by_contractor"])
    jobs = list(range(1, 41))
    return {
        "users": [user(i, suspended=i % 7 == 0) for i in range(1, 16)],
        "contractor_profiles": [contractor(i, rng.choice(["standard", "premium"])) for i in range(1, 6)],
        "services": [service(i, 1 + i % 5, rng.choice(["plumbing", "cleaning", None])) for i in range(1, 9)],
        "jobs": [
            job(j, rng.randint(1, 9), rng.randint(1, 6), rng.randint(6, 16), day(), day(), status(), gross=rng.randint(1, 999) / 4)
            for j in jobs
        ],
        "payouts": [payout(i, rng.randint(1, 5), rng.choice(jobs + [99]), day(), 0.2, i * 1.37) for i in range(50)],
        "adjustments": [
            adjustment(i, 1 if i % 3 == 0 else rng.choice(jobs), day(), rng.choice(["full_refund", "partial_refund", "goodwill_bonus"]), i + 0.5)
            for i in range(40)
        ],
    }


def framed(spark, tables):
    return {name: spark.createDataFrame(found, RAW_SCHEMAS[name]) for name, found in tables.items() if found}


@pytest.fixture
def at(tmp_path):
    return f"file://{tmp_path}/store"


def test_one_pass_gives_the_scorecards_and_kpis(spark):
    m = Marketplace.load(spark, SF_SMALL)
    states = rollups.job_states(m.fct_jobs)
    assert rows(rollups.contractor_job_stats(states)) == rows(m.contractor_job_stats)
    assert rows(rollups.customer_job_stats(states)) == rows(m.customer_job_stats)
    assert rows(rollups.service_category_demand(states)) == rows(m.service_category_demand)
    assert rows(rollups.marketplace_kpis(states)) == rows(kpis.marketplace_kpis(m.fct_jobs))
    # the parts' states add up to those of the whole
    parts = rollups.merged(rollups.job_states(m.fct_jobs.withColumn("part", m.fct_jobs.job_id % 7), "part"))
    assert rows(rollups.job_rollups(parts)) == rows(rollups.job_rollups(states))


def test_no_jobs(spark, at):
    m = Marketplace(raw_tables(spark, users=[user(1)]))
    states = rollups.job_states(m.fct_jobs)
    assert rows(rollups.marketplace_kpis(states)) == rows(kpis.marketplace_kpis(m.fct_jobs))
    store = MarketStore(spark, at, buckets=3)
    assert store.read().fct_jobs.count() == 0
    assert store.apply({"users": m.raw["users"]}) == set()
    assert_same(store.read(), m)


def test_batches_in_any_order_equal_a_rebuild(spark, at):
    rng = random.Random(5)
    tables = made(rng)
    batches = [{name: [] for name in RAW_SCHEMAS} for _ in range(3)]
    for name, found in tables.items():
        for row in found:
            rng.choice(batches)[name].append(row)
    store = MarketStore(spark, at, buckets=3)
    for batch in batches:
        store.apply(framed(spark, batch))
    assert_same(store.read(), Marketplace(raw_tables(spark, **tables)))


def test_changed_rows_are_retracted_and_other_buckets_stay(spark, at):
    rng = random.Random(6)
    tables = made(rng)
    store = MarketStore(spark, at, buckets=16)
    every = store.apply(framed(spark, tables))
    first = manifest(spark, at)[1]["parts"]
    pinned = store.read()
    before = rows(pinned.contractor_performance_summary)
    # an adjustment moves to another job, a payout grows, a job is canceled; a new adjustment comes late
    change = {
        "adjustments": [adjustment(7, 2, "2024-05-05 00:00:00", "partial_refund", 3.25), adjustment(70, 3, "2024-06-20 00:00:00", "full_refund", 9.0)],
        "payouts": [payout(4, 1, tables["payouts"][4][2], "2024-03-03 00:00:00", 0.2, 500.0)],
        "jobs": [job(5, 1, 1, 6, "2024-02-02 00:00:00", None, "canceled_by_customer")],
    }

    def upsert(changes):
        for name, changed in changes.items():
            keys = {r[0] for r in changed}
            tables[name] = [r for r in tables[name] if r[0] not in keys] + changed

    touched = store.apply(framed(spark, change))
    upsert(change)
    assert 0 < len(touched) <= 6 < len(every)
    second = manifest(spark, at)[1]["parts"]
    for part in (*JOB_TABLES, STATES):
        for bucket, folder in first[part].items():
            assert (second[part].get(bucket) != folder) == (int(bucket) in touched)
    assert_same(store.read(), Marketplace(raw_tables(spark, **tables)))
    assert rows(pinned.contractor_performance_summary) == before

    # a service changes its category: the buckets of its jobs follow
    change = {"services": [service(3, 2, "gardening")]}
    touched = store.apply(framed(spark, change))
    upsert(change)
    jobs = spark.createDataFrame(tables["jobs"], RAW_SCHEMAS["jobs"]).where("service_id = 3")
    assert touched == {r[0] for r in jobs.selectExpr("cast(pmod(xxhash64(job_id), 16) as int)").distinct().collect()}
    assert_same(store.read(), Marketplace(raw_tables(spark, **tables)))

    # a batch that dies, or was made for an older version, changes nothing
    want = rows(store.read().fct_jobs)
    late = spark.createDataFrame([adjustment(90, 1, "2024-06-21 00:00:00", "full_refund", 1.0)], RAW_SCHEMAS["adjustments"])
    broken = late.selectExpr("adjustment_id", "raise_error('executor lost') + job_id AS job_id", *late.columns[2:])
    with pytest.raises(Exception, match="executor lost"):
        store.apply({"adjustments": broken})
    with pytest.raises(SnapshotConflict):
        store.apply({"adjustments": late}, base=2)
    assert store.version() == 3 and rows(store.read().fct_jobs) == want
    with pytest.raises(ValueError, match="orders"):
        store.apply({"orders": late})

    assert store.expire() == [1, 2]
    assert rows(store.read().fct_jobs) == want
    folders = [f for found in manifest(spark, at)[1]["parts"].values() for f in found.values()]
    here = at.removeprefix("file://")
    assert all(os.path.isdir(f"{here}/{f}") for f in folders)


def test_a_batch_of_payouts_or_adjustments_moves_nothing_else(spark, at):
    tables = made(random.Random(7))
    # repeated and absent keys
    tables["jobs"] += [tables["jobs"][4], job(None, 1, 1, 6, "2024-02-02 00:00:00", None)]
    tables["payouts"] += [payout(200, 1, None, "2024-03-03 00:00:00", 0.2, 5.0)]
    tables["adjustments"] += [adjustment(None, 3, "2024-03-03 00:00:00", "full_refund", 2.5)]
    late = {"adjustments": [adjustment(300 + i, i, "2024-06-20 00:00:00", "full_refund", i + 0.25) for i in range(1, 41, 2)]}
    late["adjustments"] += [adjustment(299, None, "2024-06-20 00:00:00", "full_refund", 1.0), tables["adjustments"][3]]
    paid = {"payouts": [payout(i, 2, None if i == 8 else 1 + i % 5, "2024-06-21 00:00:00", 0.2, 70.5) for i in range(5, 9)]}
    store = MarketStore(spark, at, buckets=4)
    store.apply(framed(spark, tables))
    first = manifest(spark, at)[1]["parts"]
    for batch, child, others in ((late, "adjustments", ("jobs", "payouts")), (paid, "payouts", ("jobs", "adjustments"))):
        before = manifest(spark, at)[1]["parts"]
        store.apply(framed(spark, batch))
        after = manifest(spark, at)[1]["parts"]
        assert all(after[t] == before[t] for t in others) and after[child] != before[child]
        keys = {r[0] for r in batch[child]} - {None}
        tables[child] = [r for r in tables[child] if r[0] not in keys] + batch[child]
        assert_same(store.read(), Marketplace(raw_tables(spark, **tables)))
    # the first rows of a table are written once, as its buckets
    assert not [f for found in first.values() for f in found.values() if "/batch/" in f]


def test_states_of_parts_are_grouped_where_they_are(spark):
    facts = Marketplace.load(spark, SF_SMALL).fct_jobs.selectExpr("*", "job_id % 7 AS part")
    placed = spark.createDataFrame(facts.limit(50).collect(), facts.schema).repartition("part")
    plan = rollups.job_states(placed, "part")._jdf.queryExecution().sparkPlan().toString()
    executed = rollups.job_states(placed, "part")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan and executed.count("Exchange hashpartitioning") == 1
