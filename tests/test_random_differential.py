"""Randomized differential test: Spark models vs the DuckDB oracle on messy raw tables.

The fixture data is clean (valid enums, no NULL flags, every key resolves).
Here the raw tables carry NULLs, padded and mixed-case strings, unknown
enums, orphan and NULL keys, jobs completed before they were requested,
payout-less completions, commission 1.0, and duplicate user, contractor and
service keys.
"""

from __future__ import annotations

import os
import random
import tempfile
from datetime import datetime, timedelta

import duckdb
import pytest
from oracle_compare import _rows

from bazaar.plans.graph import Marketplace
from bazaar.sources.schemas import RAW_SCHEMAS
from oracle.checks import RECONCILE_CTES
from oracle.models import MODEL_CTES

MODELS = (
    "int_jobs_enriched",
    "int_payouts_enriched",
    "int_adjustments_enriched",
    "int_services_enriched",
    "int_users_enriched",
    "int_contractor_profiles_enriched",
    "fct_jobs",
    "fct_payouts",
    "fct_adjustments",
    "dim_contractors",
    "contractor_performance_summary",
    "customer_health_summary",
    "service_category_performance",
)


def _cents(rnd, lo, hi):
    return rnd.randint(lo, hi) / 100


def _raw(seed: int) -> dict[str, list[tuple]]:
    rnd = random.Random(seed)
    pick = rnd.choice
    t0 = datetime(2024, 1, 1)

    def ts():
        return t0 + timedelta(minutes=rnd.randint(0, 400_000))

    def maybe(v, p=0.1):
        return None if rnd.random() < p else v

    users = [
        (uid, ts(), maybe(rnd.random() < 0.8), maybe(rnd.random() < 0.1), maybe(pick(["NYC", " LA ", "Chicago", "\tPhoenix"])))
        for uid in range(1, 41)
    ]
    profiles = [
        (uid, maybe(pick(["standard", " Premium", "PREMIUM ", "gold"])), maybe(pick([0.2, 0.15, 1.0])), maybe(True), maybe(rnd.random() < 0.9))
        for uid in range(31, 41)
    ]
    services = [
        (sid, pick(list(range(31, 43))), maybe(pick(["Cleaning ", "plumbing", "ELECTRICAL", " landscaping", "gardening"])),
         maybe(float(pick([30, 74.99, 75, 99.5, 124.99, 125, 160]))), ts(), maybe(rnd.random() < 0.8))
        for sid in range(1, 21)
    ]
    jobs = []
    for jid in range(1, 151):
        status = maybe(pick(["completed", " Completed ", "canceled_by_customer", "CANCELED_BY_CONTRACTOR", "paused"]), 0.05)
        req = maybe(ts(), 0.03)
        done = req + timedelta(minutes=rnd.randint(-120, 5000)) if req and rnd.random() < 0.8 else None
        jobs.append(
            (jid, maybe(rnd.randint(1, 23), 0.05), maybe(rnd.randint(31, 42), 0.05), maybe(rnd.randint(1, 45), 0.05), req, done,
             status, _cents(rnd, 100, 800), maybe(_cents(rnd, 50, 1000), 0.2), maybe(_cents(rnd, 1000, 90000), 0.2))
        )
    adjustments = [
        (aid, maybe(rnd.randint(1, 155), 0.05), maybe(ts(), 0.05), maybe(pick(["partial_refund", "Full_Refund", "goodwill_bonus ", "chargeback"]), 0.05),
         maybe(_cents(rnd, 1, 30000), 0.05))
        for aid in range(1, 51)
    ]
    payouts = [
        (pid, maybe(rnd.randint(31, 42), 0.05), maybe(rnd.randint(1, 155), 0.05), maybe(ts(), 0.05), maybe(pick([0.2, 0.15, 1.0]), 0.05),
         maybe(_cents(rnd, 0, 80000), 0.05), maybe(pick(["completed", " Pending", "PENDING", "held"]), 0.05))
        for pid in range(1, 71)
    ]
    users += [(uid, ts(), True, False, "Chicago") for uid in (3, 35)]
    profiles += [(36, "standard", 0.2, True, True)]
    services += [(sid, 37, "plumbing", 80.0, ts(), True) for sid in (4, 9)]
    return {
        "users": users,
        "contractor_profiles": profiles,
        "services": services,
        "jobs": jobs,
        "adjustments": adjustments,
        "payouts": payouts,
    }


@pytest.fixture(scope="module", params=[11, 29])
def messy(spark, request):
    rows = _raw(request.param)
    directory = tempfile.mkdtemp(prefix="bazaar-messy-")
    for name, schema in RAW_SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).coalesce(1).write.parquet(os.path.join(directory, f"{name}.parquet"))
    return directory


def _oracle(directory: str, model: str):
    raw = ",\n".join(
        f"raw_{name} AS (SELECT * FROM read_parquet('{os.path.join(directory, name + '.parquet')}/*.parquet'))"
        for name in RAW_SCHEMAS
    )
    sql = f"WITH {raw},\n{MODEL_CTES.strip()},\n{RECONCILE_CTES.strip()}\nSELECT * FROM {model}"
    return duckdb.connect().sql(sql).to_arrow_table()


@pytest.mark.parametrize("model", MODELS)
def test_model_matches_oracle_on_messy_data(spark, messy, model):
    m = Marketplace.load(spark, messy)
    got = m.model(model).toArrow()
    want = _oracle(messy, model)
    assert sorted(got.column_names) == sorted(want.column_names)
    assert got.num_rows == want.num_rows
    assert _rows(got) == _rows(want)


JOBS = (
    "reconcile_payouts",
    "adjustments_after_payout",
    "kpi_marketplace",
    "dq_summary",
    "integrity_sources",
    "integrity_rules",
    "profile_table",
    "agg_functions",
    "scalar_functions",
)


def _oracle_select(directory: str, select: str):
    raw = ",\n".join(
        f"raw_{name} AS (SELECT * FROM read_parquet('{os.path.join(directory, name + '.parquet')}/*.parquet'))"
        for name in RAW_SCHEMAS
    )
    sql = f"WITH {raw},\n{MODEL_CTES.strip()},\n{RECONCILE_CTES.strip()}\n{select}"
    return duckdb.connect().sql(sql).to_arrow_table()


@pytest.mark.parametrize("job", JOBS)
def test_job_matches_oracle_on_messy_data(spark, messy, job):
    from bazaar.plans.registry import JOB_QUERIES
    from oracle.checks import CHECK_SQL

    got = JOB_QUERIES[job](Marketplace.load(spark, messy)).toArrow()
    want = _oracle_select(messy, CHECK_SQL[job])
    assert sorted(got.column_names) == sorted(want.column_names)
    assert got.num_rows == want.num_rows
    assert _rows(got) == _rows(want)
