"""Shares, ranges and seasons of the specification (I2) against plain Python and planted cases."""

from __future__ import annotations

import math
import random

from builders import adjustment, contractor, job, marketplace, payout, service, user

from bazaar.operators import distributions as ds


def _market(spark, jobs, kinds=("cleaning", "plumbing", "landscaping", "electrical")):
    services = [service(k + 1, 9, c, 50.0) for k, c in enumerate(kinds)]
    return marketplace(
        spark, users=[user(1), user(9)], contractor_profiles=[contractor(9)], services=services, jobs=jobs,
        adjustments=[adjustment(1, 1, "2024-04-02 00:00:00", "partial_refund", 20.0)],
        payouts=[payout(1, 9, 1, "2024-04-09 00:00:00", 0.2, 140.0)],
    )


def test_shares_equal_a_plain_version(spark):
    rng = random.Random(2)
    kinds = rng.choices(["cleaning", " Plumbing", "landscaping", "electrical"], [50, 25, 10, 15], k=400)
    jobs = [job(k, 1, 9, 1, "2024-04-01 10:00:00", status=rng.choices(["completed", "canceled_by_customer"], [85, 15])[0]) for k in range(600)]
    m = _market(spark, jobs, kinds)
    got = {(r.rule, r.category): r for r in ds.specification_shares(m.staged_sources).collect()}
    assert len(got) == 13
    names = [k.strip().lower() for k in kinds]
    pearson = 0.0
    for c, p in (("cleaning", 0.35), ("plumbing", 0.25), ("electrical", 0.2), ("landscaping", 0.2)):
        r, seen = got["service_category", c], names.count(c)
        assert (r.observed, r.total) == (seen, 400)
        assert math.isclose(r.statistic, (seen - 400 * p) ** 2 / (400 * p * (1 - p)), abs_tol=1e-6)
        assert r.passed == (r.statistic <= 10.828)
        pearson += (seen - 400 * p) ** 2 / (400 * p)
    whole = got["service_category", "all"]
    assert math.isclose(whole.statistic, pearson, abs_tol=1e-5) and not whole.passed  # half are cleaning
    canceled = got["jobs_canceled", "canceled"]
    assert canceled.observed == sum(j[6].startswith("canceled") for j in jobs) and canceled.passed and canceled.statistic == 0
    assert not got["jobs_adjusted", "adjusted"].passed  # one adjustment of about 500 jobs


def test_rates_outside_their_range(spark):
    services = [service(1, 9, "cleaning", 25.0), service(2, 9, "Cleaning", 61.0), service(3, 9, "plumbing", None), service(4, 9, None, 1.0)]
    m = _market(spark, [job(1, 1, 9, 1, "2024-04-01 10:00:00")])
    frame = spark.createDataFrame(services, m.stg_services.schema)
    got = {r.service_category: r for r in ds.rate_ranges(frame).collect()}
    assert (got["cleaning"].services, got["cleaning"].violations, got["cleaning"].highest_rate) == (2, 1, 61.0)
    assert (got["plumbing"].services, got["plumbing"].violations, got["plumbing"].lowest_rate) == (0, 0, None)


def _year(rng, lifts, n=24_000):
    """Jobs of 2024 with a trend over the year, and categories that are ``lifts`` higher in some months."""
    out = []
    for k in range(n):
        month = rng.choices(range(1, 13), [10 + m for m in range(12)])[0]
        weights = [lifts.get((s, month), 1.0) for s in range(1, 5)]
        s = rng.choices(range(1, 5), weights)[0]
        out.append(job(k, s, 9, 1, f"2024-{month:02d}-10 10:00:00"))
    return out


def test_planted_seasons_are_found(spark):
    rng = random.Random(7)
    lifts = {(3, m): 1.4 for m in (6, 7, 8)} | {(1, 12): 1.3}
    m = _market(spark, _year(rng, lifts))
    got = {r.service_category: r for r in ds.specification_seasons(m.stg_jobs, m.stg_services).collect()}
    assert all(r.passed for r in got.values()) and 1.25 < got["landscaping"].lift < 1.6
    index = {(r.service_category, r.month): r for r in ds.seasonal_index(m.stg_jobs, m.stg_services).collect()}
    assert sum(r.jobs for r in index.values()) == 24_000
    summer = [index["landscaping", k].seasonal_index for k in (6, 7, 8)]
    assert min(summer) > 1.15 > max(index["plumbing", k].seasonal_index for k in range(1, 13))
    r = got["landscaping"]
    plain = r.in_season * r.others_off_season / (r.others_in_season * r.off_season)
    spread = 1 / r.in_season + 1 / r.others_in_season + 1 / r.off_season + 1 / r.others_off_season
    assert math.isclose(r.lift, plain, abs_tol=1e-6)
    assert math.isclose(r.statistic, (math.log(plain) - math.log(1.4)) ** 2 / spread, abs_tol=1e-5)


def test_a_year_without_seasons_fails(spark):
    m = _market(spark, _year(random.Random(8), {}))
    assert not any(r.passed for r in ds.specification_seasons(m.stg_jobs, m.stg_services).collect())


def test_no_rows(spark):
    m = _market(spark, [])
    none = {k: v.where("false") for k, v in m.staged_sources.items()}
    assert all(r.passed and r.statistic is None for r in ds.specification_shares(none).collect())
    assert all(r.passed and r.lift is None for r in ds.specification_seasons(none["jobs"], none["services"]).collect())
    assert ds.seasonal_index(none["jobs"], none["services"]).collect() == []
    assert all(r.services == 0 for r in ds.rate_ranges(none["services"]).collect())
