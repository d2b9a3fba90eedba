"""Hand-built edge cases for the model semantics."""

from __future__ import annotations

from decimal import Decimal

from builders import adjustment, contractor, job, marketplace, payout, service, user


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}


def test_hour_boundaries_not_elapsed_hours(spark):
    m = marketplace(
        spark,
        jobs=[
            job(1, 1, 9, 1, "2024-03-01 10:59:00", "2024-03-01 11:01:00"),
            job(2, 1, 9, 1, "2024-03-01 11:00:00", "2024-03-01 11:59:00"),
            job(3, 1, 9, 1, "2024-03-01 23:30:00", "2024-03-02 00:10:00"),
            job(4, 1, 9, 1, "2024-03-01 08:00:00", status="canceled_by_customer"),
        ],
    )
    got = rows_by(m.int_jobs_enriched, "job_id")
    assert got[1]["job_duration_hours"] == 1
    assert got[2]["job_duration_hours"] == 0
    assert got[3]["job_duration_hours"] == 1
    assert got[4]["job_duration_hours"] is None


def test_derivations_read_raw_source_columns(spark):
    m = marketplace(
        spark,
        contractor_profiles=[contractor(9, " Premium ", 0.15)],
        jobs=[job(1, 1, 9, 1, "2024-03-01 10:00:00", "2024-03-01 12:00:00", est=1.0, act=2.675)],
    )
    c = m.int_contractor_profiles_enriched.collect()[0]
    assert c["contractor_tier"] == "premium" and c["is_premium_tier"] is True
    assert c["commission_rate_pct"] == Decimal("15.00")
    j = m.int_jobs_enriched.collect()[0]
    assert j["hours_variance"] == 2.675 - 1.0  # raw doubles, not the 2-dp decimals


def test_payout_and_adjustment_rollups(spark):
    m = marketplace(
        spark,
        jobs=[
            job(1, 1, 9, 1, "2024-03-01 10:00:00", "2024-03-01 12:00:00", gross=100.0),
            job(2, 1, 9, 1, "2024-03-02 10:00:00", "2024-03-02 12:00:00", gross=50.0),
            job(3, 1, 9, 1, "2024-03-03 10:00:00", status="canceled_by_customer"),
        ],
        payouts=[
            payout(10, 9, 1, "2024-03-10 00:00:00", 0.2, 40.0),
            payout(11, 9, 1, "2024-03-11 00:00:00", 0.2, 40.0, " Pending"),
        ],
        adjustments=[
            adjustment(20, 2, "2024-03-03 00:00:00", "partial_refund", 10.0),
            adjustment(21, 2, "2024-03-04 00:00:00", "goodwill_bonus", 5.0),
        ],
    )
    got = rows_by(m.fct_jobs, "job_id")
    assert got[1]["payout_count"] == 2 and got[1]["has_pending_payout"] is True
    assert got[1]["total_payout_amount_usd"] == Decimal("80.00")
    assert got[1]["total_refund_usd"] == 0 and got[1]["adjustment_count"] == 0
    assert got[1]["has_full_refund"] is False
    # no payout -> payout columns NULL; adjustments roll up, bonus not subtracted from net
    assert got[2]["payout_count"] is None and got[2]["total_payout_amount_usd"] is None
    assert got[2]["total_refund_usd"] == Decimal("10.00") and got[2]["total_bonus_usd"] == Decimal("5.00")
    assert got[2]["net_revenue_usd"] == Decimal("40.00")
    # canceled: NULL gross keeps net NULL
    assert got[3]["gross_amount_usd"] is None and got[3]["net_revenue_usd"] is None


def test_case_fall_through_on_null(spark):
    m = marketplace(
        spark,
        users=[user(1, suspended=None, active=None)],
        services=[
            service(1, 9, rate=None),
            service(2, 9, rate=74.99),
            service(3, 9, rate=75.0),
            service(4, 9, rate=124.99),
            service(5, 9, rate=125.0),
        ],
        adjustments=[adjustment(1, 1, "2024-01-01 00:00:00", "mystery", 1.0)],
    )
    assert m.int_users_enriched.collect()[0]["account_status"] == "inactive"
    tiers = {r["service_id"]: r["rate_tier"] for r in m.int_services_enriched.collect()}
    assert tiers == {1: "premium", 2: "budget", 3: "mid_range", 4: "mid_range", 5: "premium"}
    a = m.int_adjustments_enriched.collect()[0]
    assert a["adjustment_direction"] is None and a["is_refund"] is False


def test_eligibility_three_valued(spark):
    m = marketplace(
        spark,
        contractor_profiles=[contractor(1, onboarded=None, checked=True), contractor(2, onboarded=None, checked=False)],
    )
    got = rows_by(m.int_contractor_profiles_enriched, "contractor_id")
    assert got[1]["is_eligible_to_work"] is None
    assert got[2]["is_eligible_to_work"] is False


def test_commission_rate_one_gives_null_implied_gross(spark):
    m = marketplace(spark, payouts=[payout(1, 9, 1, "2024-01-01 00:00:00", 1.0, 10.0)])
    p = m.int_payouts_enriched.collect()[0]
    assert p["implied_gross_usd"] is None and p["platform_fee_usd"] is None


def test_customer_segments(spark):
    # reference date = latest request = 2024-06-30 10:00
    jobs = [
        job(1, 1, 9, 1, "2024-04-01 10:00:00", status="canceled_by_customer"),  # only canceled: NULL refund rate
        job(2, 1, 9, 2, "2024-04-01 10:00:00", "2024-04-01 12:00:00", gross=600.0),
        job(3, 1, 9, 2, "2024-04-01 10:00:00", "2024-04-01 12:00:00", gross=600.0),
        job(4, 1, 9, 3, "2024-04-01 10:00:00", "2024-04-01 12:00:00", gross=10.0),  # exactly 90 d before
        job(5, 1, 9, 4, "2024-03-31 10:00:00", "2024-03-31 12:00:00", gross=10.0),  # 91 d before
        job(6, 1, 9, 6, "2024-06-30 10:00:00", "2024-06-30 12:00:00", gross=10.0),
    ]
    # customer 7: 2 of 5 canceled by customer = 40.0 (not > 40) -> healthy
    jobs += [job(10 + i, 1, 9, 7, "2024-06-01 10:00:00", "2024-06-01 12:00:00", gross=10.0) for i in range(3)]
    jobs += [job(20 + i, 1, 9, 7, "2024-06-01 10:00:00", status="canceled_by_customer") for i in range(2)]
    m = marketplace(
        spark,
        users=[user(u) for u in (1, 2, 3, 4, 6, 7, 8)] + [user(5, suspended=True, active=False)],
        jobs=jobs,
    )
    seg = {r["customer_id"]: r for r in m.customer_health_summary.collect()}
    assert seg[1]["refund_rate_pct"] is None and seg[1]["customer_cancel_rate_pct"] == 100.0
    assert seg[1]["health_segment"] == "low_engagement"
    assert seg[2]["health_segment"] == "high_value"
    assert seg[3]["health_segment"] == "healthy"
    assert seg[4]["health_segment"] == "at_risk"
    assert seg[5]["health_segment"] == "suspended"
    assert seg[6]["health_segment"] == "healthy"
    assert seg[7]["customer_cancel_rate_pct"] == 40.0 and seg[7]["health_segment"] == "healthy"
    assert seg[8]["health_segment"] == "never_ordered" and seg[8]["total_jobs"] == 0


def test_empty_jobs_gives_null_reference_date(spark):
    m = marketplace(spark, users=[user(1), user(2, suspended=True, active=False)])
    assert m.reference_date.collect()[0]["ref_date"] is None
    seg = {r["customer_id"]: r["health_segment"] for r in m.customer_health_summary.collect()}
    assert seg == {1: "never_ordered", 2: "suspended"}


def test_filter_counts_skip_null_predicates(spark):
    m = marketplace(
        spark,
        jobs=[
            job(1, 1, 9, 1, "2024-04-01 10:00:00", "2024-04-01 12:00:00"),
            (2, 1, 9, 1, None, None, None, 1.0, None, None),
        ],
    )
    stats = m.contractor_job_stats.collect()[0]
    assert stats["total_jobs"] == 2 and stats["completed_jobs"] == 1 and stats["canceled_jobs"] == 0
    assert stats["completion_rate_pct"] == 50.0


def test_contractor_without_jobs_or_services(spark):
    m = marketplace(spark, users=[user(9)], contractor_profiles=[contractor(9)])
    r = m.contractor_performance_summary.collect()[0]
    assert r["total_jobs"] == 0 and r["total_services"] == 0 and r["total_gross_usd"] == 0
    assert r["completion_rate_pct"] is None and r["avg_job_gross_usd"] is None and r["city"] == "NYC"


def test_category_full_outer_join(spark):
    m = marketplace(
        spark,
        services=[service(1, 9, "plumbing"), service(2, 9, None), service(3, 8, "cleaning")],
        jobs=[
            job(1, 1, 9, 1, "2024-04-01 10:00:00", "2024-04-01 12:00:00"),
            job(2, 2, 9, 1, "2024-04-01 10:00:00", "2024-04-01 12:00:00"),  # NULL category: not in demand
            job(3, 99, 9, 1, "2024-04-01 10:00:00", "2024-04-01 12:00:00"),  # unknown listing
        ],
    )
    got = {r["service_category"]: r for r in m.service_category_performance.collect()}
    assert set(got) == {"plumbing", "cleaning", None}
    assert got["plumbing"]["total_jobs"] == 1 and got["plumbing"]["total_listings"] == 1
    assert got["cleaning"]["total_jobs"] == 0 and got["cleaning"]["job_completion_rate_pct"] is None
    assert got[None]["total_jobs"] == 0 and got[None]["total_listings"] == 1
    assert got["plumbing"]["standard_listing_pct"] == 0.0
    assert got["plumbing"]["completed_jobs_per_active_contractor"] == 1.0


def test_round2_matches_binary_rounding(spark):
    from pyspark.sql import functions as F

    from bazaar.functions import round2

    df = spark.createDataFrame([(1.005,), (2.675,), (-0.004,), (617.285,), (-1.005,)], "x double")
    got = [r[0] for r in df.select(round2("x")).collect()]
    assert got[:2] == [1.0, 2.68]
    assert got[2] == 0.0 and str(got[2]) == "-0.0"
    assert got[3] == 617.29 and got[4] == -1.0
    assert df.select(round2(F.lit(None).cast("double"))).collect()[0][0] is None


def test_double_sum_is_exact(spark):
    import math

    from bazaar.functions import double_sum

    values = [0.1] * 10 + [1e8, -1e8, 0.3333333333333333, 1234.5678]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    assert df.agg(double_sum("x")).collect()[0][0] == math.fsum(values)
