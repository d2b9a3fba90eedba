"""Scorecards: contractor performance, customer health, service-category supply/demand.

Every scorecard is "aggregate the job facts to the entity, then left-join the
entity list". The aggregates are hash aggregations with partial (map-side)
combining, so a contractor or customer holding a third of all jobs costs one
pre-aggregated row per map task, not a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import count_where, decimal_avg, double_avg, double_sum, minus_days, money_sum, ratio_pct, round2
from bazaar.functions.numeric import MONEY_SUM_TYPE

# --- fixed values: segmentation rules of the customer scorecard -------------
AT_RISK_AFTER_DAYS = 90
LOW_ENGAGEMENT_REFUND_PCT = 30
LOW_ENGAGEMENT_CANCEL_PCT = 40
HIGH_VALUE_MIN_SPEND = 1000
HIGH_VALUE_MIN_COMPLETION_PCT = 70
# -----------------------------------------------------------------------------



def _all() -> Column:
    return F.count(F.lit(1))


def _completed() -> Column:
    return count_where(F.col("is_completed"))


def _with_refund() -> Column:
    return count_where(F.col("total_refund_usd") > 0)


def _when_completed(c: str) -> Column:
    return F.when(F.col("is_completed"), F.col(c))


def _zero(c: str, cast: str | None = None) -> Column:
    out = F.coalesce(F.col(c), F.lit(0))
    return (out.cast(cast) if cast else out).alias(c)


def contractor_job_stats(facts: DataFrame) -> DataFrame:
    """Job facts per contractor (volume, revenue, earnings, refunds, recency)."""
    by_contractor = count_where(F.col("canceled_by") == "contractor")
    return facts.groupBy("contractor_id").agg(
        _all().alias("total_jobs"),
        _completed().alias("completed_jobs"),
        count_where(F.col("is_canceled")).alias("canceled_jobs"),
        by_contractor.alias("contractor_cancellations"),
        count_where(F.col("canceled_by") == "customer").alias("customer_cancellations"),
        ratio_pct(_completed(), _all()).alias("completion_rate_pct"),
        ratio_pct(by_contractor, _all()).alias("contractor_cancel_rate_pct"),
        money_sum("gross_amount_usd").alias("total_gross_usd"),
        money_sum("net_revenue_usd").alias("total_net_revenue_usd"),
        round2(decimal_avg(_when_completed("gross_amount_usd"))).alias("avg_job_gross_usd"),
        money_sum("total_payout_amount_usd").alias("total_earned_usd"),
        _with_refund().alias("jobs_with_refunds"),
        money_sum("total_refund_usd").alias("total_refunded_usd"),
        ratio_pct(_with_refund(), _completed()).alias("refund_rate_pct"),
        round2(double_avg(_when_completed("hours_variance"))).alias("avg_hours_variance"),
        F.min("requested_at").alias("first_job_at"),
        F.max("completed_at").alias("last_completed_at"),
    )


def contractor_service_stats(services: DataFrame) -> DataFrame:
    """Listings per contractor and the number of distinct categories."""
    return services.groupBy("contractor_id").agg(
        F.count(F.lit(1)).alias("total_services"),
        count_where(F.col("is_available")).alias("available_services"),
        F.count_distinct("service_category").alias("service_category_count"),
    )


def contractor_performance_summary(
    contractors: DataFrame, job_stats: DataFrame, service_stats: DataFrame
) -> DataFrame:
    """One row per contractor; zero-filled counts, NULL rates without jobs."""
    return (
        contractors.join(job_stats, "contractor_id", "left")
        .join(service_stats, "contractor_id", "left")
        .select(
            "contractor_id",
            "contractor_tier",
            "is_premium_tier",
            "commission_rate",
            "is_eligible_to_work",
            "city",
            "signup_at",
            _zero("total_jobs"),
            _zero("completed_jobs"),
            _zero("canceled_jobs"),
            _zero("contractor_cancellations"),
            _zero("customer_cancellations"),
            "completion_rate_pct",
            "contractor_cancel_rate_pct",
            _zero("total_gross_usd", MONEY_SUM_TYPE),
            _zero("total_net_revenue_usd", MONEY_SUM_TYPE),
            "avg_job_gross_usd",
            _zero("total_earned_usd", MONEY_SUM_TYPE),
            _zero("jobs_with_refunds"),
            _zero("total_refunded_usd", MONEY_SUM_TYPE),
            "refund_rate_pct",
            "avg_hours_variance",
            "first_job_at",
            "last_completed_at",
            _zero("total_services"),
            _zero("available_services"),
            _zero("service_category_count"),
        )
    )


def customer_job_stats(facts: DataFrame) -> DataFrame:
    """Job facts per customer (frequency, monetary, refunds, recency)."""
    by_customer = count_where(F.col("canceled_by") == "customer")
    return facts.groupBy("customer_id").agg(
        _all().alias("total_jobs"),
        _completed().alias("completed_jobs"),
        count_where(F.col("is_canceled")).alias("canceled_jobs"),
        by_customer.alias("customer_cancellations"),
        ratio_pct(_completed(), _all()).alias("completion_rate_pct"),
        ratio_pct(by_customer, _all()).alias("customer_cancel_rate_pct"),
        money_sum("gross_amount_usd").alias("total_gross_spend_usd"),
        money_sum("net_revenue_usd").alias("total_net_spend_usd"),
        round2(decimal_avg(_when_completed("gross_amount_usd"))).alias("avg_job_gross_usd"),
        _with_refund().alias("jobs_with_refunds"),
        money_sum("total_refund_usd").alias("total_refunded_usd"),
        ratio_pct(_with_refund(), _completed()).alias("refund_rate_pct"),
        count_where(F.col("has_full_refund")).alias("full_refund_jobs"),
        F.min("requested_at").alias("first_job_at"),
        F.max("requested_at").alias("last_job_at"),
        F.max("completed_at").alias("last_completed_at"),
    )


def reference_date(jobs: DataFrame) -> DataFrame:
    """The dataset's reference date, max(requested_at), one row."""
    return jobs.agg(F.max("requested_at").alias("ref_date"))


def health_segment(ref_date: Column) -> Column:
    """Priority rule: suspended, never ordered, at risk, low engagement, high value, healthy.

    Thresholds read the rounded 2-dp rates; NULL rates (no completed job)
    never trigger a rule on their own.
    """
    return (
        F.when(F.col("is_suspended"), "suspended")
        .when(F.col("customer_id").isNull(), "never_ordered")
        .when(F.col("last_job_at") < minus_days(ref_date, AT_RISK_AFTER_DAYS), "at_risk")
        .when(
            (F.col("refund_rate_pct") > LOW_ENGAGEMENT_REFUND_PCT)
            | (F.col("customer_cancel_rate_pct") > LOW_ENGAGEMENT_CANCEL_PCT),
            "low_engagement",
        )
        .when(
            (F.col("total_gross_spend_usd") >= HIGH_VALUE_MIN_SPEND)
            & (F.col("completion_rate_pct") >= HIGH_VALUE_MIN_COMPLETION_PCT),
            "high_value",
        )
        .otherwise("healthy")
    )


def customer_health_summary(users: DataFrame, job_stats: DataFrame, jobs: DataFrame) -> DataFrame:
    """One row per user (contractors included) with an RFM-style segment.

    The reference date is a scalar subquery over one pruned column, so no
    cross join and nothing passes through the driver.
    """
    ref_date = reference_date(jobs).scalar()
    joined = users.join(job_stats, F.col("user_id") == F.col("customer_id"), "left")
    return joined.select(
        F.col("user_id").alias("customer_id"),
        "city",
        "account_status",
        "is_active",
        "is_suspended",
        "signup_at",
        _zero("total_jobs"),
        _zero("completed_jobs"),
        _zero("canceled_jobs"),
        _zero("customer_cancellations"),
        "completion_rate_pct",
        "customer_cancel_rate_pct",
        _zero("total_gross_spend_usd", MONEY_SUM_TYPE),
        _zero("total_net_spend_usd", MONEY_SUM_TYPE),
        "avg_job_gross_usd",
        _zero("jobs_with_refunds"),
        _zero("total_refunded_usd", MONEY_SUM_TYPE),
        "refund_rate_pct",
        _zero("full_refund_jobs"),
        "first_job_at",
        "last_job_at",
        "last_completed_at",
        health_segment(ref_date).alias("health_segment"),
    )


def customers_never_ordered(users: DataFrame, jobs: DataFrame) -> DataFrame:
    """Users without any job as customer.

    Customers are made distinct first, combined map-side, so a customer with a third
    of all jobs is one row per task on the side that cannot be split.
    """
    customers = jobs.select(F.col("customer_id").alias("user_id")).distinct()
    return users.join(customers, "user_id", "left_anti").select("user_id", "signup_at", "account_status", "city")


def service_category_demand(facts_with_category: DataFrame) -> DataFrame:
    """Demand side per category; jobs without a category are dropped."""
    return (
        facts_with_category.where(F.col("service_category").isNotNull())
        .groupBy("service_category")
        .agg(
            _all().alias("total_jobs"),
            _completed().alias("completed_jobs"),
            count_where(F.col("is_canceled")).alias("canceled_jobs"),
            ratio_pct(_completed(), _all()).alias("job_completion_rate_pct"),
            money_sum("gross_amount_usd").alias("total_gross_revenue_usd"),
            money_sum("net_revenue_usd").alias("total_net_revenue_usd"),
            round2(decimal_avg(_when_completed("gross_amount_usd"))).alias("avg_job_gross_usd"),
            round2(double_sum("total_platform_fee_usd")).alias("total_platform_fee_usd"),
            _with_refund().alias("jobs_with_refunds"),
            money_sum("total_refund_usd").alias("total_refunded_usd"),
            ratio_pct(_with_refund(), _completed()).alias("refund_rate_pct"),
            count_where(F.col("has_full_refund")).alias("full_refund_jobs"),
            round2(double_avg(_when_completed("hours_variance"))).alias("avg_hours_variance"),
            F.max("requested_at").alias("last_job_at"),
        )
    )


def service_category_supply(services: DataFrame) -> DataFrame:
    """Supply side per category: listings, distinct contractors, rate mix.

    ``standard_listing_pct`` counts rate_tier = 'standard', a tier the rate
    bucketing never produces, so it is always 0; kept as specified.
    """
    available = F.col("is_available")
    tier = F.col("rate_tier")
    return services.groupBy("service_category").agg(
        _all().alias("total_listings"),
        count_where(available).alias("available_listings"),
        F.count_distinct("contractor_id").alias("contractor_count"),
        F.count_distinct(F.when(available, F.col("contractor_id"))).alias("active_contractor_count"),
        F.min("hourly_rate_usd").alias("min_hourly_rate_usd"),
        round2(decimal_avg("hourly_rate_usd")).alias("avg_hourly_rate_usd"),
        F.max("hourly_rate_usd").alias("max_hourly_rate_usd"),
        ratio_pct(count_where(tier == "budget"), _all()).alias("budget_listing_pct"),
        ratio_pct(count_where(tier == "standard"), _all()).alias("standard_listing_pct"),
        ratio_pct(count_where(tier == "premium"), _all()).alias("premium_listing_pct"),
    )


def listing_tier_mix(services: DataFrame) -> DataFrame:
    """Share of every rate tier that the bucketing produces, per category.

    The supply side keeps ``standard_listing_pct`` as specified, which is always 0;
    the shares here add up to 100.
    """
    tier = F.col("rate_tier")
    return services.groupBy("service_category").agg(
        *[ratio_pct(count_where(tier == t), _all()).alias(f"{t}_listing_pct") for t in ("budget", "mid_range", "premium")]
    )


def service_category_performance(demand: DataFrame, supply: DataFrame) -> DataFrame:
    """Demand FULL OUTER supply on category (both sides a few rows)."""
    completed = F.coalesce(F.col("completed_jobs"), F.lit(0))
    return demand.join(supply, "service_category", "full").select(
        "service_category",
        _zero("total_jobs"),
        _zero("completed_jobs"),
        _zero("canceled_jobs"),
        "job_completion_rate_pct",
        _zero("total_gross_revenue_usd", MONEY_SUM_TYPE),
        _zero("total_net_revenue_usd", MONEY_SUM_TYPE),
        "avg_job_gross_usd",
        _zero("total_platform_fee_usd", "double"),
        _zero("jobs_with_refunds"),
        _zero("total_refunded_usd", MONEY_SUM_TYPE),
        "refund_rate_pct",
        _zero("full_refund_jobs"),
        "avg_hours_variance",
        "last_job_at",
        _zero("total_listings"),
        _zero("available_listings"),
        _zero("contractor_count"),
        _zero("active_contractor_count"),
        "min_hourly_rate_usd",
        "avg_hourly_rate_usd",
        "max_hourly_rate_usd",
        "budget_listing_pct",
        "standard_listing_pct",
        "premium_listing_pct",
        round2(completed.cast("double") / F.nullif(F.col("active_contractor_count"), F.lit(0))).alias(
            "completed_jobs_per_active_contractor"
        ),
    )
