"""Dimensions, job-grain pre-aggregates and the three fact tables.

Plan shape (see ``fct_jobs``): payouts and adjustments are aggregated to job
grain *before* they meet jobs, so no job row fans out. The three job_id-keyed
inputs are joined first; the two aggregates come out of their shuffle already
hash-partitioned on job_id, so jobs is the only side that moves for these two
joins. Dimension lookups come afterwards and are planned by size: broadcast
when a dimension is under the broadcast threshold (checked by Spark from the
plan's statistics), sort-merge otherwise, with AQE splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions import double_sum, money_sum
from bazaar.functions.numeric import MONEY_SUM_TYPE


def dim_users(users: DataFrame) -> DataFrame:
    """One row per user."""
    return users.select("user_id", "signup_at", "is_active", "is_suspended", "account_status", "city")


def dim_services(services: DataFrame) -> DataFrame:
    """One row per service listing."""
    return services.select(
        "service_id",
        "contractor_id",
        "service_category",
        "hourly_rate_usd",
        "rate_tier",
        "created_at",
        "is_available",
    )


def dim_contractors(contractors: DataFrame, users: DataFrame) -> DataFrame:
    """D3: contractor attributes plus the user attributes of the same person."""
    user_side = users.select(
        F.col("user_id").alias("contractor_id"),
        "signup_at",
        "is_active",
        "is_suspended",
        "account_status",
        "city",
    )
    return contractors.join(user_side, "contractor_id", "left").select(
        "contractor_id",
        "contractor_tier",
        "is_premium_tier",
        "commission_rate",
        "commission_rate_pct",
        "onboarding_completed",
        "background_check_passed",
        "is_eligible_to_work",
        "signup_at",
        "is_active",
        "is_suspended",
        "account_status",
        "city",
    )


def payouts_by_job(payouts: DataFrame) -> DataFrame:
    """Payouts rolled up to job grain (partial aggregation map-side)."""
    return payouts.groupBy("job_id").agg(
        money_sum("payout_amount_usd").alias("total_payout_amount_usd"),
        double_sum("platform_fee_usd").alias("total_platform_fee_usd"),
        F.count(F.lit(1)).alias("payout_count"),
        F.bool_or("is_pending").alias("has_pending_payout"),
    )


def adjustments_by_job(adjustments: DataFrame) -> DataFrame:
    """Refunds, bonuses and counts rolled up to job grain."""
    amount = F.col("adjustment_amount_usd")
    return adjustments.groupBy("job_id").agg(
        money_sum(F.when(F.col("is_refund"), amount).otherwise(F.lit(0))).alias("total_refund_usd"),
        money_sum(F.when(F.col("is_goodwill_bonus"), amount).otherwise(F.lit(0))).alias("total_bonus_usd"),
        F.count(F.lit(1)).alias("adjustment_count"),
        F.bool_or("is_full_refund").alias("has_full_refund"),
    )


JOB_COLUMNS = [
    "job_id",
    "service_id",
    "contractor_id",
    "customer_id",
    "requested_at",
    "completed_at",
    "job_status",
    "is_completed",
    "is_canceled",
    "canceled_by",
    "estimated_hours",
    "actual_hours",
    "hours_variance",
    "job_duration_hours",
    "gross_amount_usd",
]
PAYOUT_AGG_COLUMNS = ["total_payout_amount_usd", "total_platform_fee_usd", "payout_count", "has_pending_payout"]
ADJUSTMENT_AGG_COLUMNS = ["total_refund_usd", "total_bonus_usd", "adjustment_count", "has_full_refund"]
CONTEXT_COLUMNS = [
    "service_category",
    "hourly_rate_usd",
    "rate_tier",
    "contractor_tier",
    "is_premium_tier",
    "contractor_commission_rate",
    "customer_city",
    "customer_account_status",
]


def job_financials(jobs: DataFrame, payouts_agg: DataFrame, adjustments_agg: DataFrame) -> DataFrame:
    """Job grain with payout and adjustment roll-ups and net revenue.

    This is ``fct_jobs`` without the descriptive dimension columns.
    Payout columns stay NULL without a payout; adjustment columns default to
    0 / false; net revenue stays NULL when gross is NULL.
    """
    return with_financials(jobs.join(payouts_agg, "job_id", "left").join(adjustments_agg, "job_id", "left"))


def with_financials(joined: DataFrame, *others: str) -> DataFrame:
    """The columns of ``job_financials`` (and ``others``) of jobs that have their two roll-ups beside them."""
    refund = F.coalesce(F.col("total_refund_usd"), F.lit(0)).cast(MONEY_SUM_TYPE)
    return joined.select(
        *JOB_COLUMNS,
        *PAYOUT_AGG_COLUMNS,
        refund.alias("total_refund_usd"),
        F.coalesce(F.col("total_bonus_usd"), F.lit(0)).cast(MONEY_SUM_TYPE).alias("total_bonus_usd"),
        F.coalesce(F.col("adjustment_count"), F.lit(0)).cast("bigint").alias("adjustment_count"),
        F.coalesce(F.col("has_full_refund"), F.lit(False)).alias("has_full_refund"),
        (F.col("gross_amount_usd") - refund).cast(MONEY_SUM_TYPE).alias("net_revenue_usd"),
        *others,
    )


def fct_jobs(financials: DataFrame, services: DataFrame, contractors: DataFrame, users: DataFrame) -> DataFrame:
    """One row per job with payouts, adjustments, net revenue and context."""
    return with_context(financials, services, contractors, users).select(
        *JOB_COLUMNS, *PAYOUT_AGG_COLUMNS, *ADJUSTMENT_AGG_COLUMNS, "net_revenue_usd", *CONTEXT_COLUMNS
    )


def with_context(jobs: DataFrame, services: DataFrame, contractors: DataFrame, users: DataFrame) -> DataFrame:
    """Job-grain rows with the descriptive columns of their service, contractor and customer."""
    svc = services.select("service_id", "service_category", "hourly_rate_usd", "rate_tier")
    con = contractors.select(
        "contractor_id",
        "contractor_tier",
        "is_premium_tier",
        F.col("commission_rate").alias("contractor_commission_rate"),
    )
    cus = users.select(
        F.col("user_id").alias("customer_id"),
        F.col("city").alias("customer_city"),
        F.col("account_status").alias("customer_account_status"),
    )
    return (
        jobs.join(svc, "service_id", "left").join(con, "contractor_id", "left").join(cus, "customer_id", "left")
    )


def fct_payouts(payouts: DataFrame, jobs: DataFrame, contractors: DataFrame) -> DataFrame:
    """One row per payout with job and contractor context."""
    job_side = jobs.select(
        "job_id",
        "service_id",
        "customer_id",
        F.col("requested_at").alias("job_requested_at"),
        F.col("gross_amount_usd").alias("job_gross_amount_usd"),
    )
    con = contractors.select("contractor_id", "contractor_tier", "is_premium_tier")
    return (
        payouts.join(job_side, "job_id", "left")
        .join(con, "contractor_id", "left")
        .select(
            "payout_id",
            "contractor_id",
            "job_id",
            "paid_at",
            "commission_rate",
            "payout_amount_usd",
            "implied_gross_usd",
            "platform_fee_usd",
            "payout_status",
            "is_pending",
            "service_id",
            "customer_id",
            "job_requested_at",
            "job_gross_amount_usd",
            "contractor_tier",
            "is_premium_tier",
        )
    )


def signed_amount(direction: str = "adjustment_direction", amount: str = "adjustment_amount_usd"):
    """Debits negative, credits positive, unknown direction NULL."""
    d, a = F.col(direction), F.col(amount)
    return F.when(d == "debit", -a).when(d == "credit", a)


def fct_adjustments(
    adjustments: DataFrame, jobs: DataFrame, services: DataFrame, contractors: DataFrame
) -> DataFrame:
    """One row per adjustment with signed amount and job/service/contractor context."""
    job_side = jobs.select(
        "job_id",
        "service_id",
        "contractor_id",
        "customer_id",
        F.col("gross_amount_usd").alias("job_gross_amount_usd"),
        F.col("requested_at").alias("job_requested_at"),
        F.col("completed_at").alias("job_completed_at"),
    )
    svc = services.select("service_id", "service_category")
    con = contractors.select("contractor_id", "contractor_tier")
    return (
        adjustments.join(job_side, "job_id", "left")
        .join(svc, "service_id", "left")
        .join(con, "contractor_id", "left")
        .select(
            "adjustment_id",
            "job_id",
            "adjusted_at",
            "adjustment_type",
            "adjustment_direction",
            "is_refund",
            "is_full_refund",
            "is_partial_refund",
            "is_goodwill_bonus",
            "adjustment_amount_usd",
            signed_amount().alias("signed_amount_usd"),
            "service_id",
            "contractor_id",
            "customer_id",
            "job_gross_amount_usd",
            "job_requested_at",
            "job_completed_at",
            "service_category",
            "contractor_tier",
        )
    )
