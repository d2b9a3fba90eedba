"""Intermediate models: one typed, normalised, flagged row per raw row.

Each model is a single ``select`` so that derived columns read the *raw*
source column, not the cast alias of the same name (a cast-then-derive chain
of ``withColumn`` would read the rounded decimal). All are narrow
transformations: no shuffle, fully pipelined in one codegen stage, and
filters/projections above them reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions import hour_boundaries_between, normalized

# --- fixed values: domain labels of the models ------------------------------
ACCOUNT_SUSPENDED, ACCOUNT_ACTIVE, ACCOUNT_INACTIVE = "suspended", "active", "inactive"
JOB_COMPLETED = "completed"
JOB_CANCELED_BY_CUSTOMER = "canceled_by_customer"
JOB_CANCELED_BY_CONTRACTOR = "canceled_by_contractor"
RATE_BUDGET_BELOW, RATE_MID_BELOW = 75, 125
RATE_BUDGET, RATE_MID, RATE_PREMIUM = "budget", "mid_range", "premium"
ADJ_FULL_REFUND, ADJ_PARTIAL_REFUND, ADJ_GOODWILL_BONUS = "full_refund", "partial_refund", "goodwill_bonus"
DIRECTION_DEBIT, DIRECTION_CREDIT = "debit", "credit"
PAYOUT_PENDING = "pending"
TIER_PREMIUM = "premium"
# -----------------------------------------------------------------------------

MONEY = "decimal(10,2)"
RATE = "decimal(5,4)"
PCT = "decimal(5,2)"


def users_enriched(users: DataFrame) -> DataFrame:
    """user_id, signup_at, flags, account_status, trimmed city."""
    suspended, active = F.col("is_suspended"), F.col("is_active")
    return users.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("signup_date").cast("timestamp_ntz").alias("signup_at"),
        "is_active",
        "is_suspended",
        F.when(suspended, ACCOUNT_SUSPENDED)
        .when(active, ACCOUNT_ACTIVE)
        .otherwise(ACCOUNT_INACTIVE)
        .alias("account_status"),
        F.trim(F.col("city")).alias("city"),
    )


def contractor_profiles_enriched(profiles: DataFrame) -> DataFrame:
    """Tier normalised, commission as decimal rate and percent, eligibility."""
    tier = normalized("contractor_tier")
    raw_rate = F.col("commission_rate")
    return profiles.select(
        F.col("user_id").cast("bigint").alias("contractor_id"),
        tier.alias("contractor_tier"),
        (tier == TIER_PREMIUM).alias("is_premium_tier"),
        raw_rate.cast(RATE).alias("commission_rate"),
        (raw_rate * 100).cast(PCT).alias("commission_rate_pct"),
        "onboarding_completed",
        "background_check_passed",
        (F.col("onboarding_completed") & F.col("background_check_passed")).alias("is_eligible_to_work"),
    )


def services_enriched(services: DataFrame) -> DataFrame:
    """Category normalised, rate as decimal, rate tier from the raw double."""
    raw_rate = F.col("hourly_rate")
    return services.select(
        F.col("service_id").cast("bigint").alias("service_id"),
        F.col("contractor_id").cast("bigint").alias("contractor_id"),
        normalized("service_category").alias("service_category"),
        raw_rate.cast(MONEY).alias("hourly_rate_usd"),
        # NULL rate falls through to premium, as in a plain CASE
        F.when(raw_rate < RATE_BUDGET_BELOW, RATE_BUDGET)
        .when(raw_rate < RATE_MID_BELOW, RATE_MID)
        .otherwise(RATE_PREMIUM)
        .alias("rate_tier"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        "is_available",
    )


def jobs_enriched(jobs: DataFrame) -> DataFrame:
    """C4: status flags, decimal hours/money, raw-double variance, hour span."""
    status = normalized("job_status")
    is_completed = status == JOB_COMPLETED
    requested = F.col("job_requested_at").cast("timestamp_ntz")
    completed = F.col("job_completed_at").cast("timestamp_ntz")
    return jobs.select(
        F.col("job_id").cast("bigint").alias("job_id"),
        F.col("service_id").cast("bigint").alias("service_id"),
        F.col("contractor_id").cast("bigint").alias("contractor_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        requested.alias("requested_at"),
        completed.alias("completed_at"),
        status.alias("job_status"),
        is_completed.alias("is_completed"),
        status.isin(JOB_CANCELED_BY_CUSTOMER, JOB_CANCELED_BY_CONTRACTOR).alias("is_canceled"),
        F.when(status == JOB_CANCELED_BY_CUSTOMER, "customer")
        .when(status == JOB_CANCELED_BY_CONTRACTOR, "contractor")
        .alias("canceled_by"),
        F.col("estimated_hours").cast(MONEY).alias("estimated_hours"),
        F.col("actual_hours").cast(MONEY).alias("actual_hours"),
        F.when(is_completed, F.col("actual_hours") - F.col("estimated_hours")).alias("hours_variance"),
        F.col("gross_amount").cast(MONEY).alias("gross_amount_usd"),
        F.when(completed.isNotNull(), hour_boundaries_between(requested, completed)).alias("job_duration_hours"),
    )


def payouts_enriched(payouts: DataFrame) -> DataFrame:
    """Decimal rate/amount, implied gross and platform fee from raw doubles."""
    status = normalized("payout_status")
    raw_amount, raw_rate = F.col("payout_amount"), F.col("commission_rate")
    implied_gross = raw_amount / F.nullif(F.lit(1.0) - raw_rate, F.lit(0.0))
    return payouts.select(
        F.col("payout_id").cast("bigint").alias("payout_id"),
        F.col("contractor_id").cast("bigint").alias("contractor_id"),
        F.col("job_id").cast("bigint").alias("job_id"),
        F.col("payout_date").cast("timestamp_ntz").alias("paid_at"),
        raw_rate.cast(RATE).alias("commission_rate"),
        raw_amount.cast(MONEY).alias("payout_amount_usd"),
        implied_gross.alias("implied_gross_usd"),
        (implied_gross - raw_amount).alias("platform_fee_usd"),
        status.alias("payout_status"),
        (status == PAYOUT_PENDING).alias("is_pending"),
    )


def adjustments_enriched(adjustments: DataFrame) -> DataFrame:
    """Type normalised, cash-flow direction, type flags, decimal amount."""
    kind = normalized("adjustment_type")
    is_refund = kind.isin(ADJ_FULL_REFUND, ADJ_PARTIAL_REFUND)
    return adjustments.select(
        F.col("adjustment_id").cast("bigint").alias("adjustment_id"),
        F.col("job_id").cast("bigint").alias("job_id"),
        F.col("adjustment_date").cast("timestamp_ntz").alias("adjusted_at"),
        kind.alias("adjustment_type"),
        F.when(is_refund, DIRECTION_DEBIT).when(kind == ADJ_GOODWILL_BONUS, DIRECTION_CREDIT).alias(
            "adjustment_direction"
        ),
        (kind == ADJ_FULL_REFUND).alias("is_full_refund"),
        (kind == ADJ_PARTIAL_REFUND).alias("is_partial_refund"),
        (kind == ADJ_GOODWILL_BONUS).alias("is_goodwill_bonus"),
        is_refund.alias("is_refund"),
        F.col("adjustment_amount").cast(MONEY).alias("adjustment_amount_usd"),
    )
