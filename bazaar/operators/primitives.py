"""Isolated exercises of the aggregate (F1-F10) and scalar (G1-G12) functions.

``agg_functions`` runs every aggregate shape the models use, per service
category; ``scalar_functions`` runs every scalar shape, per job. Both go
through the same helpers as the models, so they pin the shared semantics in
one place each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions import (
    count_where,
    decimal_avg,
    double_sum,
    hour_boundaries_between,
    minus_days,
    money_sum,
    normalized,
    ratio_pct,
    round2,
)
from bazaar.functions.numeric import MONEY_SUM_TYPE


def agg_functions(facts_with_category: DataFrame) -> DataFrame:
    """F1-F10 per service category (NULL category forms its own group)."""
    completed = F.col("is_completed")
    gross = F.col("gross_amount_usd")
    return facts_with_category.groupBy("service_category").agg(
        F.count(F.lit(1)).alias("f1_jobs"),
        count_where(completed).alias("f2_completed_jobs"),
        F.count_distinct("customer_id").alias("f3_distinct_customers"),
        F.count_distinct(F.when(completed, F.col("contractor_id"))).alias("f4_distinct_completing_contractors"),
        money_sum(gross).alias("f5_gross_sum_usd"),
        round2(double_sum("total_platform_fee_usd")).alias("f5_platform_fee_sum_usd"),
        money_sum(F.when(F.col("has_full_refund"), gross).otherwise(F.lit(0))).alias("f6_fully_refunded_gross_usd"),
        round2(decimal_avg(gross)).alias("f7_avg_gross_usd"),
        round2(decimal_avg(F.when(F.col("total_refund_usd") > 0, gross))).alias("f7_avg_refunded_job_gross_usd"),
        F.min(gross).alias("f8_min_gross_usd"),
        F.max(gross).alias("f8_max_gross_usd"),
        F.min("requested_at").alias("f8_first_requested_at"),
        F.max("completed_at").alias("f8_last_completed_at"),
        F.bool_or("has_pending_payout").alias("f9_any_pending_payout"),
        F.bool_or("has_full_refund").alias("f9_any_full_refund"),
        ratio_pct(count_where(F.col("is_canceled")), F.count(F.lit(1))).alias("f10_cancel_rate_pct"),
    )


def scalar_functions(jobs: DataFrame, services: DataFrame) -> DataFrame:
    """G1-G12 per raw job, with the raw listing joined for the rate."""
    svc = services.select(
        F.col("service_id").alias("svc_id"),
        F.col("hourly_rate").alias("svc_rate"),
        F.col("service_category").alias("svc_category"),
    )
    j = jobs.join(svc, F.col("service_id") == F.col("svc_id"), "left")
    status = normalized("job_status")
    est, act, rate = F.col("estimated_hours"), F.col("actual_hours"), F.col("svc_rate")
    requested = F.col("job_requested_at").cast("timestamp_ntz")
    completed = F.col("job_completed_at").cast("timestamp_ntz")
    gross = F.col("gross_amount").cast("decimal(10,2)")
    return j.select(
        F.col("job_id").cast("bigint").alias("job_id"),
        status.alias("g1_status"),
        normalized("svc_category").alias("g1_category"),
        gross.alias("g2_gross_usd"),
        round2(est * rate / 3).alias("g3_estimate_third_usd"),
        F.coalesce(act, est).alias("g4_hours"),
        (F.col("gross_amount") / F.nullif(act, F.lit(0.0))).alias("g5_effective_rate"),
        F.when(status == "canceled_by_customer", "customer")
        .when(status == "canceled_by_contractor", "contractor")
        .alias("g6_canceled_by"),
        F.when(rate < 75, "budget").when(rate < 125, "mid_range").otherwise("premium").alias("g7_rate_tier"),
        status.isin("canceled_by_customer", "canceled_by_contractor").alias("g8_is_canceled"),
        ((est >= 2) & (est <= 6) | act.isNull()).alias("g8_mid_estimate_or_open"),
        ((status == "completed") & (gross > 100)).alias("g9_completed_over_100"),
        F.when(completed.isNotNull(), hour_boundaries_between(requested, completed)).alias("g10_duration_hours"),
        minus_days(requested, 90).alias("g11_requested_minus_90d"),
        (-(gross - F.col("estimated_hours").cast("decimal(10,2)") * rate.cast("decimal(10,2)"))).cast(
            MONEY_SUM_TYPE
        ).alias("g12_estimate_gap_usd"),
    )
