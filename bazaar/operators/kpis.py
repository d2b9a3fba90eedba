"""Marketplace KPIs (I6-I10) over the job facts: one row, one global aggregate.

A global aggregate is a partial aggregate per task plus a single final merge
of one row per task, so it scales with the data without a key shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions import count_where, double_sum, money_sum, ratio_pct, round2


def marketplace_kpis(financials: DataFrame) -> DataFrame:
    all_jobs = F.count(F.lit(1))
    canceled = count_where(F.col("is_canceled"))
    return financials.agg(
        all_jobs.alias("total_jobs"),
        count_where(F.col("is_completed")).alias("completed_jobs"),
        canceled.alias("canceled_jobs"),
        money_sum("gross_amount_usd").alias("gross_booking_value_usd"),
        money_sum("net_revenue_usd").alias("net_booking_value_usd"),
        round2(double_sum("total_platform_fee_usd")).alias("platform_revenue_usd"),
        money_sum("total_payout_amount_usd").alias("contractor_earnings_usd"),
        ratio_pct(canceled, all_jobs).alias("cancellation_rate_pct"),
    )
