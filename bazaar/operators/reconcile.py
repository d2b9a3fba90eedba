"""Payout reconciliation (I4) and adjustments after payout.

Rule: a payout equals gross - gross * commission - refunds + bonuses, counting
only the job's adjustments dated on or before the payout date, floored at 0
and rounded to the cent. Adjustments dated later leave the payout unchanged.

The "dated on or before" sums come from ``asof.totals_at`` (running sums
per day, second and microsecond), not from joining every adjustment to every
payout of its job, so a job with millions of adjustments and payouts neither
emits pairs nor lands in one task. Only payouts of jobs that have an adjustment
enter it; the others take zeros. Money is exact decimal arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions.numeric import MONEY_SUM_TYPE
from bazaar.operators.asof import totals_at, with_totals
from bazaar.operators.marts import signed_amount

# --- fixed values -------------------------------------------------------------
RECONCILE_TOLERANCE_USD = 0.01  # payouts are floored to the cent, the rule rounds
# -----------------------------------------------------------------------------


def reconcile_payouts(payouts: DataFrame, jobs: DataFrame, adjustments: DataFrame) -> DataFrame:
    """I4: one row per payout with the expected amount and the difference."""
    events = adjustments.select(
        "job_id",
        "adjusted_at",
        F.when(F.col("is_refund"), F.col("adjustment_amount_usd")).cast(MONEY_SUM_TYPE).alias("refunds"),
        F.when(F.col("is_goodwill_bonus"), F.col("adjustment_amount_usd")).cast(MONEY_SUM_TYPE).alias("bonuses"),
        F.lit(1).cast("bigint").alias("n_adjustments"),
    )
    # only payouts of adjusted jobs are asked for: key and time, without what else a payout has
    adjusted = adjustments.select("job_id").distinct()
    asked = payouts.select("job_id", "paid_at").join(adjusted, "job_id", "left_semi")
    values = ["refunds", "bonuses", "n_adjustments"]
    totals = totals_at(asked, events, key="job_id", probe_time="paid_at", event_time="adjusted_at", values=values)
    probes = payouts.join(jobs.select("job_id", "gross_amount_usd"), "job_id", "left").select(
        "payout_id", "job_id", "contractor_id", "paid_at", "commission_rate", "payout_amount_usd", "gross_amount_usd"
    )
    summed = with_totals(probes, totals, "job_id", "paid_at", values)
    gross, rate = F.col("gross_amount_usd"), F.col("commission_rate")
    refunds = F.col("refunds").cast(MONEY_SUM_TYPE)
    bonuses = F.col("bonuses").cast(MONEY_SUM_TYPE)
    expected = F.greatest(F.lit(0), F.round(gross - gross * rate - refunds + bonuses, 2)).cast(MONEY_SUM_TYPE)
    difference = (F.col("payout_amount_usd") - expected).cast(MONEY_SUM_TYPE)
    return summed.select(
        "payout_id",
        "job_id",
        "contractor_id",
        "paid_at",
        "commission_rate",
        "gross_amount_usd",
        "payout_amount_usd",
        refunds.alias("refunds_before_payout_usd"),
        bonuses.alias("bonuses_before_payout_usd"),
        F.col("n_adjustments").alias("adjustments_before_payout"),
        expected.alias("expected_payout_usd"),
        difference.alias("difference_usd"),
        (F.abs(difference) <= F.lit(RECONCILE_TOLERANCE_USD)).alias("is_reconciled"),
    )


def reconciliation_summary(reconciled: DataFrame) -> DataFrame:
    """One row: how many payouts reconcile, and the total absolute difference."""
    return reconciled.agg(
        F.count(F.lit(1)).alias("payouts"),
        F.count_if(F.col("is_reconciled")).alias("reconciled"),
        F.count_if(~F.col("is_reconciled")).alias("unreconciled"),
        F.count_if(F.col("is_reconciled").isNull()).alias("unknown"),
        F.sum(F.abs(F.col("difference_usd"))).cast(MONEY_SUM_TYPE).alias("total_abs_difference_usd"),
    )


def adjustments_after_payout(adjustments: DataFrame, payouts: DataFrame) -> DataFrame:
    """Adjustments dated after the job's last payout (not reflected in any payout).

    Payouts are reduced to one row per job first (map-side combined), so the
    join has a unique right side and AQE can split a hot job on the left.
    """
    last_paid = payouts.groupBy("job_id").agg(F.max("paid_at").alias("last_paid_at"))
    return (
        adjustments.join(last_paid, "job_id", "inner")
        .where(F.col("adjusted_at") > F.col("last_paid_at"))
        .select(
            "adjustment_id",
            "job_id",
            "adjusted_at",
            "adjustment_type",
            "adjustment_amount_usd",
            signed_amount().alias("signed_amount_usd"),
            "last_paid_at",
        )
    )
