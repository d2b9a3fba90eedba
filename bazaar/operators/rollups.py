"""Roll-ups of the job fact at four grains in one pass, as states that can be merged.

``job_states`` reads the fact once and groups it by contractor, by customer, by service
category and as a whole (grouping sets with one map-side combine). A row holds counts,
exact sums and extremes: what the scorecards (D7-D9) and the KPIs (I6-I10) need of the
fact. States of disjoint parts of the fact add up (``merged``), so a part that changes
is replaced without reading the others; averages and rates are made from merged states
only. DOUBLE columns are summed as whole units and rests, so no total depends on the
order or the number of parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import count_where, money_sum, ratio_pct, round2
from bazaar.functions.numeric import MONEY_SUM_TYPE, decimal_mean, double_total, split_double

#: Grain -> its key in the fact; the whole fact has none.
GRAINS = {"contractor": "contractor_id", "customer": "customer_id", "category": "service_category"}
WHOLE = "all"

MONEY = {
    "gross": "gross_amount_usd",
    "net": "net_revenue_usd",
    "earned": "total_payout_amount_usd",
    "refunded": "total_refund_usd",
}


def _states() -> dict[str, Column]:
    completed = F.col("is_completed")
    counts = {
        "jobs": F.count(F.lit(1)),
        "completed": count_where(completed),
        "canceled": count_where(F.col("is_canceled")),
        "by_contractor": count_where(F.col("canceled_by") == "contractor"),
        "by_customer": count_where(F.col("canceled_by") == "customer"),
        "with_refund": count_where(F.col("total_refund_usd") > 0),
        "full_refund": count_where(F.col("has_full_refund")),
        "completed_priced": count_where(completed & F.col("gross_amount_usd").isNotNull()),
        "completed_timed": count_where(completed & F.col("hours_variance").isNotNull()),
    }
    sums = {name: money_sum(c) for name, c in MONEY.items()}
    sums["completed_gross"] = money_sum(F.when(completed, F.col("gross_amount_usd")))
    doubles = {"fee": F.col("total_platform_fee_usd"), "variance": F.when(completed, F.col("hours_variance"))}
    for name, c in doubles.items():
        units, rest = split_double(c)
        sums[f"{name}_units"] = F.sum(units).cast("decimal(38,0)")
        sums[f"{name}_rest"] = F.sum(rest)
    extremes = {
        "first_requested": F.min("requested_at"),
        "last_requested": F.max("requested_at"),
        "last_completed": F.max("completed_at"),
    }
    return counts | sums | extremes


def job_states(facts: DataFrame, *within: str) -> DataFrame:
    """(grain, the three keys, states) of the fact, one scan; ``within`` are columns to keep parts of it apart by.

    The key of a grain may be NULL (jobs without one); the keys of other grains are. Parts
    are not grouped by grouping sets but by rows exploded to their four grains, which stay where
    they are: a fact that is partitioned by ``within`` is grouped without a shuffle.
    """
    keys = list(GRAINS.values())
    if within:
        types = {k: facts.schema[k].dataType for k in keys}
        at = lambda own: [(F.col(k) if k == own else F.lit(None).cast(types[k])).alias(k) for k in keys]
        grains = [F.struct(F.lit(name).alias("grain"), *at(k)) for name, k in (GRAINS | {WHOLE: None}).items()]
        rest = [c for c in facts.columns if c not in keys]
        exploded = facts.select(*rest, F.explode(F.array(*grains)).alias("_at")).select(*rest, "_at.*")
        return exploded.groupBy(*within, "grain", *keys).agg(*[c.alias(name) for name, c in _states().items()])
    whole = 2 ** len(keys) - 1  # the grouping id: a bit for each key that is not grouped by
    grain = F.lit(WHOLE)
    for i, name in enumerate(GRAINS):
        grain = F.when(F.col("_set") == whole - 2 ** (len(keys) - 1 - i), name).otherwise(grain)
    grouped = facts.groupingSets([[k] for k in keys] + [[]], *keys).agg(
        F.grouping_id().alias("_set"), *[c.alias(name) for name, c in _states().items()]
    )
    return grouped.select(grain.alias("grain"), *keys, *_states())


def merged(states: DataFrame) -> DataFrame:
    """States of a whole from the states of its parts."""

    def merge(name: str) -> Column:
        if name.startswith("first_"):
            return F.min(name)
        if name in ("last_requested", "last_completed"):
            return F.max(name)
        return F.sum(name).cast(states.schema[name].dataType)

    return states.groupBy("grain", *GRAINS.values()).agg(*[merge(n).alias(n) for n in _states()])


def _mean_gross() -> Column:
    return round2(decimal_mean(F.col("completed_gross"), F.col("completed_priced")))


def _mean_variance() -> Column:
    total = double_total(F.col("variance_units"), F.col("variance_rest"))
    return round2(total / F.nullif(F.col("completed_timed"), F.lit(0)).cast("double"))


def _fees() -> Column:
    return round2(double_total(F.col("fee_units"), F.col("fee_rest")))


def _share(part: str, of: str) -> Column:
    return ratio_pct(F.col(part), F.col(of))


def contractor_job_stats(states: DataFrame) -> DataFrame:
    """E9 from merged states: the columns of ``scorecards.contractor_job_stats``."""
    return states.where(F.col("grain") == "contractor").select(
        "contractor_id",
        F.col("jobs").alias("total_jobs"),
        F.col("completed").alias("completed_jobs"),
        F.col("canceled").alias("canceled_jobs"),
        F.col("by_contractor").alias("contractor_cancellations"),
        F.col("by_customer").alias("customer_cancellations"),
        _share("completed", "jobs").alias("completion_rate_pct"),
        _share("by_contractor", "jobs").alias("contractor_cancel_rate_pct"),
        F.col("gross").alias("total_gross_usd"),
        F.col("net").alias("total_net_revenue_usd"),
        _mean_gross().alias("avg_job_gross_usd"),
        F.col("earned").alias("total_earned_usd"),
        F.col("with_refund").alias("jobs_with_refunds"),
        F.col("refunded").alias("total_refunded_usd"),
        _share("with_refund", "completed").alias("refund_rate_pct"),
        _mean_variance().alias("avg_hours_variance"),
        F.col("first_requested").alias("first_job_at"),
        F.col("last_completed").alias("last_completed_at"),
    )


def customer_job_stats(states: DataFrame) -> DataFrame:
    """E9 from merged states: the columns of ``scorecards.customer_job_stats``."""
    return states.where(F.col("grain") == "customer").select(
        "customer_id",
        F.col("jobs").alias("total_jobs"),
        F.col("completed").alias("completed_jobs"),
        F.col("canceled").alias("canceled_jobs"),
        F.col("by_customer").alias("customer_cancellations"),
        _share("completed", "jobs").alias("completion_rate_pct"),
        _share("by_customer", "jobs").alias("customer_cancel_rate_pct"),
        F.col("gross").alias("total_gross_spend_usd"),
        F.col("net").alias("total_net_spend_usd"),
        _mean_gross().alias("avg_job_gross_usd"),
        F.col("with_refund").alias("jobs_with_refunds"),
        F.col("refunded").alias("total_refunded_usd"),
        _share("with_refund", "completed").alias("refund_rate_pct"),
        F.col("full_refund").alias("full_refund_jobs"),
        F.col("first_requested").alias("first_job_at"),
        F.col("last_requested").alias("last_job_at"),
        F.col("last_completed").alias("last_completed_at"),
    )


def service_category_demand(states: DataFrame) -> DataFrame:
    """E3/E9 from merged states: the columns of ``scorecards.service_category_demand``."""
    return states.where((F.col("grain") == "category") & F.col("service_category").isNotNull()).select(
        "service_category",
        F.col("jobs").alias("total_jobs"),
        F.col("completed").alias("completed_jobs"),
        F.col("canceled").alias("canceled_jobs"),
        _share("completed", "jobs").alias("job_completion_rate_pct"),
        F.col("gross").alias("total_gross_revenue_usd"),
        F.col("net").alias("total_net_revenue_usd"),
        _mean_gross().alias("avg_job_gross_usd"),
        _fees().alias("total_platform_fee_usd"),
        F.col("with_refund").alias("jobs_with_refunds"),
        F.col("refunded").alias("total_refunded_usd"),
        _share("with_refund", "completed").alias("refund_rate_pct"),
        F.col("full_refund").alias("full_refund_jobs"),
        _mean_variance().alias("avg_hours_variance"),
        F.col("last_requested").alias("last_job_at"),
    )


def marketplace_kpis(states: DataFrame) -> DataFrame:
    """I6-I10 from merged states, one row (of zeros and NULLs for an empty fact)."""
    whole = states.where(F.col("grain") == WHOLE)
    names = ("jobs", "completed", "canceled", "gross", "net", "earned", "fee_units", "fee_rest")
    # at most one row: the aggregate makes one of none
    one = whole.agg(*[F.max(n).alias(n) for n in names])
    count = lambda name: F.coalesce(name, F.lit(0).cast("bigint"))
    return one.select(
        count("jobs").alias("total_jobs"),
        count("completed").alias("completed_jobs"),
        count("canceled").alias("canceled_jobs"),
        F.col("gross").alias("gross_booking_value_usd"),
        F.col("net").alias("net_booking_value_usd"),
        _fees().alias("platform_revenue_usd"),
        F.col("earned").alias("contractor_earnings_usd"),
        ratio_pct(count("canceled"), count("jobs")).alias("cancellation_rate_pct"),
    )


def last_request(states: DataFrame) -> DataFrame:
    """The dataset's reference date (E10) as the one column that ``scorecards.reference_date`` reads."""
    return states.where(F.col("grain") == WHOLE).select(F.col("last_requested").alias("requested_at"))


def job_rollups(states: DataFrame) -> DataFrame:
    """All four grains in one table, with totals, means and rates."""
    return states.select(
        "grain",
        *GRAINS.values(),
        F.col("jobs").alias("total_jobs"),
        F.col("completed").alias("completed_jobs"),
        F.col("canceled").alias("canceled_jobs"),
        F.col("by_contractor").alias("contractor_cancellations"),
        F.col("by_customer").alias("customer_cancellations"),
        F.col("with_refund").alias("jobs_with_refunds"),
        F.col("full_refund").alias("full_refund_jobs"),
        F.col("gross").alias("total_gross_usd"),
        F.col("net").alias("total_net_revenue_usd"),
        F.col("earned").cast(MONEY_SUM_TYPE).alias("total_earned_usd"),
        F.col("refunded").alias("total_refunded_usd"),
        _fees().alias("total_platform_fee_usd"),
        _mean_gross().alias("avg_job_gross_usd"),
        _mean_variance().alias("avg_hours_variance"),
        _share("completed", "jobs").alias("completion_rate_pct"),
        _share("canceled", "jobs").alias("cancellation_rate_pct"),
        _share("with_refund", "completed").alias("refund_rate_pct"),
        F.col("first_requested").alias("first_job_at"),
        F.col("last_requested").alias("last_job_at"),
        F.col("last_completed").alias("last_completed_at"),
    )
