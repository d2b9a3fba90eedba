"""Distribution rules of the data specification: shares, ranges and seasons.

A share is tested by goodness of fit. For one category with expected share p of n rows the
statistic is (observed - n p)^2 / (n p (1 - p)); for a whole distribution it is Pearson's sum
over its categories. Both are held against the 99.9 % point of chi-square with one, or one
less than the categories, degrees of freedom. A rule that gives a range is tested against
the end that is nearer, and fits inside it. Season rules are odds ratios (see ``seasons``).

Each raw table is read once and becomes one row of counts, combined map-side; the rules are
computed from those. Rows without a value, and tables without rows, count nowhere: a
rule over no rows has no share, no statistic and passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: what the specification states ------------------------------
#: (rule, category, least share, greatest share)
SHARES = (
    ("users_active", "active", 0.95, 0.95),
    ("service_category", "cleaning", 0.35, 0.35),
    ("service_category", "plumbing", 0.25, 0.25),
    ("service_category", "electrical", 0.20, 0.20),
    ("service_category", "landscaping", 0.20, 0.20),
    ("jobs_canceled", "canceled", 0.12, 0.18),
    ("jobs_adjusted", "adjusted", 0.08, 0.12),
    ("adjustment_type", "partial_refund", 0.70, 0.70),
    ("adjustment_type", "full_refund", 0.20, 0.20),
    ("adjustment_type", "goodwill_bonus", 0.10, 0.10),
    ("payouts_completed", "completed", 0.95, 0.95),
)
#: (category, least hourly rate, greatest hourly rate)
RATES = (("cleaning", 25.0, 60.0), ("plumbing", 60.0, 150.0), ("electrical", 70.0, 160.0), ("landscaping", 40.0, 120.0))
#: (category, months, how much higher than at other times)
SEASONS = (("landscaping", (6, 7, 8), 1.4), ("cleaning", (12,), 1.3))
#: 99.9 % points of chi-square by degrees of freedom.
CRITICAL = {1: 10.828, 2: 13.816, 3: 16.266}
# -------------------------------------------------------------------------------

DECIMALS = 6


def _value(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def _counts(df: DataFrame, rule: str, total: Column, observed: dict[str, Column]) -> DataFrame:
    """(rule, category, observed, total) from one row of counts."""
    listed = [F.struct(F.lit(c).alias("category"), F.count_if(o).alias("observed"), F.count_if(total).alias("total")) for c, o in observed.items()]
    return df.agg(F.array(*listed).alias("x")).select(F.lit(rule).alias("rule"), F.inline("x"))


def share_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows of every category of the share rules, and rows that the rule is about."""
    given = lambda name: _value(name).isNotNull()
    categories = [c for r, c, _, _ in SHARES if r == "service_category"]
    types = [c for r, c, _, _ in SHARES if r == "adjustment_type"]
    status = _value("job_status")
    jobs = sources["jobs"].agg(F.count_if(status.startswith("canceled")).alias("canceled"), F.count_if(status == "completed").alias("completed"), F.count("job_status").alias("n"))
    adjusted = sources["adjustments"].agg(F.count("job_id").alias("observed")).select("observed", (jobs.select("completed").scalar()).alias("total"))
    parts = (
        _counts(sources["users"], "users_active", F.col("is_active").isNotNull(), {"active": F.col("is_active")}),
        _counts(sources["services"], "service_category", given("service_category"), {c: _value("service_category") == c for c in categories}),
        jobs.select(F.lit("jobs_canceled").alias("rule"), F.lit("canceled").alias("category"), F.col("canceled").alias("observed"), F.col("n").alias("total")),
        adjusted.select(F.lit("jobs_adjusted").alias("rule"), F.lit("adjusted").alias("category"), "observed", "total"),
        _counts(sources["adjustments"], "adjustment_type", given("adjustment_type"), {c: _value("adjustment_type") == c for c in types}),
        _counts(sources["payouts"], "payouts_completed", given("payout_status"), {"completed": _value("payout_status") == "completed"}),
    )
    return reduce(DataFrame.unionByName, parts)


def specification_shares(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per category, and one (category ``all``) per distribution: share, bounds, statistic and verdict."""
    expected = F.create_map(*[x for r, c, lo, hi in SHARES for x in (F.lit(f"{r}|{c}"), F.array(F.lit(lo), F.lit(hi)))])
    bounds = expected[F.concat_ws("|", "rule", "category")]
    n, found = F.col("total").cast("double"), F.col("observed").cast("double")
    share = F.try_divide(found, n)
    p = F.greatest(F.col("expected_low"), F.least(F.col("share"), F.col("expected_high")))
    rows = (
        share_counts(sources)
        .select("rule", "category", "observed", "total", bounds[0].alias("expected_low"), bounds[1].alias("expected_high"))
        .withColumn("share", share)
        .withColumn("p", p)
        .withColumn("off", found - n * F.col("p"))
        .withColumn("statistic", F.try_divide(F.col("off") * F.col("off"), n * F.col("p") * (1 - F.col("p"))))
        .withColumn("pearson", F.try_divide(F.col("off") * F.col("off"), n * F.col("p")))
    )
    several = {r: sum(x == r for x, _, _, _ in SHARES) for r, _, _, _ in SHARES}
    limit = F.create_map(*[x for r, k in several.items() if k > 1 for x in (F.lit(r), F.lit(CRITICAL[k - 1]))])
    whole = (
        rows.where(F.col("rule").isin([r for r, k in several.items() if k > 1]))
        .groupBy("rule")
        .agg(F.sum("observed").alias("observed"), F.max("total").alias("total"), F.sum("pearson").alias("statistic"))
        .select("rule", F.lit("all").alias("category"), "observed", "total", F.lit(1.0).alias("expected_low"), F.lit(1.0).alias("expected_high"),
                F.try_divide(F.col("observed").cast("double"), F.col("total").cast("double")).alias("share"), "statistic", limit[F.col("rule")].alias("critical"))
    )
    kept = ("rule", "category", "observed", "total", "expected_low", "expected_high", "share", "statistic")
    both = rows.select(*kept, F.lit(CRITICAL[1]).alias("critical")).unionByName(whole)
    return both.select(
        *kept[:6], F.round("share", DECIMALS).alias("share"), F.round("statistic", DECIMALS).alias("statistic"), "critical",
        F.coalesce(F.round("statistic", DECIMALS) <= F.col("critical"), F.lit(True)).alias("passed"),
    )


def rate_ranges(services: DataFrame) -> DataFrame:
    """Per category of the specification: services, least and greatest rate, and rates outside its range."""
    listed = []
    for c, low, high in RATES:
        mine = (_value("service_category") == c) & F.col("hourly_rate").isNotNull()
        rate = F.when(mine, F.col("hourly_rate"))
        outside = mine & ((F.col("hourly_rate") < low) | (F.col("hourly_rate") > high))
        listed.append(
            F.struct(
                F.lit(c).alias("service_category"), F.lit(low).alias("lowest_allowed"), F.lit(high).alias("highest_allowed"),
                F.count_if(mine).alias("services"), F.min(rate).alias("lowest_rate"), F.max(rate).alias("highest_rate"),
                F.count_if(outside).alias("violations"),
            )
        )
    return services.agg(F.array(*listed).alias("x")).select(F.inline("x"))


def monthly_demand(jobs: DataFrame, services: DataFrame) -> DataFrame:
    """(service_category, month, jobs) of all jobs with a service and a time. Jobs are counted by service before they are joined."""
    by_service = (
        jobs.where("service_id IS NOT NULL AND job_requested_at IS NOT NULL")
        .groupBy("service_id", F.month("job_requested_at").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # a service id held by several rows is one service, with its least category
    kinds = services.groupBy("service_id").agg(F.min(_value("service_category")).alias("service_category"))
    joined = by_service.join(kinds.where("service_category IS NOT NULL"), "service_id")
    return joined.groupBy("service_category", "month").agg(F.sum("n").alias("jobs"))


def seasonal_index(jobs: DataFrame, services: DataFrame) -> DataFrame:
    """Jobs by category and month against what the month's trend and the category's size give: 1 is no season."""
    demand = monthly_demand(jobs, services)
    # the margins of the table: one more grouping of at most 12 rows a category
    by_month = demand.groupBy("month").agg(F.sum("jobs").alias("in_month"))
    by_kind = demand.groupBy("service_category").agg(F.sum("jobs").alias("in_category"))
    total = demand.agg(F.sum("jobs").alias("n")).scalar().cast("double")
    expected = F.col("in_month").cast("double") * F.col("in_category").cast("double") / total
    return demand.join(by_month, "month").join(by_kind, "service_category").select(
        "service_category", "month", "jobs", F.round(expected, DECIMALS).alias("expected_jobs"),
        F.round(F.col("jobs").cast("double") / expected, DECIMALS).alias("seasonal_index"),
    )


def specification_seasons(jobs: DataFrame, services: DataFrame) -> DataFrame:
    """One row per season rule: the odds ratio of the category in its months, which the trend of all jobs leaves alone.

    The statistic is the squared distance of its logarithm from the stated one over
    its variance, 1/a + 1/b + 1/c + 1/d for the four counts.
    """
    demand = monthly_demand(jobs, services)
    listed = []
    for kind, months, lift in SEASONS:
        mine, season = F.col("service_category") == kind, F.col("month").isin(list(months))
        cells = {"in_season": mine & season, "others_in_season": ~mine & season, "off_season": mine & ~season, "others_off_season": ~mine & ~season}
        sums = [F.coalesce(F.sum(F.when(w, F.col("jobs"))), F.lit(0).cast("long")).alias(c) for c, w in cells.items()]
        listed.append(F.struct(F.lit(kind).alias("service_category"), F.lit(lift).alias("expected_lift"), *sums))
    rows = demand.agg(F.array(*listed).alias("x")).select(F.inline("x"))
    a, b, c, d = (F.col(x).cast("double") for x in ("in_season", "others_in_season", "off_season", "others_off_season"))
    whole = (a > 0) & (b > 0) & (c > 0) & (d > 0)
    lift = F.when(whole, F.try_divide(a * d, b * c))
    off = F.log("lift_") - F.log("expected_lift")
    one = F.lit(1.0)
    spread = F.try_divide(one, a) + F.try_divide(one, b) + F.try_divide(one, c) + F.try_divide(one, d)
    statistic = F.try_divide(off * off, spread)
    return rows.withColumn("lift_", lift).select(
        "service_category", "in_season", "others_in_season", "off_season", "others_off_season", "expected_lift",
        F.round("lift_", DECIMALS).alias("lift"), F.round(statistic, DECIMALS).alias("statistic"),
        F.coalesce(F.round(statistic, DECIMALS) <= CRITICAL[1], F.lit(True)).alias("passed"),
    )
