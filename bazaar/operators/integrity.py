"""Source integrity (I1), specification rules (I2) and table profiles.

All three read the raw tables and report counts, one row per check; they never
pull rows to the driver. Containment checks count declarations and uses of each key
in one aggregate (a NULL key counts as an orphan); one-to-one rules pre-aggregate
the many side before the join, so no check emits pairs of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import normalized
from bazaar.operators.frames import union_all

# --- fixed values: rule parameters from the data specification ---------------
MAX_SERVICES_PER_CONTRACTOR = 5
STANDARD_COMMISSION, PREMIUM_COMMISSION = 0.20, 0.15
HOURS_VARIATION = 0.30
HOURS_TOLERANCE = 0.01  # fixture hours are floored to 1/100 h
MONEY_TOLERANCE = 0.01
ADJUSTMENT_WINDOW_DAYS = 30
PAYOUT_DELAY_MIN_DAYS, PAYOUT_DELAY_MAX_DAYS = 7, 14
# -----------------------------------------------------------------------------


def _violations(name: str, holds: Column) -> Column:
    """Rows where the rule does not hold; an unknown (NULL) outcome is a violation."""
    return F.count_if(~F.coalesce(holds, F.lit(False))).alias(name)


def _counted(row: DataFrame, names: list[str]) -> DataFrame:
    return row.unpivot([], names, "check_name", "violations")


def _non_negative(amount: str) -> Column:
    """Known, a number and not below zero; NaN sorts above every number, so it needs its own test."""
    return (F.col(amount) >= 0) & ~F.isnan(amount)


# Which table declares the keys of a domain, and which columns must be among them.
KEY_DOMAINS = {"users": "user_id", "contractor_profiles": "user_id", "services": "service_id", "jobs": "job_id"}
CONTAINMENTS = (
    ("contractor_profiles", "user_id", "users"),
    ("services", "contractor_id", "contractor_profiles"),
    ("jobs", "service_id", "services"),
    ("jobs", "contractor_id", "contractor_profiles"),
    ("jobs", "customer_id", "users"),
    ("adjustments", "job_id", "jobs"),
    ("payouts", "job_id", "jobs"),
)
AMOUNTS = (("adjustments", "adjustment_amount"), ("payouts", "payout_amount"))


def source_integrity(raw: dict[str, DataFrame]) -> DataFrame:
    """The generator's assertions: unique users, seven containments, amounts >= 0.

    Each table is scanned once. A row gives (domain, key, check) for the key it
    declares and for every key it refers to; one aggregate on (domain, key), combined
    map-side, then shows for each key whether it is declared and how many rows of each
    check refer to it. A key of any frequency is one row per task, duplicate
    declarations count once, and a NULL key is declared by nothing.
    """
    frames, orphan_checks = [], []
    for table, df in raw.items():
        uses = [(d, k, "declared") for d, k in KEY_DOMAINS.items() if d == table]
        for child, column, domain in CONTAINMENTS:
            if child == table:
                name = f"{child}_{column}_in_{domain}"
                orphan_checks.append(name)
                uses.append((domain, column, name))
        pairs = [
            F.struct(F.lit(d).alias("domain"), F.col(k).alias("key"), F.lit(name).alias("check")) for d, k, name in uses
        ]
        for owner, amount in AMOUNTS:
            if owner == table:
                fails = ~F.coalesce(_non_negative(amount), F.lit(False))
                bad = F.struct(
                    F.lit("amounts").alias("domain"),
                    F.lit(None).cast("long").alias("key"),
                    F.lit(f"{amount}_non_negative").alias("check"),
                )
                pairs.append(F.when(fails, bad))
        frames.append(df.select(F.inline(F.filter(F.array(*pairs), lambda p: p.isNotNull()))))
    amount_checks = [f"{amount}_non_negative" for _, amount in AMOUNTS]
    keys = union_all(frames).groupBy("domain", "key").agg(
        F.count_if(F.col("check") == "declared").alias("declared"),
        *[F.count_if(F.col("check") == c).alias(c) for c in orphan_checks + amount_checks],
    )
    loose = (F.col("declared") == 0) | F.col("key").isNull()
    row = keys.agg(
        F.count_if((F.col("domain") == "users") & (F.col("declared") > 1)).alias("users_user_id_unique"),
        *[F.coalesce(F.sum(F.when(loose, F.col(c))), F.lit(0)).alias(c) for c in orphan_checks],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in amount_checks],
    )
    return _counted(row, ["users_user_id_unique", *orphan_checks, *amount_checks])


def specification_rules(raw: dict[str, DataFrame]) -> DataFrame:
    """Rules of the data specification that the generator does not assert.

    Known generator gaps (more than five listings per contractor in the test
    fixtures, no seasonality) legitimately show up as violations.
    """
    users, profiles, services = raw["users"], raw["contractor_profiles"], raw["services"]
    jobs, adjustments, payouts = raw["jobs"], raw["adjustments"], raw["payouts"]

    status = normalized("job_status")
    jobs_n = jobs.select(
        "job_id",
        "service_id",
        "contractor_id",
        "customer_id",
        "job_completed_at",
        "estimated_hours",
        "actual_hours",
        "gross_amount",
        (status == "completed").alias("is_completed"),
    )
    completed_at = F.col("job_completed_at")

    tier = normalized("contractor_tier")
    expected_rate = F.when(tier == "premium", F.lit(PREMIUM_COMMISSION)).when(
        tier == "standard", F.lit(STANDARD_COMMISSION)
    )
    est, act = F.col("estimated_hours"), F.col("actual_hours")
    done = F.col("is_completed")
    not_completed = ~F.coalesce(done, F.lit(False))  # rules that apply to completed jobs only
    nulls = [completed_at.isNull(), act.isNull(), F.col("gross_amount").isNull()]

    # one pass over jobs: payouts counted per job, listings and contractors grouped by key,
    # with how often a key is declared, so that the row count does not change
    payouts_per_job = payouts.groupBy(F.col("job_id").alias("p_job_id")).agg(F.count(F.lit(1)).alias("n_payouts"))
    listed = services.select(
        F.col("service_id").alias("s_service_id"),
        F.col("contractor_id").alias("s_contractor_id"),
        F.col("hourly_rate").alias("s_hourly_rate"),
    )
    contractor_keys = profiles.select(F.col("user_id").alias("c_user_id")).distinct()
    n_payouts = F.coalesce(F.col("n_payouts"), F.lit(0))
    job_pass = (
        jobs_n.join(payouts_per_job, F.col("job_id") == F.col("p_job_id"), "left")
        .join(contractor_keys, F.col("customer_id") == F.col("c_user_id"), "left")
        .agg(
            F.count_if(F.col("c_user_id").isNotNull()).alias("customer_is_not_a_contractor"),
            _violations(
                "completion_fields_only_when_completed",
                F.when(done, ~(nulls[0] | nulls[1] | nulls[2])).otherwise(nulls[0] & nulls[1] & nulls[2]),
            ),
            _violations(
                "actual_hours_within_30_pct",
                not_completed
                | (
                    (act >= est * (1 - HOURS_VARIATION) - HOURS_TOLERANCE)
                    & (act <= est * (1 + HOURS_VARIATION) + HOURS_TOLERANCE)
                ),
            ),
            _violations("one_payout_per_completed_job", F.when(done, n_payouts == 1).otherwise(n_payouts == 0)),
        )
    )
    listing_pass = jobs_n.join(listed, F.col("service_id") == F.col("s_service_id"), "inner").agg(
        _violations("job_contractor_matches_service", F.col("contractor_id") == F.col("s_contractor_id")),
        # only completed jobs are held to the rate rule
        _violations(
            "gross_is_actual_hours_times_rate",
            not_completed | (F.abs(F.col("gross_amount") - act * F.col("s_hourly_rate")) <= MONEY_TOLERANCE),
        ),
    )

    # one pass over what refers to jobs: adjustments and payouts share the join on job_id
    none = lambda kind: F.lit(None).cast(kind)
    referring = adjustments.select(
        "job_id",
        F.lit(True).alias("is_adjustment"),
        F.col("adjustment_date").alias("at"),
        F.col("adjustment_amount").alias("amount"),
        none("long").alias("to_contractor"),
        none("double").alias("rate"),
    ).unionByName(
        payouts.select(
            "job_id",
            F.lit(False).alias("is_adjustment"),
            F.col("payout_date").alias("at"),
            none("double").alias("amount"),
            F.col("contractor_id").alias("to_contractor"),
            F.col("commission_rate").alias("rate"),
        )
    )
    job_side = jobs_n.select(
        F.col("job_id").alias("j_job_id"),
        F.col("contractor_id").alias("j_contractor_id"),
        F.col("job_completed_at").alias("j_done"),
        F.col("gross_amount").alias("j_gross"),
        F.col("is_completed").alias("j_is_completed"),
    )
    after = lambda days: F.timestamp_add("DAY", F.lit(days), F.col("j_done"))
    at, adjusts, pays = F.col("at"), F.col("is_adjustment"), ~F.col("is_adjustment")
    referring_pass = referring.join(job_side, F.col("job_id") == F.col("j_job_id"), "inner").agg(
        _violations("adjustments_only_on_completed_jobs", pays | F.col("j_is_completed")),
        _violations("adjustment_within_gross", pays | (F.col("amount") <= F.col("j_gross"))),
        _violations(
            "adjustment_within_30_days_of_completion",
            pays | ((at >= F.col("j_done")) & (at <= after(ADJUSTMENT_WINDOW_DAYS))),
        ),
        _violations(
            "payout_7_to_14_days_after_completion",
            adjusts | ((at >= after(PAYOUT_DELAY_MIN_DAYS)) & (at <= after(PAYOUT_DELAY_MAX_DAYS))),
        ),
        _violations("payout_contractor_matches_job", adjusts | (F.col("to_contractor") == F.col("j_contractor_id"))),
    )
    prof = profiles.select(F.col("user_id").alias("c_user_id"), F.col("commission_rate").alias("c_rate"))
    listings = services.groupBy("contractor_id").agg(F.count(F.lit(1)).alias("n"))
    passes = [
        users.agg(_violations("suspended_users_are_inactive", ~(F.col("is_suspended") & F.col("is_active")))),
        profiles.agg(_violations("commission_matches_tier", F.col("commission_rate") == expected_rate)),
        listings.agg(F.count_if(F.col("n") > MAX_SERVICES_PER_CONTRACTOR).alias("contractor_has_at_most_5_services")),
        job_pass,
        listing_pass,
        referring_pass,
        payouts.join(prof, F.col("contractor_id") == F.col("c_user_id"), "inner").agg(
            _violations("payout_commission_matches_profile", F.col("commission_rate") == F.col("c_rate"))
        ),
    ]
    return union_all([_counted(p, p.columns) for p in passes])


def sql_type_name(dtype: T.DataType) -> str:
    """Engine-neutral SQL name of a column type."""
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    names = {
        T.LongType: "BIGINT",
        T.IntegerType: "INTEGER",
        T.ShortType: "SMALLINT",
        T.ByteType: "TINYINT",
        T.DoubleType: "DOUBLE",
        T.FloatType: "FLOAT",
        T.BooleanType: "BOOLEAN",
        T.StringType: "VARCHAR",
        T.TimestampNTZType: "TIMESTAMP",
        T.TimestampType: "TIMESTAMP WITH TIME ZONE",
        T.DateType: "DATE",
        T.BinaryType: "BLOB",
    }
    return names.get(type(dtype), dtype.simpleString().upper())


def _missing(df: DataFrame, column: str) -> Column:
    """NULL, or not a number in a floating column."""
    c = F.col(column)
    floating = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


def profile_table(df: DataFrame, table_name: str) -> DataFrame:
    """Per column: type and missing values (NULL or NaN); per table: rows, columns, duplicate rows.

    One scan: a row becomes a 128-bit hash and a bitmap of its missing values, which are
    counted map-side, so some 24 bytes for each different row are shuffled instead of the
    row. Duplicate rows (copies of an earlier row) are rows minus different hashes; at
    10^13 rows two different rows share a hash with a chance below 10^-12. Missing values
    are the bits times the rows that have them.
    """
    cols = df.columns
    # a NULL must not hash like the absence of the column before it
    marks = [F.col(c).isNull() for c in cols]
    words = [cols[i : i + 63] for i in range(0, len(cols), 63)]
    bit = lambda c, i: F.when(_missing(df, c), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    bitmaps = [
        reduce(lambda x, y: x.bitwiseOR(y), [bit(c, i) for i, c in enumerate(word)]).alias(f"missing{w}")
        for w, word in enumerate(words)
    ]
    hashed = df.select(
        F.xxhash64(*cols, *marks).alias("h1"), F.xxhash64(F.lit("second"), *reversed(cols), *marks).alias("h2"), *bitmaps
    )
    rows = hashed.groupBy("h1", "h2", *[f"missing{w}" for w in range(len(words))]).agg(F.count(F.lit(1)).alias("n"))
    is_missing = lambda w, i: F.getbit(F.col(f"missing{w}"), F.lit(i)) == 1
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    stats = rows.agg(
        count("n").alias("row_count"),
        count(F.col("n") - 1).alias("duplicate_rows"),
        *[
            count(F.when(is_missing(w, i), F.col("n"))).alias(c)
            for w, word in enumerate(words)
            for i, c in enumerate(word)
        ],
    )
    types = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(sql_type_name(df.schema[c].dataType)))])
    return stats.unpivot(["row_count", "duplicate_rows"], cols, "column_name", "null_count").select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        F.element_at(types, F.col("column_name")).alias("data_type"),
        F.col("null_count").cast("bigint").alias("null_count"),
        F.col("row_count").cast("bigint").alias("row_count"),
        F.lit(len(cols)).cast("bigint").alias("column_count"),
        F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
    )


def profile_tables(raw: dict[str, DataFrame]) -> DataFrame:
    return union_all([profile_table(df, name) for name, df in raw.items()])
