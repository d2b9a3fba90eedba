"""Derive the six marketplace source tables from the TPC-H-style test tables.

The test data holds no marketplace tables, so users, contractor profiles,
services, jobs, adjustments and payouts are computed from ``customer``,
``supplier``, ``part`` and ``orders`` by deterministic integer rules
(FIXTURES.md section 2). All money is carried in integer cents and divided by a
double only at the end, so every engine produces the same doubles.

Everything here is a lazy DataFrame plan: one equi-join (orders to the
part-derived service keys) plus row-wise projections. The two table counts the
rules need are scalar subqueries, not cross joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the fixture mapping (must equal the oracle SQL) ---------
CONTRACTOR_KEY_OFFSET = 1_000_000_000
CITIES = ["NYC", " LA ", "Chicago", "Houston ", "Phoenix"]
CATEGORIES = ["Cleaning ", "plumbing", "ELECTRICAL", " landscaping"]
SIGNUP_EPOCH = "2023-01-01 00:00:00"
LISTING_EPOCH = "2024-01-01 00:00:00"
PREMIUM_TIER, STANDARD_TIER = " Premium", "standard"
PREMIUM_RATE, STANDARD_RATE = 0.15, 0.20
PREMIUM_KEEP_PCT, STANDARD_KEEP_PCT = 85, 80
STATUS_COMPLETED = "completed"
STATUS_BY_CUSTOMER = "canceled_by_customer"
STATUS_BY_CONTRACTOR = " Canceled_By_Contractor"
PAYOUT_PENDING, PAYOUT_COMPLETED = " Pending", "completed"
ADJ_FULL, ADJ_PARTIAL, ADJ_BONUS_FIRST, ADJ_BONUS_SECOND = (
    "Full_Refund",
    "partial_refund",
    "goodwill_bonus ",
    "goodwill_bonus",
)
# -----------------------------------------------------------------------------

TPCH_INPUTS = ("customer", "supplier", "part", "orders")


def _ntz(literal: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{literal}'")


def _pick(index: Column, values: list[str]) -> Column:
    """values[index] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _idiv(numerator: Column, divisor: int) -> Column:
    """Exact floor division of a non-negative bigint by a positive constant."""
    return ((numerator - numerator % divisor) / divisor).cast("long")


@dataclass(frozen=True)
class TpchInputs:
    customer: DataFrame
    supplier: DataFrame
    part: DataFrame
    orders: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, directory: str) -> "TpchInputs":
        frames = {name: spark.read.parquet(f"{directory}/{name}.parquet") for name in TPCH_INPUTS}
        return cls(**frames)


def users(src: TpchInputs) -> DataFrame:
    customers = src.customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nk")
    )
    suppliers = src.supplier.select(
        (F.col("s_suppkey") + CONTRACTOR_KEY_OFFSET).alias("user_id"),
        F.col("s_suppkey").alias("k"),
        F.col("s_nationkey").alias("nk"),
    )
    k = F.col("k")
    return customers.unionByName(suppliers).select(
        "user_id",
        F.timestamp_add("DAY", k % 730, _ntz(SIGNUP_EPOCH)).alias("signup_date"),
        ((k % 50 != 7) & (k % 20 != 3)).alias("is_active"),
        (k % 50 == 7).alias("is_suspended"),
        _pick(F.col("nk") % 5, CITIES).alias("city"),
    )


def contractor_profiles(src: TpchInputs) -> DataFrame:
    s = F.col("s_suppkey")
    premium = s % 10 == 0
    return src.supplier.select(
        (s + CONTRACTOR_KEY_OFFSET).alias("user_id"),
        F.when(premium, PREMIUM_TIER).otherwise(STANDARD_TIER).alias("contractor_tier"),
        F.when(premium, F.lit(PREMIUM_RATE)).otherwise(F.lit(STANDARD_RATE)).alias("commission_rate"),
        (s % 20 != 1).alias("onboarding_completed"),
        (s % 50 != 2).alias("background_check_passed"),
    )


def _service_keys(src: TpchInputs) -> DataFrame:
    """service_id -> owning contractor, premium flag and integer hourly rate."""
    n_suppliers = src.supplier.select(F.count(F.lit(1))).scalar()
    slot = F.col("p_partkey") % (n_suppliers - 2)  # the last two suppliers list nothing
    return src.part.select(
        F.col("p_partkey").alias("service_id"),
        (slot + CONTRACTOR_KEY_OFFSET).alias("contractor_id"),
        (slot % 10 == 0).alias("is_premium"),
        (25 + (F.col("p_partkey") * 37) % 136).alias("rate"),
    )


def services(src: TpchInputs) -> DataFrame:
    sid = F.col("service_id")
    return _service_keys(src).select(
        "service_id",
        "contractor_id",
        _pick(sid % 4, CATEGORIES).alias("service_category"),
        F.col("rate").cast("double").alias("hourly_rate"),
        F.timestamp_add("DAY", sid % 365, _ntz(LISTING_EPOCH)).alias("created_at"),
        (sid % 10 != 0).alias("is_available"),
    )


def _job_ledger(src: TpchInputs) -> DataFrame:
    """One row per order with every integer quantity the job-side tables need."""
    n_parts = src.part.select(F.count(F.lit(1))).scalar()
    key = F.col("o_orderkey")
    orders = src.orders.select(
        key.alias("job_id"),
        F.col("o_custkey").alias("customer_id"),
        F.timestamp_add("MINUTE", (key * 37) % 1440, F.col("o_orderdate")).alias("requested"),
        ((key * 7919 + F.col("o_custkey")) % n_parts).alias("service_id"),
    )
    j = orders.join(_service_keys(src), "service_id", "left")

    jid = F.col("job_id")
    est = 100 + jid % 701  # 1/100 h
    p = est * (70 + (jid * 13) % 61)
    act = p - p % 100  # 1/10000 h, whole 1/100 h
    g = _idiv(act, 100) * F.col("rate")  # cents
    j = j.select(
        "*",
        (jid % 20).alias("st"),
        est.alias("est_h"),
        act.alias("act_h"),
        g.alias("g"),
        F.timestamp_add("MINUTE", (jid * 53) % 4319 + 1, F.col("requested")).alias("completion"),
    )

    g = F.col("g")
    m100 = jid % 100
    first_signed = (
        F.when(m100.isin(15, 65), g)
        .when(m100 == 25, -F.least(500 + jid % 4501, g))
        .otherwise(_idiv(g, 4))
    )
    payout_days = 7 + jid % 8
    net = F.when((jid % 10 == 5) & ((jid * 11) % 30 <= payout_days), first_signed).otherwise(0) - F.when(
        (jid % 50 == 5) & ((jid * 17) % 30 <= payout_days), F.least(F.lit(500), g)
    ).otherwise(0)
    keep = F.when(F.col("is_premium"), PREMIUM_KEEP_PCT).otherwise(STANDARD_KEEP_PCT)
    return j.select(
        "*",
        (~F.col("st").isin(3, 7, 11)).alias("completed"),
        first_signed.alias("first_signed"),
        payout_days.alias("payout_days"),
        F.greatest(F.lit(0), _idiv(g * keep, 100) - net).alias("payout_cents"),
    )


def jobs(src: TpchInputs, ledger: DataFrame | None = None) -> DataFrame:
    ledger = ledger if ledger is not None else _job_ledger(src)
    done = F.col("completed")
    st = F.col("st")
    return ledger.select(
        "job_id",
        "service_id",
        "contractor_id",
        "customer_id",
        F.col("requested").alias("job_requested_at"),
        F.when(done, F.col("completion")).alias("job_completed_at"),
        F.when(st.isin(3, 11), STATUS_BY_CUSTOMER)
        .when(st == 7, STATUS_BY_CONTRACTOR)
        .otherwise(STATUS_COMPLETED)
        .alias("job_status"),
        (F.col("est_h") / 100.0).alias("estimated_hours"),
        F.when(done, F.col("act_h") / 10000.0).alias("actual_hours"),
        F.when(done, F.col("g") / 100.0).alias("gross_amount"),
    )


def adjustments(src: TpchInputs, ledger: DataFrame | None = None) -> DataFrame:
    ledger = ledger if ledger is not None else _job_ledger(src)
    jid = F.col("job_id")
    m100 = jid % 100
    first = ledger.where(F.col("completed") & (jid % 10 == 5)).select(
        (jid * 2).alias("adjustment_id"),
        "job_id",
        F.timestamp_add("DAY", (jid * 11) % 30, F.col("completion")).alias("adjustment_date"),
        F.when(m100.isin(15, 65), ADJ_FULL).when(m100 == 25, ADJ_BONUS_FIRST).otherwise(ADJ_PARTIAL).alias(
            "adjustment_type"
        ),
        (F.abs(F.col("first_signed")) / 100.0).alias("adjustment_amount"),
    )
    second = ledger.where(F.col("completed") & (jid % 50 == 5)).select(
        (jid * 2 + 1).alias("adjustment_id"),
        "job_id",
        F.timestamp_add("DAY", (jid * 17) % 30, F.col("completion")).alias("adjustment_date"),
        F.lit(ADJ_BONUS_SECOND).alias("adjustment_type"),
        (F.least(F.lit(500), F.col("g")) / 100.0).alias("adjustment_amount"),
    )
    return first.unionByName(second)


def payouts(src: TpchInputs, ledger: DataFrame | None = None) -> DataFrame:
    ledger = ledger if ledger is not None else _job_ledger(src)
    jid = F.col("job_id")
    return ledger.where(F.col("completed")).select(
        (jid + 1).alias("payout_id"),
        "contractor_id",
        "job_id",
        F.timestamp_add("DAY", F.col("payout_days"), F.col("completion")).alias("payout_date"),
        F.when(F.col("is_premium"), F.lit(PREMIUM_RATE)).otherwise(F.lit(STANDARD_RATE)).alias("commission_rate"),
        (F.col("payout_cents") / 100.0).alias("payout_amount"),
        F.when(jid % 20 == 1, PAYOUT_PENDING).otherwise(PAYOUT_COMPLETED).alias("payout_status"),
    )


def derive_sources(src: TpchInputs) -> dict[str, DataFrame]:
    """All six raw tables, sharing one job ledger plan."""
    ledger = _job_ledger(src)
    return {
        "users": users(src),
        "contractor_profiles": contractor_profiles(src),
        "services": services(src),
        "jobs": jobs(src, ledger),
        "adjustments": adjustments(src, ledger),
        "payouts": payouts(src, ledger),
    }


def spoiled(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables with a few rows that break the singular tests, by fixed rules.

    Jobs with job_id % 97 = 5 complete an hour before they are requested; adjustments
    with adjustment_id % 14 = 0 are negative.
    """
    hour_before = F.timestamp_add("HOUR", F.lit(-1), F.col("job_requested_at"))
    completed_at = F.when(F.col("job_id") % 97 == 5, hour_before).otherwise(F.col("job_completed_at"))
    amount = F.when(F.col("adjustment_id") % 14 == 0, -F.col("adjustment_amount")).otherwise(F.col("adjustment_amount"))
    return {
        **raw,
        "jobs": raw["jobs"].withColumn("job_completed_at", completed_at),
        "adjustments": raw["adjustments"].withColumn("adjustment_amount", amount),
    }
