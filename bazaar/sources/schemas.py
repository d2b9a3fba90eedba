"""Declared schemas of the six raw marketplace tables.

Raw types follow the data specification: integer keys, zone-less timestamps,
float money/hours/rates, booleans and free-form strings that the intermediate
layer normalises. Declaring them lets readers skip inference and fail early
on a missing column.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, D, B, S, TS = T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


USERS = _struct(
    ("user_id", L),
    ("signup_date", TS),
    ("is_active", B),
    ("is_suspended", B),
    ("city", S),
)

CONTRACTOR_PROFILES = _struct(
    ("user_id", L),
    ("contractor_tier", S),
    ("commission_rate", D),
    ("onboarding_completed", B),
    ("background_check_passed", B),
)

SERVICES = _struct(
    ("service_id", L),
    ("contractor_id", L),
    ("service_category", S),
    ("hourly_rate", D),
    ("created_at", TS),
    ("is_available", B),
)

JOBS = _struct(
    ("job_id", L),
    ("service_id", L),
    ("contractor_id", L),
    ("customer_id", L),
    ("job_requested_at", TS),
    ("job_completed_at", TS),
    ("job_status", S),
    ("estimated_hours", D),
    ("actual_hours", D),
    ("gross_amount", D),
)

ADJUSTMENTS = _struct(
    ("adjustment_id", L),
    ("job_id", L),
    ("adjustment_date", TS),
    ("adjustment_type", S),
    ("adjustment_amount", D),
)

PAYOUTS = _struct(
    ("payout_id", L),
    ("contractor_id", L),
    ("job_id", L),
    ("payout_date", TS),
    ("commission_rate", D),
    ("payout_amount", D),
    ("payout_status", S),
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "users": USERS,
    "contractor_profiles": CONTRACTOR_PROFILES,
    "services": SERVICES,
    "jobs": JOBS,
    "adjustments": ADJUSTMENTS,
    "payouts": PAYOUTS,
}

TABLE_NAMES = tuple(RAW_SCHEMAS)
