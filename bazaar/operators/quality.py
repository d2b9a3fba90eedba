"""Data-quality checks (H1-H8): declared column tests and four singular tests.

A check reports *failing rows* the way a test query counts them:

* unique           - distinct non-NULL values that occur more than once
* not_null         - rows where the column is NULL
* accepted_values  - distinct non-NULL values outside the accepted list
* relationships    - child rows whose non-NULL key has no parent row

Plan shape: one pass over each model gives a test number and a 128-bit hash for each
key of a unique test and, otherwise, only what fails (a clean row makes nothing else); one
exchange, combined map-side, counts these 20 bytes for all models. Hashes found more than
once are looked at again by their values, in a second pass over the models that have any,
so equal hashes of different values are told apart. A relationship joins the declared
parent's distinct keys in the first pass. Models that several tests or scorecards read
are written once per run before they are tested, so none is computed twice. The
descriptors below are rendered into Spark SQL over one temporary view per model.

``observed_counts`` states the same tests as metrics of a DataFrame that is being written
(``Marketplace.build``), and ``declared_test_rows`` gives the failing rows of one test.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.session import RunFolder

# --- fixed values: the declared tests of every model -------------------------
JOB_STATUSES = ("completed", "canceled_by_customer", "canceled_by_contractor")
ADJUSTMENT_TYPES = ("full_refund", "partial_refund", "goodwill_bonus")
DIRECTIONS = ("debit", "credit")
PAYOUT_STATUSES = ("completed", "pending")
TIERS = ("standard", "premium")
CATEGORIES = ("cleaning", "plumbing", "landscaping", "electrical")
RATE_TIERS = ("budget", "mid_range", "premium")
ACCOUNT_STATUSES = ("active", "inactive", "suspended")
CANCELED_BY = ("customer", "contractor")
HEALTH_SEGMENTS = ("high_value", "healthy", "low_engagement", "at_risk", "never_ordered", "suspended")


@dataclass(frozen=True)
class ModelTests:
    model: str
    layer: str
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    relationships: tuple[tuple[str, str, str], ...] = field(default=())  # (column, parent model, parent column)


DECLARED_TESTS: tuple[ModelTests, ...] = (
    ModelTests(
        "stg_jobs",
        "staging",
        ("job_id",),
        ("job_id", "service_id", "contractor_id", "customer_id", "job_requested_at", "job_status", "estimated_hours"),
    ),
    ModelTests(
        "stg_adjustments",
        "staging",
        ("adjustment_id",),
        ("adjustment_id", "job_id", "adjustment_date", "adjustment_type", "adjustment_amount"),
    ),
    ModelTests(
        "stg_payouts",
        "staging",
        ("payout_id",),
        ("payout_id", "contractor_id", "job_id", "payout_date", "commission_rate", "payout_amount", "payout_status"),
    ),
    ModelTests(
        "stg_contractor_profiles",
        "staging",
        ("user_id",),
        ("user_id", "contractor_tier", "commission_rate", "onboarding_completed", "background_check_passed"),
    ),
    ModelTests(
        "stg_services",
        "staging",
        ("service_id",),
        ("service_id", "contractor_id", "service_category", "hourly_rate", "created_at", "is_available"),
    ),
    ModelTests(
        "stg_users",
        "staging",
        ("user_id",),
        ("user_id", "signup_date", "is_active", "is_suspended", "city"),
    ),
    ModelTests(
        "int_jobs_enriched",
        "intermediate",
        ("job_id",),
        (
            "job_id",
            "service_id",
            "contractor_id",
            "customer_id",
            "requested_at",
            "job_status",
            "is_completed",
            "is_canceled",
            "estimated_hours",
        ),
        (("job_status", JOB_STATUSES),),
    ),
    ModelTests(
        "int_adjustments_enriched",
        "intermediate",
        ("adjustment_id",),
        (
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
        ),
        (("adjustment_type", ADJUSTMENT_TYPES), ("adjustment_direction", DIRECTIONS)),
    ),
    ModelTests(
        "int_payouts_enriched",
        "intermediate",
        ("payout_id",),
        (
            "payout_id",
            "contractor_id",
            "job_id",
            "paid_at",
            "commission_rate",
            "payout_amount_usd",
            "payout_status",
            "is_pending",
        ),
        (("payout_status", PAYOUT_STATUSES),),
    ),
    ModelTests(
        "int_contractor_profiles_enriched",
        "intermediate",
        ("contractor_id",),
        (
            "contractor_id",
            "contractor_tier",
            "is_premium_tier",
            "commission_rate",
            "commission_rate_pct",
            "onboarding_completed",
            "background_check_passed",
            "is_eligible_to_work",
        ),
        (("contractor_tier", TIERS),),
    ),
    ModelTests(
        "int_services_enriched",
        "intermediate",
        ("service_id",),
        (
            "service_id",
            "contractor_id",
            "service_category",
            "hourly_rate_usd",
            "rate_tier",
            "created_at",
            "is_available",
        ),
        (("service_category", CATEGORIES), ("rate_tier", RATE_TIERS)),
    ),
    ModelTests(
        "int_users_enriched",
        "intermediate",
        ("user_id",),
        ("user_id", "signup_at", "is_active", "is_suspended", "account_status", "city"),
        (("account_status", ACCOUNT_STATUSES),),
    ),
    ModelTests(
        "fct_jobs",
        "marts",
        ("job_id",),
        (
            "job_id",
            "service_id",
            "contractor_id",
            "customer_id",
            "requested_at",
            "job_status",
            "is_completed",
            "is_canceled",
            "estimated_hours",
            "total_refund_usd",
            "total_bonus_usd",
            "adjustment_count",
            "has_full_refund",
            "service_category",
            "rate_tier",
            "hourly_rate_usd",
            "contractor_tier",
            "is_premium_tier",
            "contractor_commission_rate",
            "customer_city",
            "customer_account_status",
        ),
        (
            ("job_status", JOB_STATUSES),
            ("canceled_by", CANCELED_BY),
            ("rate_tier", RATE_TIERS),
            ("contractor_tier", TIERS),
            ("customer_account_status", ACCOUNT_STATUSES),
        ),
        (
            ("service_id", "dim_services", "service_id"),
            ("contractor_id", "dim_contractors", "contractor_id"),
            ("customer_id", "dim_users", "user_id"),
        ),
    ),
    ModelTests(
        "dim_contractors",
        "marts",
        ("contractor_id",),
        (
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
        ),
        (("contractor_tier", TIERS), ("account_status", ACCOUNT_STATUSES)),
    ),
    ModelTests(
        "dim_services",
        "marts",
        ("service_id",),
        (
            "service_id",
            "contractor_id",
            "service_category",
            "hourly_rate_usd",
            "rate_tier",
            "created_at",
            "is_available",
        ),
        (("service_category", CATEGORIES), ("rate_tier", RATE_TIERS)),
        (("contractor_id", "dim_contractors", "contractor_id"),),
    ),
    ModelTests(
        "dim_users",
        "marts",
        ("user_id",),
        ("user_id", "signup_at", "is_active", "is_suspended", "account_status", "city"),
        (("account_status", ACCOUNT_STATUSES),),
    ),
    ModelTests(
        "fct_payouts",
        "marts",
        ("payout_id",),
        (
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
        ),
        (("payout_status", PAYOUT_STATUSES), ("contractor_tier", TIERS)),
        (("contractor_id", "dim_contractors", "contractor_id"), ("job_id", "fct_jobs", "job_id")),
    ),
    ModelTests(
        "fct_adjustments",
        "marts",
        ("adjustment_id",),
        (
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
            "signed_amount_usd",
            "service_id",
            "contractor_id",
            "customer_id",
            "job_gross_amount_usd",
            "job_requested_at",
            "job_completed_at",
            "service_category",
            "contractor_tier",
        ),
        (
            ("adjustment_type", ADJUSTMENT_TYPES),
            ("adjustment_direction", DIRECTIONS),
            ("service_category", CATEGORIES),
            ("contractor_tier", TIERS),
        ),
        (("job_id", "fct_jobs", "job_id"),),
    ),
    ModelTests(
        "contractor_performance_summary",
        "marts",
        ("contractor_id",),
        (
            "contractor_id",
            "contractor_tier",
            "is_premium_tier",
            "commission_rate",
            "is_eligible_to_work",
            "city",
            "signup_at",
            "total_jobs",
            "completed_jobs",
            "canceled_jobs",
            "contractor_cancellations",
            "customer_cancellations",
            "total_gross_usd",
            "total_net_revenue_usd",
            "total_earned_usd",
            "jobs_with_refunds",
            "total_refunded_usd",
            "total_services",
            "available_services",
            "service_category_count",
        ),
        (("contractor_tier", TIERS),),
    ),
    ModelTests(
        "customer_health_summary",
        "marts",
        ("customer_id",),
        (
            "customer_id",
            "city",
            "account_status",
            "is_active",
            "is_suspended",
            "signup_at",
            "total_jobs",
            "completed_jobs",
            "canceled_jobs",
            "customer_cancellations",
            "total_gross_spend_usd",
            "total_net_spend_usd",
            "jobs_with_refunds",
            "total_refunded_usd",
            "full_refund_jobs",
            "health_segment",
        ),
        (("account_status", ACCOUNT_STATUSES), ("health_segment", HEALTH_SEGMENTS)),
    ),
    ModelTests(
        "service_category_performance",
        "marts",
        ("service_category",),
        (
            "service_category",
            "total_jobs",
            "completed_jobs",
            "canceled_jobs",
            "job_completion_rate_pct",
            "total_gross_revenue_usd",
            "total_net_revenue_usd",
            "avg_job_gross_usd",
            "total_platform_fee_usd",
            "jobs_with_refunds",
            "total_refunded_usd",
            "refund_rate_pct",
            "full_refund_jobs",
            "avg_hours_variance",
            "last_job_at",
            "total_listings",
            "available_listings",
            "contractor_count",
            "active_contractor_count",
            "min_hourly_rate_usd",
            "avg_hourly_rate_usd",
            "max_hourly_rate_usd",
            "budget_listing_pct",
            "standard_listing_pct",
            "premium_listing_pct",
            "completed_jobs_per_active_contractor",
        ),
        (("service_category", CATEGORIES),),
    ),
)

# Singular tests: (name, model, failing-row predicate, reported columns)
SINGULAR_TESTS = (
    ("assert_jobs_status_mutually_exclusive", "fct_jobs", "is_completed AND is_canceled", ("job_id",)),
    (
        "assert_completed_at_after_requested_at",
        "fct_jobs",
        "is_completed AND completed_at < requested_at",
        ("job_id", "requested_at", "completed_at"),
    ),
    (
        "assert_adjustment_amounts_positive",
        "fct_adjustments",
        "adjustment_amount_usd <= 0",
        ("adjustment_id", "adjustment_amount_usd"),
    ),
    (
        "assert_refund_amounts_non_negative",
        "fct_jobs",
        "total_refund_usd < 0",
        ("job_id", "total_refund_usd"),
    ),
)
# -----------------------------------------------------------------------------

DECLARED_KINDS = ("unique", "not_null", "accepted_values", "relationships")


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Test:
    """One declared or singular test: rows fail where ``fails`` holds for the model ``m``."""

    number: int
    kind: str
    layer: str
    model: str
    name: str
    column: str | None
    fails: str
    join: str = ""  # what ``fails`` needs beside the model

    @property
    def by_value(self) -> bool:
        """Whether it counts values instead of rows."""
        return self.kind in ("unique", "accepted_values")


Models = tuple[str, ...] | None


def tests_of(
    kinds: tuple[str, ...] = DECLARED_KINDS, singular: bool = False, view: str = "", models: Models = None
) -> list[Test]:
    """The selected tests in the order of their declaration, of all models or of ``models``.

    A unique test is asked of every key.
    """
    found: list[Test] = []

    def add(kind: str, spec: ModelTests, name: str, column: str | None, fails: str, join: str = "") -> None:
        layer = "singular" if kind == "singular" else spec.layer
        found.append(Test(len(found), kind, layer, spec.model, name, column, fails, join))

    for spec in DECLARED_TESTS:
        if "unique" in kinds:
            for c in spec.unique:
                add("unique", spec, "unique", c, f"m.{c} IS NOT NULL")
        if "not_null" in kinds:
            for c in spec.not_null:
                add("not_null", spec, "not_null", c, f"m.{c} IS NULL")
        if "accepted_values" in kinds:
            for c, values in spec.accepted:
                add("accepted_values", spec, "accepted_values", c, f"NOT (m.{c} IN ({', '.join(map(_lit, values))}))")
        if "relationships" in kinds:
            for i, (c, parent, pc) in enumerate(spec.relationships):
                # the declared parent's distinct keys: the row count does not change
                join = f"LEFT JOIN (SELECT DISTINCT {pc} AS __pk{i} FROM {view}{parent}) p{i} ON m.{c} = p{i}.__pk{i}"
                add("relationships", spec, f"relationships:{parent}.{pc}", c, f"m.{c} IS NOT NULL AND p{i}.__pk{i} IS NULL", join)
        if singular:
            for name, model, predicate, _ in SINGULAR_TESTS:
                if model == spec.model:
                    add("singular", spec, name, None, predicate)
    return [t for t in found if models is None or t.model in models]


def key_hash(value: str) -> tuple[str, str]:
    """Two independent 64-bit hashes of a SQL expression."""
    return f"xxhash64({value})", f"xxhash64('second', {value})"


Hash = Callable[[str], tuple[str, str]]


def _by_model(tests: list[Test]) -> dict[str, list[Test]]:
    models: dict[str, list[Test]] = {}
    for t in tests:
        models.setdefault(t.model, []).append(t)
    return models


def _found_sql(model: str, tests: list[Test], view: str, hashed: Hash) -> str:
    """(t, h1, h2) of everything that the tests of one model count, from one pass over it.

    A row with no failure gives the hash of its unique keys and nothing else.
    """

    def entry(t: Test) -> str:
        h1, h2 = hashed(f"m.{t.column}")
        return f"CASE WHEN {t.fails} THEN named_struct('t', {t.number}, 'h1', {h1}, 'h2', {h2}) END"

    keys = [entry(t) for t in tests if t.kind == "unique"]
    bad = [t for t in tests if t.kind != "unique"]
    every = f"array({', '.join(keys)})" if keys else None
    if bad:
        values = ", ".join(keys + [entry(t) for t in bad if t.by_value])
        rows = ", ".join(f"CASE WHEN {t.fails} THEN {t.number} END" for t in bad if not t.by_value)
        listed = [f"array({values})"] if values else []
        if rows:
            listed.append(f"transform(array_compact(array({rows})), t -> named_struct('t', t, 'h1', 0L, 'h2', 0L))")
        failing = " OR ".join(f"({t.fails})" for t in bad)
        every = f"CASE WHEN {failing} THEN concat({', '.join(listed)})" + (f" ELSE {every}" if every else "") + " END"
    joins = " ".join(t.join for t in tests)
    return f"SELECT t, h1, h2 FROM (SELECT inline({every}) FROM {view}{model} m {joins}) WHERE t IS NOT NULL"


def suite_sql(
    kinds: tuple[str, ...] = DECLARED_KINDS,
    singular: bool = False,
    view: str = "",
    hashed: Hash = key_hash,
    models: Models = None,
) -> str:
    """One Spark SQL statement over the model views: (t, h1, h2, n) of all that fails or may fail.

    Everything found in all models is counted in one exchange, combined map-side. Keys of
    a unique test that occur once are passed over.
    """
    tests = tests_of(kinds, singular, view, models)
    branches = [_found_sql(model, own, view, hashed) for model, own in _by_model(tests).items()]
    unique = ", ".join(str(t.number) for t in tests if t.kind == "unique")
    union = "\nUNION ALL\n".join(branches)
    having = f" HAVING n > 1 OR t NOT IN ({unique})" if unique else ""
    return f"SELECT t, h1, h2, count(*) AS n FROM (\n{union}\n) GROUP BY t, h1, h2{having}"


def _values_sql(tests: list[Test], again: str, view: str, hashed: Hash) -> str:
    """(t, h1, h2, value, n) of the values whose hashes are in the view ``again``."""
    branches = []
    for model, own in _by_model(tests).items():
        entries = []
        for t in own:
            h1, h2 = hashed(f"m.{t.column}")
            pair = f"named_struct('t', {t.number}, 'h1', {h1}, 'h2', {h2}, 'value', CAST(m.{t.column} AS STRING))"
            entries.append(f"CASE WHEN {t.fails} THEN {pair} END")
        branches.append(f"SELECT inline(array_compact(array({', '.join(entries)}))) FROM {view}{model} m")
    union = "\nUNION ALL\n".join(branches)
    return f"SELECT t, h1, h2, value, count(*) AS n FROM ({union}) LEFT SEMI JOIN {again} USING (t, h1, h2) GROUP BY t, h1, h2, value"


def test_counts(
    spark,
    kinds: tuple[str, ...],
    singular: bool,
    view: str,
    run: RunFolder,
    models: Models = None,
    hashed: Hash = key_hash,
) -> list[tuple[Test, int]]:
    """Every selected test with its failures, from the model views named ``view`` + model."""
    tests = tests_of(kinds, singular, view, models)
    found = run.table(spark.sql(suite_sql(kinds, singular, view, hashed, models)), "found")
    counts = {r.t: r for r in found.groupBy("t").agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows")).collect()}
    # a test by values with any hash found more than once: its values are told apart
    by_value = {t.number for t in tests if t.by_value}
    repeated = found.where("n > 1").where(F.col("t").isin(sorted(by_value)))
    alike = {r.t: r.n for r in repeated.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    values: dict[int, tuple[int, int]] = {}
    if alike:
        again = f"{view}found_again"
        repeated.select("t", "h1", "h2").createOrReplaceTempView(again)
        try:
            exact = spark.sql(_values_sql([t for t in tests if t.number in alike], again, view, hashed))
            for r in exact.groupBy("t").agg(F.count_if(F.col("n") > 1).alias("repeated"), F.count(F.lit(1)).alias("values")).collect():
                values[r.t] = (r.repeated, r["values"])
        finally:
            spark.catalog.dropTempView(again)

    def failures(t: Test) -> int:
        row = counts.get(t.number)
        if row is None:
            return 0
        repeats, different = values.get(t.number, (0, 0))
        if t.kind == "unique":
            return repeats
        if t.kind == "accepted_values":
            return row.groups - alike.get(t.number, 0) + different
        return row.rows

    return [(t, failures(t)) for t in tests]


# --- tests gathered while a model is written ---------------------------------------


def observed_counts(model: str) -> dict[Test, list[Column]]:
    """The not_null, accepted_values and singular tests of a model as metrics of its rows.

    A test counts its failing rows; a test of values also keeps the least and the greatest
    of them, as a metric must be bounded: equal ones are one value.
    """
    tests = [t for t in tests_of(("not_null", "accepted_values"), singular=True) if t.model == model]
    metrics: dict[Test, list[Column]] = {}
    for t in tests:
        fails = F.expr(t.fails.replace("m.", ""))
        name = f"t{t.number}"
        metrics[t] = [F.count_if(fails).alias(name)]
        if t.by_value:
            value = F.when(fails, F.col(t.column).cast("string"))
            metrics[t] += [F.min(value).alias(f"{name}_least"), F.max(value).alias(f"{name}_most")]
    return metrics


def observed_failures(df: DataFrame, tests: list[Test], metrics: dict) -> list[tuple[Test, int]]:
    """Failures of observed tests. ``df`` (the written model) is read only where a column holds several bad values."""
    found = []
    for t in tests:
        n = metrics[f"t{t.number}"] or 0
        if t.by_value and n:
            if metrics[f"t{t.number}_least"] == metrics[f"t{t.number}_most"]:
                n = 1
            else:
                n = df.where(F.expr(t.fails.replace("m.", ""))).select(t.column).distinct().count()
        found.append((t, n))
    return found


RESULT_SCHEMA = "layer string, model string, test string, column_name string, failures long"


def as_results(spark, counts: list[tuple[Test, int]]) -> DataFrame:
    return spark.createDataFrame([(t.layer, t.model, t.name, t.column, int(n)) for t, n in counts], RESULT_SCHEMA)


def declared_test_rows(resolve, model: str, test: str, column: str) -> DataFrame:
    """The failing rows of one declared test.

    A unique or accepted_values test gives the value and its number of rows, a not_null or
    relationships test the rows of the model.
    """
    for t in tests_of():
        if (t.model, t.name, t.column) == (model, test, column):
            df = resolve(model)
            if t.kind == "not_null":
                return df.where(F.col(column).isNull())
            if t.kind == "relationships":
                parent, key = test.removeprefix("relationships:").split(".")
                keys = resolve(parent).select(F.col(key).alias("__key")).distinct()
                return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("__key"), "left_anti")
            rows = df.where(F.expr(t.fails.replace("m.", ""))).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
            return rows.where("n_rows > 1") if t.kind == "unique" else rows
    raise KeyError((model, test, column))


def models_under_test(kinds: tuple[str, ...] = DECLARED_KINDS, models: Models = None) -> tuple[str, ...]:
    """The models that tests of these kinds read, declared parents included."""
    names: list[str] = []
    for spec in DECLARED_TESTS:
        if models is not None and spec.model not in models:
            continue
        if any(getattr(spec, {"accepted_values": "accepted"}.get(k, k)) for k in kinds):
            names.append(spec.model)
        if "relationships" in kinds:
            names += [parent for _, parent, _ in spec.relationships]
    return tuple(dict.fromkeys(names))


def declared_test_results(
    marketplace, kinds: tuple[str, ...] = DECLARED_KINDS, singular: bool = False, models: Models = None
) -> DataFrame:
    """Failing-row counts of the declared tests of the selected kinds, of all models or of ``models``.

    The run writes every model that it reads more than once, in dependency order,
    and deletes the files afterwards. What it returns is one row
    per test (287 at most), held by the driver: the files are gone by then.
    """
    spark = marketplace.stg_jobs.sparkSession
    tested = {spec.model for spec in DECLARED_TESTS}
    if unknown := [name for name in models or () if name not in tested]:
        raise KeyError(f"no tests are declared for {', '.join(unknown)}")
    if not tests_of(kinds, singular, models=models):
        return as_results(spark, [])
    names = models_under_test(kinds if not singular else DECLARED_KINDS, models)
    with RunFolder(spark, "data-tests") as run:
        files = marketplace.as_files(run, marketplace.files_for(names))
        view = f"t{run.path[-32:]}_"
        files.register_views(names, view)
        try:
            counts = test_counts(spark, kinds, singular, view, run, models)
        finally:
            for name in names:
                spark.catalog.dropTempView(view + name)
    return as_results(spark, counts)


def singular_test_rows(resolve, name: str) -> DataFrame:
    """The failing rows of one singular test (empty when it passes)."""
    for test, model, predicate, columns in SINGULAR_TESTS:
        if test == name:
            return resolve(model).where(F.expr(predicate)).select(*columns)
    raise KeyError(name)


def test_summary(marketplace, models: Models = None) -> DataFrame:
    """All 287 declared and singular tests (or those of ``models``), one row each, with a pass flag."""
    return declared_test_results(marketplace, DECLARED_KINDS, singular=True, models=models).withColumn("passed", F.col("failures") == 0)


def declared_test_count() -> int:
    n = sum(len(s.unique) + len(s.not_null) + len(s.accepted) + len(s.relationships) for s in DECLARED_TESTS)
    return n + len(SINGULAR_TESTS)
