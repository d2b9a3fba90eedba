"""Mutated inputs must trip the matching data-quality and integrity checks."""

from __future__ import annotations

import pytest
from builders import adjustment, contractor, job, marketplace, payout, service, user

from bazaar.operators import integrity, quality


def _clean_rows():
    return dict(
        users=[user(1), user(2), user(9)],
        contractor_profiles=[contractor(9)],
        services=[service(1, 9, "plumbing", 100.0)],
        jobs=[job(1, 1, 9, 1, "2024-04-01 10:00:00", "2024-04-01 12:00:00", est=2.0, act=2.0, gross=200.0)],
        adjustments=[adjustment(1, 1, "2024-04-02 00:00:00", "partial_refund", 20.0)],
        payouts=[payout(1, 9, 1, "2024-04-09 00:00:00", 0.2, 140.0)],
    )


def _failures(m) -> dict:
    return {(r["model"], r["test"], r["column_name"]): r["failures"] for r in quality.test_summary(m).collect()}


# Declared tests per model, as (unique, not_null, accepted_values, relationships).
DECLARED = {
    "stg_jobs": (1, 7, 0, 0),
    "stg_adjustments": (1, 5, 0, 0),
    "stg_payouts": (1, 7, 0, 0),
    "stg_contractor_profiles": (1, 5, 0, 0),
    "stg_services": (1, 6, 0, 0),
    "stg_users": (1, 5, 0, 0),
    "int_jobs_enriched": (1, 9, 1, 0),
    "int_adjustments_enriched": (1, 10, 2, 0),
    "int_payouts_enriched": (1, 8, 1, 0),
    "int_contractor_profiles_enriched": (1, 8, 1, 0),
    "int_services_enriched": (1, 7, 2, 0),
    "int_users_enriched": (1, 6, 1, 0),
    "fct_jobs": (1, 21, 5, 3),
    "dim_contractors": (1, 13, 2, 0),
    "dim_services": (1, 7, 2, 1),
    "dim_users": (1, 6, 1, 0),
    "fct_payouts": (1, 16, 2, 2),
    "fct_adjustments": (1, 19, 4, 1),
    "contractor_performance_summary": (1, 20, 1, 0),
    "customer_health_summary": (1, 16, 2, 0),
    "service_category_performance": (1, 26, 1, 0),
}


def test_declared_tests_per_model():
    """The oracle takes the test descriptors from the library; these literal counts do not."""
    got = {t.model: (len(t.unique), len(t.not_null), len(t.accepted), len(t.relationships)) for t in quality.DECLARED_TESTS}
    assert got == DECLARED
    assert [sum(c) for c in zip(*DECLARED.values(), strict=True)] == [21, 227, 28, 7]
    assert quality.declared_test_count() == 287


def test_clean_data_passes_everything(spark):
    m = marketplace(spark, **_clean_rows())
    fails = {k: v for k, v in _failures(m).items() if v}
    assert fails == {}
    assert all(r["violations"] == 0 for r in integrity.source_integrity(m.staged_sources).collect())
    assert all(r["violations"] == 0 for r in integrity.specification_rules(m.staged_sources).collect())


def test_mutations_trip_checks(spark):
    rows = _clean_rows()
    rows["users"] = rows["users"] + [user(2)]  # duplicate key
    rows["jobs"] = rows["jobs"] + [
        job(2, 1, 9, 77, "2024-04-01 10:00:00", "2024-04-01 12:00:00"),  # orphan customer
        job(3, 1, 9, 1, "2024-04-01 10:00:00", status=" Paused"),  # bad enum
        (4, None, 9, 1, None, None, "completed", 1.0, 1.0, 100.0),  # NULLs
    ]
    rows["adjustments"] = rows["adjustments"] + [adjustment(2, 1, "2024-04-02 00:00:00", "partial_refund", -5.0)]
    m = marketplace(spark, **rows)
    f = _failures(m)
    assert f[("stg_users", "unique", "user_id")] == 1
    assert f[("fct_jobs", "relationships:dim_users.user_id", "customer_id")] == 1
    assert f[("int_jobs_enriched", "accepted_values", "job_status")] == 1
    assert f[("stg_jobs", "not_null", "service_id")] == 1
    assert f[("stg_jobs", "not_null", "job_requested_at")] == 1
    assert f[("fct_adjustments", "assert_adjustment_amounts_positive", None)] == 1
    assert f[("fct_jobs", "assert_refund_amounts_non_negative", None)] == 0  # 20 - 5 still >= 0
    src = {r["check_name"]: r["violations"] for r in integrity.source_integrity(m.staged_sources).collect()}
    assert src["users_user_id_unique"] == 1
    assert src["jobs_customer_id_in_users"] == 1
    assert src["jobs_service_id_in_services"] == 1  # NULL key counts as orphan
    assert src["adjustment_amount_non_negative"] == 1
    rules = {r["check_name"]: r["violations"] for r in integrity.specification_rules(m.staged_sources).collect()}
    assert rules["completion_fields_only_when_completed"] == 1  # job 4 lacks completed_at
    assert rules["one_payout_per_completed_job"] == 2  # jobs 2 and 4 have no payout


def test_singular_tests_report_rows(spark):
    rows = _clean_rows()
    rows["jobs"] = [job(1, 1, 9, 1, "2024-04-01 10:00:00", "2024-04-01 08:00:00")]  # completes before request
    m = marketplace(spark, **rows)
    bad = quality.singular_test_rows(m.model, "assert_completed_at_after_requested_at").collect()
    assert [r["job_id"] for r in bad] == [1]
    rules = {r["check_name"]: r["violations"] for r in integrity.specification_rules(m.staged_sources).collect()}
    assert rules["adjustment_within_30_days_of_completion"] == 0


def test_profile_counts_nulls_and_duplicates(spark):
    rows = _clean_rows()
    rows["users"] = [user(1), user(1), user(1), user(2, city=None)]
    m = marketplace(spark, **rows)
    prof = integrity.profile_table(m.stg_users, "users").collect()
    by_col = {r["column_name"]: r for r in prof}
    assert by_col["city"]["null_count"] == 1 and by_col["user_id"]["null_count"] == 0
    assert by_col["city"]["duplicate_rows"] == 2 and by_col["city"]["row_count"] == 4
    assert by_col["signup_date"]["data_type"] == "TIMESTAMP" and by_col["user_id"]["data_type"] == "BIGINT"
    assert by_col["user_id"]["column_count"] == 5


def test_rate_rules_ignore_jobs_without_status(spark):
    rows = _clean_rows()
    rows["jobs"] = rows["jobs"] + [(5, 1, 9, 1, None, None, None, 1.0, None, None)]
    m = marketplace(spark, **rows)
    rules = {r["check_name"]: r["violations"] for r in integrity.specification_rules(m.staged_sources).collect()}
    assert rules["actual_hours_within_30_pct"] == 0
    assert rules["gross_is_actual_hours_times_rate"] == 0


def _messy():
    rows = _clean_rows()
    rows["users"] = rows["users"] + [user(2), user(2), user(1)]
    rows["jobs"] = rows["jobs"] + [
        job(2, 1, 9, 77, "2024-04-01 10:00:00", "2024-04-01 12:00:00"),
        job(3, 1, 9, 1, "2024-04-01 10:00:00", status=" Paused"),
        job(5, 1, 9, 1, "2024-04-01 10:00:00", status="lost"),
        job(6, 1, 9, 1, "2024-04-01 10:00:00", status="lost"),
        (4, None, 9, 1, None, None, "completed", 1.0, 1.0, 100.0),
    ]
    rows["adjustments"] = rows["adjustments"] + [adjustment(2, 1, "2024-04-02 00:00:00", "partial_refund", -500.0)]
    return rows


def test_equal_hashes_of_different_values_are_told_apart(spark, monkeypatch):
    """With a hash of two values only, nearly all keys share one; the counts stay the same."""
    m = marketplace(spark, **_messy())
    want = _failures(m)
    assert want[("stg_users", "unique", "user_id")] == 2 and want[("int_jobs_enriched", "accepted_values", "job_status")] == 2
    poor = lambda v: (f"xxhash64({v}) & 1L", "0L")
    real = quality.test_counts
    monkeypatch.setattr(quality, "test_counts", lambda *a: real(*a, hashed=poor))
    assert _failures(m) == want


def test_tests_gathered_while_building(spark, tmp_path):
    """The metrics of the build are the counts of the test run, and the models are written as before."""
    for rows in (_clean_rows(), _messy()):
        m = marketplace(spark, **rows)
        where = tmp_path / str(len(rows["jobs"]))
        paths, results = m.build_tested(str(where))
        got = {(r["model"], r["test"], r["column_name"]): r["failures"] for r in results.collect()}
        want = {k: v for k, v in _failures(m).items() if k[1] in ("not_null", "accepted_values") or k[1].startswith("assert_")}
        assert got == want
        plain = m.build(str(where / "plain"))
        assert set(plain) == set(paths)
        for name in ("fct_jobs", "customer_health_summary"):
            assert sorted(map(str, spark.read.parquet(paths[name]).collect())) == sorted(map(str, spark.read.parquet(plain[name]).collect()))


def test_failing_rows_of_declared_tests(spark):
    m = marketplace(spark, **_messy())
    rows = lambda *test: quality.declared_test_rows(m.model, *test).collect()
    assert sorted(map(tuple, rows("stg_users", "unique", "user_id"))) == [(1, 2), (2, 3)]
    assert [r.job_id for r in rows("stg_jobs", "not_null", "service_id")] == [4]
    assert sorted(map(tuple, rows("int_jobs_enriched", "accepted_values", "job_status"))) == [("lost", 2), ("paused", 1)]
    assert [r.job_id for r in rows("fct_jobs", "relationships:dim_users.user_id", "customer_id")] == [2]
    counts = _failures(m)
    for t in quality.tests_of():
        if counts[(t.model, t.name, t.column)]:
            assert len(rows(t.model, t.name, t.column)) == counts[(t.model, t.name, t.column)]


def test_selected_models(spark, tmp_path):
    m = marketplace(spark, **_messy())
    chosen = ("dim_users", "fct_jobs", "customer_health_summary")
    rows = quality.test_summary(m, chosen).collect()
    got = {(r["model"], r["test"], r["column_name"]): r["failures"] for r in rows}
    assert got == {k: v for k, v in _failures(m).items() if k[0] in chosen} and len(rows) == len(got) > 20
    assert quality.declared_test_results(m, ("relationships",), models=("dim_users",)).count() == 0
    with pytest.raises(KeyError, match="no_such"):
        quality.test_summary(m, ("no_such",))
    # built in dependency order whatever the order of the names, the scorecard from the fact's roll-ups
    paths = m.build(str(tmp_path), ("customer_health_summary", "fct_jobs"))
    assert list(paths) == ["fct_jobs", "customer_health_summary"]
    assert (tmp_path / "rollups" / "job_states").is_dir()
    for name, path in paths.items():
        assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, m.model(name).collect()))
