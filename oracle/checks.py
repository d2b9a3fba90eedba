"""DuckDB SQL for the data-quality, integrity, reconciliation, KPI and primitive queries.

Declared tests are generated from the same descriptors the Spark jobs use
(the *what*); the SQL below states the test semantics independently
(the *how*): GROUP BY/HAVING for unique, FILTER counts for not_null, NOT IN
over grouped values for accepted_values, NOT EXISTS for relationships.
"""

from __future__ import annotations

from bazaar.operators.quality import DECLARED_TESTS, SINGULAR_TESTS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _unique_sql() -> list[str]:
    out = []
    for t in DECLARED_TESTS:
        for c in t.unique:
            out.append(
                f"SELECT {_q(t.layer)} AS layer, {_q(t.model)} AS model, 'unique' AS test, {_q(c)} AS column_name, "
                f"CAST(count(*) AS BIGINT) AS failures "
                f"FROM (SELECT {c} FROM {t.model} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d"
            )
    return out


def _not_null_sql() -> list[str]:
    out = []
    for t in DECLARED_TESTS:
        for c in t.not_null:
            out.append(
                f"SELECT {_q(t.layer)} AS layer, {_q(t.model)} AS model, 'not_null' AS test, {_q(c)} AS column_name, "
                f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {t.model}"
            )
    return out


def _accepted_sql() -> list[str]:
    out = []
    for t in DECLARED_TESTS:
        for c, values in t.accepted:
            allowed = ", ".join(_q(v) for v in values)
            out.append(
                f"SELECT {_q(t.layer)} AS layer, {_q(t.model)} AS model, 'accepted_values' AS test, "
                f"{_q(c)} AS column_name, CAST(count(*) AS BIGINT) AS failures "
                f"FROM (SELECT {c} AS v FROM {t.model} GROUP BY {c}) g WHERE v NOT IN ({allowed})"
            )
    return out


def _relationships_sql() -> list[str]:
    out = []
    for t in DECLARED_TESTS:
        for c, parent, pc in t.relationships:
            out.append(
                f"SELECT {_q(t.layer)} AS layer, {_q(t.model)} AS model, {_q(f'relationships:{parent}.{pc}')} AS test, "
                f"{_q(c)} AS column_name, CAST(count(*) AS BIGINT) AS failures "
                f"FROM {t.model} ch WHERE ch.{c} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {parent} pa WHERE pa.{pc} = ch.{c})"
            )
    return out


def _singular_counts_sql() -> list[str]:
    return [
        f"SELECT 'singular' AS layer, {_q(model)} AS model, {_q(name)} AS test, CAST(NULL AS VARCHAR) AS column_name, "
        f"CAST(count(*) AS BIGINT) AS failures FROM {model} WHERE {predicate}"
        for name, model, predicate, _ in SINGULAR_TESTS
    ]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _singular_rows(name: str) -> str:
    for test, model, predicate, cols in SINGULAR_TESTS:
        if test == name:
            return f"SELECT {', '.join(cols)} FROM {model} WHERE {predicate}"
    raise KeyError(name)


INTEGRITY_SOURCES = """
SELECT 'users_user_id_unique' AS check_name, count(*) AS violations
  FROM (SELECT user_id FROM stg_users GROUP BY user_id HAVING count(*) > 1) d
UNION ALL SELECT 'contractor_profiles_user_id_in_users', count(*) FROM stg_contractor_profiles c
  WHERE NOT EXISTS (SELECT 1 FROM stg_users u WHERE u.user_id = c.user_id)
UNION ALL SELECT 'services_contractor_id_in_contractor_profiles', count(*) FROM stg_services s
  WHERE NOT EXISTS (SELECT 1 FROM stg_contractor_profiles c WHERE c.user_id = s.contractor_id)
UNION ALL SELECT 'jobs_service_id_in_services', count(*) FROM stg_jobs j
  WHERE NOT EXISTS (SELECT 1 FROM stg_services s WHERE s.service_id = j.service_id)
UNION ALL SELECT 'jobs_contractor_id_in_contractor_profiles', count(*) FROM stg_jobs j
  WHERE NOT EXISTS (SELECT 1 FROM stg_contractor_profiles c WHERE c.user_id = j.contractor_id)
UNION ALL SELECT 'jobs_customer_id_in_users', count(*) FROM stg_jobs j
  WHERE NOT EXISTS (SELECT 1 FROM stg_users u WHERE u.user_id = j.customer_id)
UNION ALL SELECT 'adjustments_job_id_in_jobs', count(*) FROM stg_adjustments a
  WHERE NOT EXISTS (SELECT 1 FROM stg_jobs j WHERE j.job_id = a.job_id)
UNION ALL SELECT 'payouts_job_id_in_jobs', count(*) FROM stg_payouts p
  WHERE NOT EXISTS (SELECT 1 FROM stg_jobs j WHERE j.job_id = p.job_id)
UNION ALL SELECT 'adjustment_amount_non_negative',
  count(*) FILTER (WHERE NOT coalesce(adjustment_amount >= 0 AND NOT isnan(adjustment_amount), false)) FROM stg_adjustments
UNION ALL SELECT 'payout_amount_non_negative',
  count(*) FILTER (WHERE NOT coalesce(payout_amount >= 0 AND NOT isnan(payout_amount), false)) FROM stg_payouts
"""

INTEGRITY_RULES = """
SELECT 'suspended_users_are_inactive' AS check_name,
  count(*) FILTER (WHERE NOT coalesce(NOT (is_suspended AND is_active), false)) AS violations FROM stg_users
UNION ALL SELECT 'commission_matches_tier',
  count(*) FILTER (WHERE NOT coalesce(commission_rate = CASE lower(trim(contractor_tier))
      WHEN 'premium' THEN 0.15::DOUBLE WHEN 'standard' THEN 0.20::DOUBLE END, false))
  FROM stg_contractor_profiles
UNION ALL SELECT 'contractor_has_at_most_5_services', count(*)
  FROM (SELECT contractor_id FROM stg_services GROUP BY contractor_id HAVING count(*) > 5) d
UNION ALL SELECT 'job_contractor_matches_service',
  count(*) FILTER (WHERE NOT coalesce(j.contractor_id = s.contractor_id, false))
  FROM stg_jobs j JOIN stg_services s ON s.service_id = j.service_id
UNION ALL SELECT 'customer_is_not_a_contractor', count(*) FROM stg_jobs j
  WHERE EXISTS (SELECT 1 FROM stg_contractor_profiles c WHERE c.user_id = j.customer_id)
UNION ALL SELECT 'completion_fields_only_when_completed',
  count(*) FILTER (WHERE NOT coalesce(CASE WHEN lower(trim(job_status)) = 'completed'
      THEN NOT (job_completed_at IS NULL OR actual_hours IS NULL OR gross_amount IS NULL)
      ELSE (job_completed_at IS NULL AND actual_hours IS NULL AND gross_amount IS NULL) END, false))
  FROM stg_jobs
UNION ALL SELECT 'actual_hours_within_30_pct',
  count(*) FILTER (WHERE NOT coalesce(actual_hours >= estimated_hours * 0.7::DOUBLE - 0.01::DOUBLE
      AND actual_hours <= estimated_hours * 1.3::DOUBLE + 0.01::DOUBLE, false))
  FROM stg_jobs WHERE lower(trim(job_status)) = 'completed'
UNION ALL SELECT 'gross_is_actual_hours_times_rate',
  count(*) FILTER (WHERE NOT coalesce(abs(j.gross_amount - j.actual_hours * s.hourly_rate) <= 0.01::DOUBLE, false))
  FROM stg_jobs j JOIN stg_services s ON s.service_id = j.service_id
  WHERE lower(trim(j.job_status)) = 'completed'
UNION ALL SELECT 'adjustments_only_on_completed_jobs',
  count(*) FILTER (WHERE NOT coalesce(lower(trim(j.job_status)) = 'completed', false))
  FROM stg_adjustments a JOIN stg_jobs j ON j.job_id = a.job_id
UNION ALL SELECT 'adjustment_within_gross',
  count(*) FILTER (WHERE NOT coalesce(a.adjustment_amount <= j.gross_amount, false))
  FROM stg_adjustments a JOIN stg_jobs j ON j.job_id = a.job_id
UNION ALL SELECT 'adjustment_within_30_days_of_completion',
  count(*) FILTER (WHERE NOT coalesce(a.adjustment_date >= j.job_completed_at
      AND a.adjustment_date <= j.job_completed_at + INTERVAL '30' DAY, false))
  FROM stg_adjustments a JOIN stg_jobs j ON j.job_id = a.job_id
UNION ALL SELECT 'one_payout_per_completed_job',
  count(*) FILTER (WHERE NOT coalesce(CASE WHEN lower(trim(j.job_status)) = 'completed'
      THEN coalesce(n.n_payouts, 0) = 1 ELSE coalesce(n.n_payouts, 0) = 0 END, false))
  FROM stg_jobs j LEFT JOIN (SELECT job_id, count(*) AS n_payouts FROM stg_payouts GROUP BY job_id) n
    ON n.job_id = j.job_id
UNION ALL SELECT 'payout_7_to_14_days_after_completion',
  count(*) FILTER (WHERE NOT coalesce(p.payout_date >= j.job_completed_at + INTERVAL '7' DAY
      AND p.payout_date <= j.job_completed_at + INTERVAL '14' DAY, false))
  FROM stg_payouts p JOIN stg_jobs j ON j.job_id = p.job_id
UNION ALL SELECT 'payout_contractor_matches_job',
  count(*) FILTER (WHERE NOT coalesce(p.contractor_id = j.contractor_id, false))
  FROM stg_payouts p JOIN stg_jobs j ON j.job_id = p.job_id
UNION ALL SELECT 'payout_commission_matches_profile',
  count(*) FILTER (WHERE NOT coalesce(p.commission_rate = c.commission_rate, false))
  FROM stg_payouts p JOIN stg_contractor_profiles c ON c.user_id = p.contractor_id
"""

_PROFILED = {
    "users": "stg_users",
    "contractor_profiles": "stg_contractor_profiles",
    "services": "stg_services",
    "jobs": "stg_jobs",
    "adjustments": "stg_adjustments",
    "payouts": "stg_payouts",
}


def _profile_sql() -> str:
    from bazaar.sources.schemas import RAW_SCHEMAS

    parts = []
    for table, view in _PROFILED.items():
        cols = RAW_SCHEMAS[table].fieldNames()
        dup = f"(SELECT count(*) FROM {view}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {view}) d)"
        for c in cols:
            parts.append(
                f"SELECT {_q(table)} AS table_name, {_q(c)} AS column_name, any_value(typeof({c})) AS data_type, "
                f"count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = 'nan') AS null_count, count(*) AS row_count, "
                f"CAST({len(cols)} AS BIGINT) AS column_count, CAST({dup} AS BIGINT) AS duplicate_rows FROM {view}"
            )
    return _union(parts)


RECONCILE_CTES = """
rc_base AS (
    SELECT p.payout_id, p.job_id, p.contractor_id, p.paid_at, p.commission_rate, j.gross_amount_usd,
           p.payout_amount_usd,
           CAST(coalesce(sum(a.adjustment_amount_usd) FILTER (WHERE a.is_refund), 0) AS DECIMAL(38,2))
               AS refunds_before_payout_usd,
           CAST(coalesce(sum(a.adjustment_amount_usd) FILTER (WHERE a.is_goodwill_bonus), 0) AS DECIMAL(38,2))
               AS bonuses_before_payout_usd,
           count(a.adjustment_id) AS adjustments_before_payout
    FROM int_payouts_enriched p
    LEFT JOIN int_jobs_enriched j ON j.job_id = p.job_id
    LEFT JOIN int_adjustments_enriched a ON a.job_id = p.job_id AND a.adjusted_at <= p.paid_at
    GROUP BY p.payout_id, p.job_id, p.contractor_id, p.paid_at, p.commission_rate, j.gross_amount_usd,
             p.payout_amount_usd),
rc_expected AS (
    SELECT *,
           CAST(greatest(0, round(gross_amount_usd - gross_amount_usd * commission_rate
                                  - refunds_before_payout_usd + bonuses_before_payout_usd, 2)) AS DECIMAL(38,2))
               AS expected_payout_usd
    FROM rc_base),
reconcile_payouts AS (
    SELECT *, CAST(payout_amount_usd - expected_payout_usd AS DECIMAL(38,2)) AS difference_usd,
           abs(CAST(payout_amount_usd - expected_payout_usd AS DECIMAL(38,2))) <= 0.01 AS is_reconciled
    FROM rc_expected)
"""

RECONCILE_SUMMARY = """
SELECT count(*) AS payouts,
       count(*) FILTER (WHERE is_reconciled) AS reconciled,
       count(*) FILTER (WHERE NOT is_reconciled) AS unreconciled,
       count(*) FILTER (WHERE is_reconciled IS NULL) AS unknown,
       CAST(sum(abs(difference_usd)) AS DECIMAL(38,2)) AS total_abs_difference_usd
FROM reconcile_payouts
"""

ADJUSTMENTS_AFTER_PAYOUT = """
SELECT a.adjustment_id, a.job_id, a.adjusted_at, a.adjustment_type, a.adjustment_amount_usd,
       CASE a.adjustment_direction WHEN 'debit' THEN -a.adjustment_amount_usd
                                   WHEN 'credit' THEN a.adjustment_amount_usd END AS signed_amount_usd,
       lp.last_paid_at
FROM int_adjustments_enriched a
JOIN (SELECT job_id, max(paid_at) AS last_paid_at FROM int_payouts_enriched GROUP BY job_id) lp
  ON lp.job_id = a.job_id
WHERE a.adjusted_at > lp.last_paid_at
"""

KPI_MARKETPLACE = """
SELECT count(*) AS total_jobs,
       count(*) FILTER (WHERE is_completed) AS completed_jobs,
       count(*) FILTER (WHERE is_canceled) AS canceled_jobs,
       sum(gross_amount_usd) AS gross_booking_value_usd,
       sum(net_revenue_usd) AS net_booking_value_usd,
       round(fsum(total_platform_fee_usd), 2) AS platform_revenue_usd,
       sum(total_payout_amount_usd) AS contractor_earnings_usd,
       round(100.0 * count(*) FILTER (WHERE is_canceled) / nullif(count(*), 0), 2) AS cancellation_rate_pct
FROM fct_jobs
"""

AGG_FUNCTIONS = """
SELECT service_category,
       count(*) AS f1_jobs,
       count(*) FILTER (WHERE is_completed) AS f2_completed_jobs,
       count(DISTINCT customer_id) AS f3_distinct_customers,
       count(DISTINCT contractor_id) FILTER (WHERE is_completed) AS f4_distinct_completing_contractors,
       sum(gross_amount_usd) AS f5_gross_sum_usd,
       round(fsum(total_platform_fee_usd), 2) AS f5_platform_fee_sum_usd,
       sum(CASE WHEN has_full_refund THEN gross_amount_usd ELSE 0 END) AS f6_fully_refunded_gross_usd,
       round(avg(gross_amount_usd), 2) AS f7_avg_gross_usd,
       round(avg(gross_amount_usd) FILTER (WHERE total_refund_usd > 0), 2) AS f7_avg_refunded_job_gross_usd,
       min(gross_amount_usd) AS f8_min_gross_usd,
       max(gross_amount_usd) AS f8_max_gross_usd,
       min(requested_at) AS f8_first_requested_at,
       max(completed_at) AS f8_last_completed_at,
       bool_or(has_pending_payout) AS f9_any_pending_payout,
       bool_or(has_full_refund) AS f9_any_full_refund,
       round(100.0 * count(*) FILTER (WHERE is_canceled) / nullif(count(*), 0), 2) AS f10_cancel_rate_pct
FROM fct_jobs GROUP BY service_category
"""

SCALAR_FUNCTIONS = """
SELECT CAST(j.job_id AS BIGINT) AS job_id,
       lower(trim(j.job_status)) AS g1_status,
       lower(trim(s.service_category)) AS g1_category,
       CAST(j.gross_amount AS DECIMAL(10,2)) AS g2_gross_usd,
       round(j.estimated_hours * s.hourly_rate / 3, 2) AS g3_estimate_third_usd,
       coalesce(j.actual_hours, j.estimated_hours) AS g4_hours,
       j.gross_amount / nullif(j.actual_hours, 0) AS g5_effective_rate,
       CASE lower(trim(j.job_status)) WHEN 'canceled_by_customer' THEN 'customer'
                                      WHEN 'canceled_by_contractor' THEN 'contractor' END AS g6_canceled_by,
       CASE WHEN s.hourly_rate < 75 THEN 'budget' WHEN s.hourly_rate < 125 THEN 'mid_range' ELSE 'premium' END
           AS g7_rate_tier,
       lower(trim(j.job_status)) IN ('canceled_by_customer', 'canceled_by_contractor') AS g8_is_canceled,
       (j.estimated_hours >= 2 AND j.estimated_hours <= 6) OR j.actual_hours IS NULL AS g8_mid_estimate_or_open,
       lower(trim(j.job_status)) = 'completed' AND CAST(j.gross_amount AS DECIMAL(10,2)) > 100
           AS g9_completed_over_100,
       CASE WHEN j.job_completed_at IS NOT NULL THEN date_diff('hour', j.job_requested_at, j.job_completed_at) END
           AS g10_duration_hours,
       j.job_requested_at - INTERVAL '90' DAY AS g11_requested_minus_90d,
       CAST(-(CAST(j.gross_amount AS DECIMAL(10,2))
              - CAST(j.estimated_hours AS DECIMAL(10,2)) * CAST(s.hourly_rate AS DECIMAL(10,2))) AS DECIMAL(38,2))
           AS g12_estimate_gap_usd
FROM stg_jobs j LEFT JOIN stg_services s ON s.service_id = j.service_id
"""

#: The totals of the three owners, and of the whole fact.
JOB_ROLLUPS = """
WITH whole AS (
    SELECT count(*) AS n, count(*) FILTER (WHERE is_completed) AS n_done, count(*) FILTER (WHERE is_canceled) AS n_off,
           count(*) FILTER (WHERE canceled_by = 'contractor') AS off_contractor,
           count(*) FILTER (WHERE canceled_by = 'customer') AS off_customer,
           count(*) FILTER (WHERE total_refund_usd > 0) AS refunds, count(*) FILTER (WHERE has_full_refund) AS full_refunds,
           sum(gross_amount_usd) AS gross, sum(net_revenue_usd) AS net, sum(total_payout_amount_usd) AS earned,
           sum(total_refund_usd) AS refunded, fsum(total_platform_fee_usd) AS fees,
           sum(gross_amount_usd) FILTER (WHERE is_completed) AS done_gross,
           count(gross_amount_usd) FILTER (WHERE is_completed) AS done_grossed,
           fsum(hours_variance) FILTER (WHERE is_completed) AS variance,
           count(hours_variance) FILTER (WHERE is_completed) AS varied,
           min(requested_at) AS first_at, max(requested_at) AS last_at, max(completed_at) AS done_at
    FROM fct_jobs),
each AS (
    SELECT owner AS grain, key, n, n_done, n_off, off_contractor, off_customer, refunds, full_refunds, gross, net, earned,
           refunded, fees, done_gross, done_grossed, variance, varied, first_at, last_at, done_at FROM owner_totals
    UNION ALL
    SELECT 'all', NULL, n, n_done, n_off, off_contractor, off_customer, refunds, full_refunds, gross, net, earned,
           refunded, fees, done_gross, done_grossed, variance, varied, first_at, last_at, done_at FROM whole WHERE n > 0
    UNION ALL
    SELECT 'category', NULL, count(*), count(*) FILTER (WHERE is_completed), count(*) FILTER (WHERE is_canceled),
           count(*) FILTER (WHERE canceled_by = 'contractor'), count(*) FILTER (WHERE canceled_by = 'customer'),
           count(*) FILTER (WHERE total_refund_usd > 0), count(*) FILTER (WHERE has_full_refund),
           sum(gross_amount_usd), sum(net_revenue_usd), sum(total_payout_amount_usd), sum(total_refund_usd),
           fsum(total_platform_fee_usd), sum(gross_amount_usd) FILTER (WHERE is_completed),
           count(gross_amount_usd) FILTER (WHERE is_completed), fsum(hours_variance) FILTER (WHERE is_completed),
           count(hours_variance) FILTER (WHERE is_completed), min(requested_at), max(requested_at), max(completed_at)
    FROM fct_jobs WHERE service_category IS NULL HAVING count(*) > 0),
amounts AS (
    SELECT owner, key, total_platform_fee_usd * 4294967296 AS fee, CASE WHEN is_completed THEN hours_variance END * 4294967296 AS gap FROM owned_jobs
    UNION ALL SELECT 'all', NULL, total_platform_fee_usd * 4294967296, CASE WHEN is_completed THEN hours_variance END * 4294967296 FROM fct_jobs
    UNION ALL SELECT 'category', NULL, total_platform_fee_usd * 4294967296, CASE WHEN is_completed THEN hours_variance END * 4294967296 FROM fct_jobs WHERE service_category IS NULL),
-- totals of one owner often end on half a cent, where a compensated sum of parts depends on their order: exact sums
exact AS (
    SELECT owner, key AS owner_key, (sum(floor(fee)::HUGEINT)::DOUBLE + sum(fee - floor(fee))) / 4294967296 AS fee,
           (sum(floor(gap)::HUGEINT)::DOUBLE + sum(gap - floor(gap))) / 4294967296 AS gap
    FROM amounts GROUP BY owner, key)
SELECT grain, CASE WHEN grain = 'contractor' THEN key::BIGINT END AS contractor_id,
       CASE WHEN grain = 'customer' THEN key::BIGINT END AS customer_id,
       CASE WHEN grain = 'category' THEN key END AS service_category,
       n AS total_jobs, n_done AS completed_jobs, n_off AS canceled_jobs, off_contractor AS contractor_cancellations,
       off_customer AS customer_cancellations, refunds AS jobs_with_refunds, full_refunds AS full_refund_jobs,
       gross AS total_gross_usd, net AS total_net_revenue_usd, earned AS total_earned_usd, refunded AS total_refunded_usd,
       round(x.fee, 2) AS total_platform_fee_usd,
       round((done_gross * 100)::DOUBLE / nullif(done_grossed * 100, 0)::DOUBLE, 2) AS avg_job_gross_usd,
       round(x.gap / nullif(varied, 0)::DOUBLE, 2) AS avg_hours_variance,
       round(100.0 * n_done / n, 2) AS completion_rate_pct, round(100.0 * n_off / n, 2) AS cancellation_rate_pct,
       round(100.0 * refunds / nullif(n_done, 0), 2) AS refund_rate_pct,
       first_at AS first_job_at, last_at AS last_job_at, done_at AS last_completed_at
FROM each LEFT JOIN exact x ON x.owner = grain AND x.owner_key IS NOT DISTINCT FROM key
"""

# selects run after the model CTEs (and RECONCILE_CTES)
#: The singular tests over raw tables with a few spoiled rows (see ``sources.SPOILED_CTES``).
SPOILED_SQL: dict[str, str] = {
    "dq_completion_order_spoiled": _singular_rows("assert_completed_at_after_requested_at"),
    "dq_adjustment_positive_spoiled": _singular_rows("assert_adjustment_amounts_positive"),
    "dq_refund_non_negative_spoiled": _singular_rows("assert_refund_amounts_non_negative"),
}

CHECK_SQL: dict[str, str] = {
    "dq_unique": _union(_unique_sql()),
    "dq_not_null": _union(_not_null_sql()),
    "dq_accepted_values": _union(_accepted_sql()),
    "dq_relationships": _union(_relationships_sql()),
    "dq_status_exclusive": _singular_rows("assert_jobs_status_mutually_exclusive"),
    "dq_completion_order": _singular_rows("assert_completed_at_after_requested_at"),
    "dq_adjustment_positive": _singular_rows("assert_adjustment_amounts_positive"),
    "dq_refund_non_negative": _singular_rows("assert_refund_amounts_non_negative"),
    "dq_summary": "SELECT *, failures = 0 AS passed FROM ("
    + _union(_unique_sql() + _not_null_sql() + _accepted_sql() + _relationships_sql() + _singular_counts_sql())
    + ") t",
    "integrity_sources": INTEGRITY_SOURCES,
    "integrity_rules": INTEGRITY_RULES,
    "profile_table": _profile_sql(),
    "reconcile_payouts": "SELECT * FROM reconcile_payouts",
    "reconcile_summary": RECONCILE_SUMMARY,
    "adjustments_after_payout": ADJUSTMENTS_AFTER_PAYOUT,
    "kpi_marketplace": KPI_MARKETPLACE,
    "job_rollups": f"SELECT * FROM ({JOB_ROLLUPS.strip()}) r",
    "upkept_fct_jobs": "SELECT * FROM fct_jobs",
    "upkept_job_rollups": f"SELECT * FROM ({JOB_ROLLUPS.strip()}) r",
    "agg_functions": AGG_FUNCTIONS,
    "scalar_functions": SCALAR_FUNCTIONS,
}
