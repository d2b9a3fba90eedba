"""DuckDB SQL of the distribution rules: shares, ranges and seasons."""

SHARES = """
, stated(rule, category, lo, hi) AS (VALUES
    ('users_active', 'active', 0.95::DOUBLE, 0.95::DOUBLE), ('service_category', 'cleaning', 0.35, 0.35),
    ('service_category', 'plumbing', 0.25, 0.25), ('service_category', 'electrical', 0.20, 0.20),
    ('service_category', 'landscaping', 0.20, 0.20), ('jobs_canceled', 'canceled', 0.12, 0.18),
    ('jobs_adjusted', 'adjusted', 0.08, 0.12), ('adjustment_type', 'partial_refund', 0.70, 0.70),
    ('adjustment_type', 'full_refund', 0.20, 0.20), ('adjustment_type', 'goodwill_bonus', 0.10, 0.10),
    ('payouts_completed', 'completed', 0.95, 0.95)
), marked AS (
    SELECT 'users_active' AS rule, CASE WHEN is_active THEN 'active' ELSE '' END AS category FROM stg_users WHERE is_active IS NOT NULL
    UNION ALL SELECT 'service_category', lower(trim(service_category)) FROM stg_services WHERE service_category IS NOT NULL
    UNION ALL SELECT 'jobs_canceled', CASE WHEN lower(trim(job_status)) LIKE 'canceled%' THEN 'canceled' ELSE '' END FROM stg_jobs WHERE job_status IS NOT NULL
    UNION ALL SELECT 'adjustment_type', lower(trim(adjustment_type)) FROM stg_adjustments WHERE adjustment_type IS NOT NULL
    UNION ALL SELECT 'payouts_completed', lower(trim(payout_status)) FROM stg_payouts WHERE payout_status IS NOT NULL
), counted AS (
    SELECT s.rule, s.category, s.lo, s.hi,
        CASE WHEN s.rule = 'jobs_adjusted' THEN (SELECT count(job_id) FROM stg_adjustments)
             ELSE (SELECT count(*) FROM marked m WHERE m.rule = s.rule AND m.category = s.category) END AS observed,
        CASE WHEN s.rule = 'jobs_adjusted' THEN (SELECT count(*) FROM stg_jobs WHERE lower(trim(job_status)) = 'completed')
             ELSE (SELECT count(*) FROM marked m WHERE m.rule = s.rule) END AS total
    FROM stated s
), shared AS (
    SELECT *, CASE WHEN total > 0 THEN observed::DOUBLE / total::DOUBLE END AS share FROM counted
), nearest AS (
    SELECT *, CASE WHEN share < lo THEN lo WHEN share > hi THEN hi ELSE share END AS p FROM shared
), tested AS (
    SELECT *, (observed - total * p) * (observed - total * p) / nullif(total * p * (1 - p), 0) AS z,
        (observed - total * p) * (observed - total * p) / nullif(total * p, 0) AS pearson FROM nearest
), listed AS (
    SELECT rule, category, observed, total, lo, hi, share, z AS statistic, 10.828::DOUBLE AS critical FROM tested
    UNION ALL
    SELECT rule, 'all', sum(observed), max(total), 1, 1, sum(observed)::DOUBLE / nullif(max(total), 0)::DOUBLE, sum(pearson),
        CASE rule WHEN 'service_category' THEN 16.266 ELSE 13.816 END::DOUBLE
    FROM tested WHERE rule IN ('service_category', 'adjustment_type') GROUP BY rule
)
SELECT rule, category, observed::BIGINT AS observed, total::BIGINT AS total, lo::DOUBLE AS expected_low, hi::DOUBLE AS expected_high,
    round(share, 6) AS share, round(statistic, 6) AS statistic, critical, coalesce(round(statistic, 6) <= critical, true) AS passed
FROM listed
"""

RATES = """
, stated(service_category, lo, hi) AS (VALUES
    ('cleaning', 25::DOUBLE, 60::DOUBLE), ('plumbing', 60, 150), ('electrical', 70, 160), ('landscaping', 40, 120)
)
SELECT t.service_category, t.lo AS lowest_allowed, t.hi AS highest_allowed, count(s.hourly_rate) AS services,
    min(s.hourly_rate) AS lowest_rate, max(s.hourly_rate) AS highest_rate,
    count(*) FILTER (WHERE s.hourly_rate NOT BETWEEN t.lo AND t.hi) AS violations
FROM stated t LEFT JOIN stg_services s ON lower(trim(s.service_category)) = t.service_category
GROUP BY t.service_category, t.lo, t.hi
"""

_DEMAND = """
, kinds AS (SELECT service_id, min(lower(trim(service_category))) AS service_category FROM stg_services GROUP BY service_id
), demand AS (
    SELECT service_category, month(job_requested_at)::INTEGER AS month, count(*) AS jobs
    FROM stg_jobs JOIN kinds USING (service_id)
    WHERE job_requested_at IS NOT NULL AND service_category IS NOT NULL GROUP BY ALL
)
"""

SEASONAL_INDEX = (
    _DEMAND
    + """
, expected AS (
    SELECT *, sum(jobs) OVER (PARTITION BY month)::DOUBLE * sum(jobs) OVER (PARTITION BY service_category)::DOUBLE
        / sum(jobs) OVER ()::DOUBLE AS e FROM demand
)
SELECT service_category, month, jobs::BIGINT AS jobs, round(e, 6) AS expected_jobs, round(jobs::DOUBLE / e, 6) AS seasonal_index FROM expected
"""
)

SEASONS = (
    _DEMAND
    + """
, stated(service_category, first, last, lift) AS (VALUES ('landscaping', 6, 8, 1.4::DOUBLE), ('cleaning', 12, 12, 1.3::DOUBLE)
), cells AS (
    SELECT s.service_category, s.lift AS expected_lift,
        coalesce(sum(d.jobs) FILTER (WHERE d.service_category = s.service_category AND d.month BETWEEN s.first AND s.last), 0) AS a,
        coalesce(sum(d.jobs) FILTER (WHERE d.service_category <> s.service_category AND d.month BETWEEN s.first AND s.last), 0) AS b,
        coalesce(sum(d.jobs) FILTER (WHERE d.service_category = s.service_category AND d.month NOT BETWEEN s.first AND s.last), 0) AS c,
        coalesce(sum(d.jobs) FILTER (WHERE d.service_category <> s.service_category AND d.month NOT BETWEEN s.first AND s.last), 0) AS d
    FROM stated s LEFT JOIN demand d ON true GROUP BY ALL
), odds AS (
    SELECT *, CASE WHEN least(a, b, c, d) > 0 THEN a::DOUBLE * d::DOUBLE / (b::DOUBLE * c::DOUBLE) END AS lift FROM cells
), tested AS (
    SELECT *, round(power(ln(lift) - ln(expected_lift), 2) / (1 / a::DOUBLE + 1 / b::DOUBLE + 1 / c::DOUBLE + 1 / d::DOUBLE), 6) AS statistic
    FROM odds WHERE lift IS NOT NULL
    UNION ALL SELECT *, NULL FROM odds WHERE lift IS NULL
)
SELECT service_category, a::BIGINT AS in_season, b::BIGINT AS others_in_season, c::BIGINT AS off_season, d::BIGINT AS others_off_season,
    expected_lift, round(lift, 6) AS lift, statistic, coalesce(statistic <= 10.828, true) AS passed
FROM tested
"""
)

DISTRIBUTION_SQL = {
    "integrity_shares": SHARES,
    "integrity_rates": RATES,
    "seasonal_index": SEASONAL_INDEX,
    "integrity_seasons": SEASONS,
}
