"""DuckDB SQL that derives the six raw marketplace tables from the TPC-H views.

Same rules as ``bazaar.sources.fixtures`` (FIXTURES.md section 2), written as
CTEs. Integer arithmetic throughout; ``//`` is integer division in DuckDB.
"""

SOURCE_CTES = r"""
fx_supplier_n AS (SELECT count(*) AS n FROM supplier),
fx_part_n AS (SELECT count(*) AS n FROM part),
raw_users AS (
    SELECT user_id,
           TIMESTAMP '2023-01-01 00:00:00' + (k % 730) * INTERVAL '1' DAY AS signup_date,
           (k % 50 <> 7 AND k % 20 <> 3) AS is_active,
           (k % 50 = 7) AS is_suspended,
           CASE nk % 5 WHEN 0 THEN 'NYC' WHEN 1 THEN ' LA ' WHEN 2 THEN 'Chicago'
                       WHEN 3 THEN 'Houston ' ELSE 'Phoenix' END AS city
    FROM (
        SELECT c_custkey AS user_id, c_custkey AS k, c_nationkey AS nk FROM customer
        UNION ALL
        SELECT 1000000000 + s_suppkey, s_suppkey, s_nationkey FROM supplier
    ) u
),
raw_contractor_profiles AS (
    SELECT 1000000000 + s_suppkey AS user_id,
           CASE WHEN s_suppkey % 10 = 0 THEN ' Premium' ELSE 'standard' END AS contractor_tier,
           CASE WHEN s_suppkey % 10 = 0 THEN 15 / 100e0 ELSE 20 / 100e0 END AS commission_rate,
           s_suppkey % 20 <> 1 AS onboarding_completed,
           s_suppkey % 50 <> 2 AS background_check_passed
    FROM supplier
),
fx_service_keys AS (
    SELECT p_partkey AS service_id,
           1000000000 + p_partkey % (sn.n - 2) AS contractor_id,
           (p_partkey % (sn.n - 2)) % 10 = 0 AS is_premium,
           25 + (p_partkey * 37) % 136 AS rate
    FROM part CROSS JOIN fx_supplier_n sn
),
raw_services AS (
    SELECT service_id, contractor_id,
           CASE service_id % 4 WHEN 0 THEN 'Cleaning ' WHEN 1 THEN 'plumbing'
                               WHEN 2 THEN 'ELECTRICAL' ELSE ' landscaping' END AS service_category,
           CAST(rate AS DOUBLE) AS hourly_rate,
           TIMESTAMP '2024-01-01 00:00:00' + (service_id % 365) * INTERVAL '1' DAY AS created_at,
           service_id % 10 <> 0 AS is_available
    FROM fx_service_keys
),
fx_orders AS (
    SELECT o.o_orderkey AS job_id, o.o_custkey AS customer_id,
           o.o_orderdate + ((o.o_orderkey * 37) % 1440) * INTERVAL '1' MINUTE AS requested,
           (o.o_orderkey * 7919 + o.o_custkey) % pn.n AS service_key
    FROM orders o CROSS JOIN fx_part_n pn
),
fx_ledger0 AS (
    SELECT o.job_id, o.customer_id, o.requested, sk.service_id, sk.contractor_id, sk.is_premium, sk.rate,
           o.job_id % 20 AS st,
           100 + o.job_id % 701 AS est_h,
           (100 + o.job_id % 701) * (70 + (o.job_id * 13) % 61) AS p
    FROM fx_orders o LEFT JOIN fx_service_keys sk ON o.service_key = sk.service_id
),
fx_ledger1 AS (
    SELECT *, p - p % 100 AS act_h, ((p - p % 100) // 100) * rate AS g,
           requested + ((job_id * 53) % 4319 + 1) * INTERVAL '1' MINUTE AS completion,
           st NOT IN (3, 7, 11) AS completed,
           7 + job_id % 8 AS payout_days
    FROM fx_ledger0
),
fx_ledger AS (
    SELECT *,
           CASE WHEN job_id % 100 IN (15, 65) THEN g
                WHEN job_id % 100 = 25 THEN -least(500 + job_id % 4501, g)
                ELSE g // 4 END AS first_signed
    FROM fx_ledger1
),
raw_jobs AS (
    SELECT job_id, service_id, contractor_id, customer_id,
           requested AS job_requested_at,
           CASE WHEN completed THEN completion END AS job_completed_at,
           CASE WHEN st IN (3, 11) THEN 'canceled_by_customer'
                WHEN st = 7 THEN ' Canceled_By_Contractor'
                ELSE 'completed' END AS job_status,
           est_h / 100e0 AS estimated_hours,
           CASE WHEN completed THEN act_h / 10000e0 END AS actual_hours,
           CASE WHEN completed THEN g / 100e0 END AS gross_amount
    FROM fx_ledger
),
raw_adjustments AS (
    SELECT 2 * job_id AS adjustment_id, job_id,
           completion + ((job_id * 11) % 30) * INTERVAL '1' DAY AS adjustment_date,
           CASE WHEN job_id % 100 IN (15, 65) THEN 'Full_Refund'
                WHEN job_id % 100 = 25 THEN 'goodwill_bonus '
                ELSE 'partial_refund' END AS adjustment_type,
           abs(first_signed) / 100e0 AS adjustment_amount
    FROM fx_ledger WHERE completed AND job_id % 10 = 5
    UNION ALL
    SELECT 2 * job_id + 1, job_id,
           completion + ((job_id * 17) % 30) * INTERVAL '1' DAY,
           'goodwill_bonus',
           least(500, g) / 100e0
    FROM fx_ledger WHERE completed AND job_id % 50 = 5
),
raw_payouts AS (
    SELECT job_id + 1 AS payout_id, contractor_id, job_id,
           completion + payout_days * INTERVAL '1' DAY AS payout_date,
           CASE WHEN is_premium THEN 15 / 100e0 ELSE 20 / 100e0 END AS commission_rate,
           greatest(0,
               (g * CASE WHEN is_premium THEN 85 ELSE 80 END) // 100
               - (CASE WHEN job_id % 10 = 5 AND (job_id * 11) % 30 <= payout_days THEN first_signed ELSE 0 END
                  - CASE WHEN job_id % 50 = 5 AND (job_id * 17) % 30 <= payout_days THEN least(500, g) ELSE 0 END)
           ) / 100e0 AS payout_amount,
           CASE WHEN job_id % 20 = 1 THEN ' Pending' ELSE 'completed' END AS payout_status
    FROM fx_ledger WHERE completed
)
"""

SPOILED_CTES = (
    SOURCE_CTES.replace("raw_jobs AS (", "clean_jobs AS (").replace("raw_adjustments AS (", "clean_adjustments AS (").rstrip()
    + r""",
raw_jobs AS (
    SELECT * REPLACE (CASE WHEN job_id % 97 = 5 THEN job_requested_at - INTERVAL '1' HOUR ELSE job_completed_at END
                      AS job_completed_at) FROM clean_jobs),
raw_adjustments AS (
    SELECT * REPLACE (CASE WHEN adjustment_id % 14 = 0 THEN -adjustment_amount ELSE adjustment_amount END
                      AS adjustment_amount) FROM clean_adjustments)
"""
)
