"""Payout reconciliation and the skew-safe as-of running totals."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

from builders import adjustment, job, marketplace, payout

from bazaar.operators import reconcile
from bazaar.operators.asof import running_totals


def test_adjustment_on_payout_date_is_deducted(spark):
    m = marketplace(
        spark,
        jobs=[job(1, 1, 9, 1, "2024-04-01 10:00:00", "2024-04-01 12:00:00", gross=200.0)],
        adjustments=[
            adjustment(1, 1, "2024-04-09 00:00:00", "partial_refund", 20.0),  # same instant as payout
            adjustment(2, 1, "2024-04-05 00:00:00", "goodwill_bonus", 5.0),
            adjustment(3, 1, "2024-04-20 00:00:00", "full_refund", 200.0),  # after payout
        ],
        payouts=[payout(1, 9, 1, "2024-04-09 00:00:00", 0.2, 145.0)],
    )
    r = reconcile.reconcile_payouts(m.int_payouts_enriched, m.int_jobs_enriched, m.int_adjustments_enriched)
    row = r.collect()[0]
    assert row["refunds_before_payout_usd"] == Decimal("20.00")
    assert row["bonuses_before_payout_usd"] == Decimal("5.00")
    assert row["adjustments_before_payout"] == 2
    assert row["expected_payout_usd"] == Decimal("145.00") and row["is_reconciled"] is True
    late = reconcile.adjustments_after_payout(m.int_adjustments_enriched, m.int_payouts_enriched).collect()
    assert [a["adjustment_id"] for a in late] == [3] and late[0]["signed_amount_usd"] == Decimal("-200.00")


def test_running_totals_match_brute_force_with_a_hot_key(spark):
    rnd = random.Random(7)
    base = datetime(2024, 1, 1)
    events, probes = [], []
    for i in range(3000):
        key = 1 if rnd.random() < 0.6 else rnd.randint(2, 40)  # key 1 holds most rows
        t = base + timedelta(microseconds=rnd.choice([1, 1_000_000, 3_600_000_000]) * rnd.randint(0, 500))
        events.append((key, t, i, rnd.randint(-50, 100)))
    for i in range(800):
        key = 1 if rnd.random() < 0.5 else rnd.randint(2, 45)
        t = base + timedelta(microseconds=rnd.choice([1, 1_000_000, 3_600_000_000]) * rnd.randint(0, 500))
        probes.append((key, t, 100000 + i))
    probes += probes[:5]  # repeated probes
    events += [(None, base, 1, 5), (1, None, 2, 5), (1, base, 3, None)]
    probes += [(None, base, 5), (1, None, 6), (999, base, 7)]
    ev = spark.createDataFrame(events, "k long, t timestamp_ntz, eid long, v long")
    pr = spark.createDataFrame(probes, "k long, pt timestamp_ntz, pid long")
    got = sorted((r["pid"], r["v"]) for r in running_totals(pr, ev, "k", "pt", "t", ["v"]).collect())
    known = [(k2, t2, v) for k2, t2, _, v in events if None not in (k2, t2, v)]
    total = lambda k, t: 0 if None in (k, t) else sum(v for k2, t2, v in known if k2 == k and t2 <= t)
    assert got == sorted((pid, total(k, t)) for k, t, pid in probes)


def test_payouts_without_key_or_time_are_kept(spark):
    m = marketplace(
        spark,
        jobs=[job(1, 1, 9, 1, "2024-04-01 10:00:00", "2024-04-01 12:00:00", gross=200.0)],
        adjustments=[adjustment(1, 1, "2024-04-05 00:00:00", "partial_refund", 20.0)],
        payouts=[
            payout(1, 9, 1, "2024-04-09 00:00:00", 0.2, 140.0),
            (2, 9, None, None, 0.2, 10.0, "completed"),
            (3, 9, 1, None, 0.2, 160.0, "completed"),
        ],
    )
    r = reconcile.reconcile_payouts(m.int_payouts_enriched, m.int_jobs_enriched, m.int_adjustments_enriched)
    rows = {x["payout_id"]: x for x in r.collect()}
    assert rows[1]["refunds_before_payout_usd"] == Decimal("20.00") and rows[1]["is_reconciled"] is True
    assert rows[2]["expected_payout_usd"] == Decimal("0.00") and rows[2]["adjustments_before_payout"] == 0
    assert rows[3]["adjustments_before_payout"] == 0 and rows[3]["expected_payout_usd"] == Decimal("160.00")
