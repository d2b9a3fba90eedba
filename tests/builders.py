"""Hand-built raw marketplace tables for edge-case tests."""

from __future__ import annotations

from datetime import datetime

from bazaar.plans.graph import Marketplace
from bazaar.sources.schemas import RAW_SCHEMAS

T0 = datetime(2024, 1, 1, 0, 0)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def raw_tables(spark, **rows) -> dict:
    """Six raw DataFrames; tables not given are empty."""
    return {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in RAW_SCHEMAS.items()}


def marketplace(spark, **rows) -> Marketplace:
    return Marketplace(raw_tables(spark, **rows))


def user(uid, suspended=False, active=True, city="NYC", signup="2023-05-01 00:00:00"):
    return (uid, ts(signup), active, suspended, city)


def contractor(uid, tier="standard", rate=0.20, onboarded=True, checked=True):
    return (uid, tier, rate, onboarded, checked)


def service(sid, cid, category="plumbing", rate=100.0, available=True, created="2024-01-01 00:00:00"):
    return (sid, cid, category, rate, ts(created), available)


def job(jid, sid, cid, cust, requested, completed=None, status="completed", est=2.0, act=2.0, gross=200.0):
    if status != "completed":
        act, gross = None, None
    return (jid, sid, cid, cust, ts(requested), ts(completed) if completed else None, status, est, act, gross)


def adjustment(aid, jid, date, kind, amount):
    return (aid, jid, ts(date), kind, amount)


def payout(pid, cid, jid, date, rate, amount, status="completed"):
    return (pid, cid, jid, ts(date), rate, amount, status)
