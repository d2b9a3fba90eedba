"""Registered queries: name -> callable(spark, source_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaar.operators import distributions, integrity, kpis, primitives, quality, reconcile, rollups
from bazaar.plans.graph import Marketplace
from bazaar.plans.upkeep import MarketView, upkept
from bazaar.session import checkpoint_dir
from bazaar.sources.fixtures import spoiled

Query = Callable[[SparkSession, str], DataFrame]

# Models and model parts exposed one-to-one as queries.
MODEL_QUERIES = (
    "stg_users",
    "stg_contractor_profiles",
    "stg_services",
    "stg_jobs",
    "stg_adjustments",
    "stg_payouts",
    "int_users_enriched",
    "int_contractor_profiles_enriched",
    "int_services_enriched",
    "int_jobs_enriched",
    "int_adjustments_enriched",
    "int_payouts_enriched",
    "dim_users",
    "dim_services",
    "dim_contractors",
    "payouts_by_job",
    "adjustments_by_job",
    "fct_jobs",
    "fct_payouts",
    "fct_adjustments",
    "contractor_job_stats",
    "contractor_service_stats",
    "contractor_performance_summary",
    "reference_date",
    "customer_job_stats",
    "customer_health_summary",
    "customers_never_ordered",
    "service_category_demand",
    "service_category_supply",
    "listing_tier_mix",
    "service_category_performance",
)


def marketplace(spark: SparkSession, source_dir: str) -> Marketplace:
    """The model graph over ``source_dir``, built anew so that it lists the files there now."""
    return Marketplace.load(spark, source_dir)


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, source_dir: str) -> DataFrame:
        return marketplace(spark, source_dir).model(name)

    run.__name__ = name
    return run


def _job_query(fn: Callable[[Marketplace], DataFrame], name: str) -> Query:
    def run(spark: SparkSession, source_dir: str) -> DataFrame:
        return fn(marketplace(spark, source_dir))

    run.__name__ = name
    return run


def _declared(kind: str) -> Callable[[Marketplace], DataFrame]:
    return lambda m: quality.declared_test_results(m, (kind,))


def _singular(test: str, dirty: bool = False) -> Callable[[Marketplace], DataFrame]:
    return lambda m: quality.singular_test_rows((Marketplace(spoiled(m.raw)) if dirty else m).model, test)


def _upkept(m: Marketplace) -> MarketView:
    """The models of a store in the checkpoint folder into which the tables came in two batches.

    The batches are applied when the query is called; the result reads the store's files,
    which stay until the folder is cleared.
    """
    return upkept(m, f"{checkpoint_dir(m.stg_jobs.sparkSession).rstrip('/')}/stores/{uuid.uuid4().hex}")


JOB_QUERIES: dict[str, Callable[[Marketplace], DataFrame]] = {
    # data-quality tests (H1-H8)
    "dq_unique": _declared("unique"),
    "dq_not_null": _declared("not_null"),
    "dq_accepted_values": _declared("accepted_values"),
    "dq_relationships": _declared("relationships"),
    "dq_status_exclusive": _singular("assert_jobs_status_mutually_exclusive"),
    "dq_completion_order": _singular("assert_completed_at_after_requested_at"),
    "dq_adjustment_positive": _singular("assert_adjustment_amounts_positive"),
    "dq_refund_non_negative": _singular("assert_refund_amounts_non_negative"),
    # the same tests over the same tables with a few spoiled rows, so that they have rows to report
    "dq_completion_order_spoiled": _singular("assert_completed_at_after_requested_at", dirty=True),
    "dq_adjustment_positive_spoiled": _singular("assert_adjustment_amounts_positive", dirty=True),
    "dq_refund_non_negative_spoiled": _singular("assert_refund_amounts_non_negative", dirty=True),
    "dq_summary": quality.test_summary,
    # source validation and profiling
    "integrity_sources": lambda m: integrity.source_integrity(m.staged_sources),
    "integrity_rules": lambda m: integrity.specification_rules(m.staged_sources),
    "profile_table": lambda m: integrity.profile_tables(m.staged_sources),
    # distribution rules of the specification (I2): shares, ranges and seasons
    "integrity_shares": lambda m: distributions.specification_shares(m.staged_sources),
    "integrity_rates": lambda m: distributions.rate_ranges(m.stg_services),
    "seasonal_index": lambda m: distributions.seasonal_index(m.stg_jobs, m.stg_services),
    "integrity_seasons": lambda m: distributions.specification_seasons(m.stg_jobs, m.stg_services),
    # reconciliation
    "reconcile_payouts": lambda m: reconcile.reconcile_payouts(
        m.int_payouts_enriched, m.int_jobs_enriched, m.int_adjustments_enriched
    ),
    "reconcile_summary": lambda m: reconcile.reconciliation_summary(
        reconcile.reconcile_payouts(m.int_payouts_enriched, m.int_jobs_enriched, m.int_adjustments_enriched)
    ),
    "adjustments_after_payout": lambda m: reconcile.adjustments_after_payout(
        m.int_adjustments_enriched, m.int_payouts_enriched
    ),
    # KPIs (I6-I10)
    "kpi_marketplace": lambda m: kpis.marketplace_kpis(m.fct_jobs),
    # the four grains of the fact in one pass, and upkeep by batches
    "job_rollups": lambda m: rollups.job_rollups(rollups.job_states(m.fct_jobs)),
    "upkept_fct_jobs": lambda m: _upkept(m).fct_jobs,
    "upkept_job_rollups": lambda m: rollups.job_rollups(_upkept(m).states),
    # isolated primitives
    "agg_functions": lambda m: primitives.agg_functions(m.fct_jobs),
    "scalar_functions": lambda m: primitives.scalar_functions(m.stg_jobs, m.stg_services),
}


def run_on(graph: Marketplace, name: str) -> DataFrame:
    """A registered query over a given graph, for sources that are not a plain folder."""
    return JOB_QUERIES[name](graph) if name in JOB_QUERIES else graph.model(name)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _model_query(name) for name in MODEL_QUERIES}
    out.update({name: _job_query(fn, name) for name, fn in JOB_QUERIES.items()})
    return out
