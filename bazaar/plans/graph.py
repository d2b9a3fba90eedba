"""The model graph: sources -> staging -> intermediate -> marts -> scorecards.

``Marketplace`` exposes every model as a lazily built DataFrame. Models are
plain function compositions; building one builds only the plans it depends
on, and nothing executes until an action. Attributes are cached, so two
consumers of, say, ``int_jobs_enriched`` share one logical plan object and
Spark can reuse identical exchanges within one query.

When one run writes several marts, ``build`` writes each model once, in
dependency order, and ``test_run`` does the same in a run folder that is
deleted afterwards. Later consumers start from Parquet instead of recomputing
the lineage, and a lost executor costs only the files it had not yet written.
Neither changes the graph they were called on.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession

from bazaar.operators import intermediate as im
from bazaar.operators import marts as mt
from bazaar.operators import rollups
from bazaar.operators import scorecards as sc
from bazaar.operators.quality import as_results, observed_counts, observed_failures
from bazaar.session import RunFolder
from bazaar.sources import load_sources, staged

STAGING = (
    "stg_users",
    "stg_contractor_profiles",
    "stg_services",
    "stg_jobs",
    "stg_adjustments",
    "stg_payouts",
)
INTERMEDIATE = (
    "int_users_enriched",
    "int_contractor_profiles_enriched",
    "int_services_enriched",
    "int_jobs_enriched",
    "int_adjustments_enriched",
    "int_payouts_enriched",
)
MARTS = (
    "dim_users",
    "dim_services",
    "dim_contractors",
    "fct_jobs",
    "fct_payouts",
    "fct_adjustments",
    "contractor_performance_summary",
    "customer_health_summary",
    "service_category_performance",
)
SCORECARDS = MARTS[-3:]
MODELS = STAGING + INTERMEDIATE + MARTS
# Build order: a model after the models it reads.
BUILD_ORDER = INTERMEDIATE + MARTS
# Models that a test run reads more than once (as a tested model, a parent, or for a
# scorecard): it writes each once. All others are computed once anyway, on the way.
TESTED_AS_FILES = ("dim_contractors", "fct_jobs")
# What other tested models read of them.
READS = {
    "contractor_performance_summary": ("dim_contractors", "fct_jobs"),
    "customer_health_summary": ("fct_jobs",),
    "service_category_performance": ("fct_jobs",),
}


class Marketplace:
    """All models over one set of raw tables."""

    def __init__(self, raw: dict[str, DataFrame], given: dict[str, DataFrame] | None = None):
        """``given`` models stand for those that would be built from ``raw``."""
        self.raw = raw
        self.given = dict(given or {})
        self.__dict__.update(self.given)

    @classmethod
    def load(cls, spark: SparkSession, directory: str) -> "Marketplace":
        return cls(load_sources(spark, directory))

    def model(self, name: str) -> DataFrame:
        if name not in MODELS and not hasattr(type(self), name):
            raise KeyError(f"unknown model {name!r}")
        return getattr(self, name)

    # --- staging (A1-A6) --------------------------------------------------
    @cached_property
    def stg_users(self) -> DataFrame:
        return staged(self.raw["users"], "users")

    @cached_property
    def stg_contractor_profiles(self) -> DataFrame:
        return staged(self.raw["contractor_profiles"], "contractor_profiles")

    @cached_property
    def stg_services(self) -> DataFrame:
        return staged(self.raw["services"], "services")

    @cached_property
    def stg_jobs(self) -> DataFrame:
        return staged(self.raw["jobs"], "jobs")

    @cached_property
    def stg_adjustments(self) -> DataFrame:
        return staged(self.raw["adjustments"], "adjustments")

    @cached_property
    def stg_payouts(self) -> DataFrame:
        return staged(self.raw["payouts"], "payouts")

    # --- intermediate (C1-C6) ---------------------------------------------
    @cached_property
    def int_users_enriched(self) -> DataFrame:
        return im.users_enriched(self.stg_users)

    @cached_property
    def int_contractor_profiles_enriched(self) -> DataFrame:
        return im.contractor_profiles_enriched(self.stg_contractor_profiles)

    @cached_property
    def int_services_enriched(self) -> DataFrame:
        return im.services_enriched(self.stg_services)

    @cached_property
    def int_jobs_enriched(self) -> DataFrame:
        return im.jobs_enriched(self.stg_jobs)

    @cached_property
    def int_adjustments_enriched(self) -> DataFrame:
        return im.adjustments_enriched(self.stg_adjustments)

    @cached_property
    def int_payouts_enriched(self) -> DataFrame:
        return im.payouts_enriched(self.stg_payouts)

    # --- dimensions (D1-D3) -----------------------------------------------
    @cached_property
    def dim_users(self) -> DataFrame:
        return mt.dim_users(self.int_users_enriched)

    @cached_property
    def dim_services(self) -> DataFrame:
        return mt.dim_services(self.int_services_enriched)

    @cached_property
    def dim_contractors(self) -> DataFrame:
        return mt.dim_contractors(self.int_contractor_profiles_enriched, self.int_users_enriched)

    # --- job-grain pre-aggregates and facts (E8, D4-D6) --------------------
    @cached_property
    def payouts_by_job(self) -> DataFrame:
        return mt.payouts_by_job(self.int_payouts_enriched)

    @cached_property
    def adjustments_by_job(self) -> DataFrame:
        return mt.adjustments_by_job(self.int_adjustments_enriched)

    @cached_property
    def job_financials(self) -> DataFrame:
        return mt.job_financials(self.int_jobs_enriched, self.payouts_by_job, self.adjustments_by_job)

    @cached_property
    def fct_jobs(self) -> DataFrame:
        return mt.fct_jobs(
            self.job_financials,
            self.int_services_enriched,
            self.int_contractor_profiles_enriched,
            self.int_users_enriched,
        )

    @cached_property
    def fct_payouts(self) -> DataFrame:
        return mt.fct_payouts(
            self.int_payouts_enriched, self.int_jobs_enriched, self.int_contractor_profiles_enriched
        )

    @cached_property
    def fct_adjustments(self) -> DataFrame:
        return mt.fct_adjustments(
            self.int_adjustments_enriched,
            self.int_jobs_enriched,
            self.int_services_enriched,
            self.int_contractor_profiles_enriched,
        )

    # --- scorecards (D7-D9) and their parts (E3, E7, E9, E10) ---------------
    @cached_property
    def contractor_job_stats(self) -> DataFrame:
        return sc.contractor_job_stats(self.fct_jobs)

    @cached_property
    def contractor_service_stats(self) -> DataFrame:
        return sc.contractor_service_stats(self.dim_services)

    @cached_property
    def contractor_performance_summary(self) -> DataFrame:
        return sc.contractor_performance_summary(
            self.dim_contractors, self.contractor_job_stats, self.contractor_service_stats
        )

    @cached_property
    def customer_job_stats(self) -> DataFrame:
        return sc.customer_job_stats(self.fct_jobs)

    @cached_property
    def reference_date(self) -> DataFrame:
        return sc.reference_date(self.int_jobs_enriched)

    @cached_property
    def customer_health_summary(self) -> DataFrame:
        return sc.customer_health_summary(self.dim_users, self.customer_job_stats, self.int_jobs_enriched)

    @cached_property
    def customers_never_ordered(self) -> DataFrame:
        return sc.customers_never_ordered(self.dim_users, self.int_jobs_enriched)

    @cached_property
    def service_category_demand(self) -> DataFrame:
        return sc.service_category_demand(self.fct_jobs)

    @cached_property
    def service_category_supply(self) -> DataFrame:
        return sc.service_category_supply(self.dim_services)

    @cached_property
    def listing_tier_mix(self) -> DataFrame:
        return sc.listing_tier_mix(self.dim_services)

    @cached_property
    def service_category_performance(self) -> DataFrame:
        return sc.service_category_performance(self.service_category_demand, self.service_category_supply)

    @cached_property
    def staged_sources(self) -> dict[str, DataFrame]:
        """The six staging models keyed by raw table name."""
        return {
            "users": self.stg_users,
            "contractor_profiles": self.stg_contractor_profiles,
            "services": self.stg_services,
            "jobs": self.stg_jobs,
            "adjustments": self.stg_adjustments,
            "payouts": self.stg_payouts,
        }

    # --- views and materialisation (A7) --------------------------------------
    def register_views(self, names: tuple[str, ...] = MODELS, prefix: str = "") -> None:
        """One temporary view per model, named as the model (lazy, like the originals).

        With a ``prefix`` the views of a test run do not replace the caller's own.
        """
        for name in names:
            self.model(name).createOrReplaceTempView(prefix + name)

    def replaced(self, models: dict[str, DataFrame]) -> "Marketplace":
        """A new graph over the same raw tables in which ``models`` are given."""
        return Marketplace(self.raw, {**self.given, **models})

    @staticmethod
    def files_for(names: tuple[str, ...]) -> tuple[str, ...]:
        """Of the models that a test run writes, those that ``names`` need, in dependency order."""
        wanted = set(names).union(*(READS.get(n, ()) for n in names))
        return tuple(n for n in TESTED_AS_FILES if n in wanted)

    def as_files(self, run: RunFolder, names: tuple[str, ...] = TESTED_AS_FILES) -> "Marketplace":
        """A new graph in which the named models are tables of ``run``, each computed once.

        Names are in dependency order; a later model is built on the files of the
        earlier ones.
        """
        graph = self.replaced({})
        for name in names:
            graph.__dict__[name] = run.table(graph.model(name), name)
        return graph

    def build(self, target_dir: str, names: tuple[str, ...] = BUILD_ORDER) -> dict[str, str]:
        """Write every named model as Parquet under ``target_dir``, in dependency order.

        Each model is computed once: after it is written, later models read
        the written table instead of recomputing its lineage (table
        materialisation of the whole graph). The scorecards share one pass over the
        fact, if it is built with them. Returns model -> path.
        """
        # a model after those it reads, whatever the order of the names
        names = sorted(dict.fromkeys(names), key=lambda n: MODELS.index(n) if n in MODELS else -1)
        graph, paths = self.replaced({}), {}
        for name in names:
            paths.update(graph.build_one(target_dir, name))
            if name == "fct_jobs" and set(names) & set(SCORECARDS):
                graph.roll_up(target_dir)
        return paths

    def build_tested(self, target_dir: str) -> tuple[dict[str, str], DataFrame]:
        """``build`` with the not_null, accepted_values and singular tests of every model, gathered as it is written.

        The counts are metrics of the jobs that write the models (of the staging models: of
        the jobs that read them first), so no model is read again, but for a column that
        holds several bad values. The metrics stand in the stage that writes, whose tasks count
        once, whatever is computed again. Returns the paths and one row per test.
        """
        graph, paths, counts = self.replaced({}), {}, []
        watched: list[tuple[str, list, Observation]] = []

        def watch(name: str) -> None:
            metrics = observed_counts(name)
            if metrics:
                seen = Observation(f"tests of {name}")
                graph.__dict__[name] = graph.model(name).observe(seen, *[m for each in metrics.values() for m in each])
                watched.append((name, list(metrics), seen))

        for name in STAGING:
            watch(name)
        for name in BUILD_ORDER:
            watch(name)
            paths.update(graph.build_one(target_dir, name))
            if name == "fct_jobs":
                graph.roll_up(target_dir)
        for name, tests, seen in watched:
            counts += observed_failures(self.model(name) if name in STAGING else graph.model(name), tests, seen.get)
        return paths, as_results(self.stg_jobs.sparkSession, counts)

    def build_one(self, target_dir: str, name: str) -> dict[str, str]:
        """Write one model; from now on the graph reads it from its files."""
        path = os.path.join(target_dir, "models", name)
        df = self.model(name)
        df.write.mode("overwrite").parquet(path)
        self.__dict__[name] = df.sparkSession.read.schema(df.schema).parquet(path)
        return {name: path}

    def roll_up(self, target_dir: str) -> None:
        """Write the states of the fact's four grains; from now on the scorecards are made of them."""
        path = os.path.join(target_dir, "rollups", "job_states")
        df = rollups.job_states(self.fct_jobs)
        df.write.mode("overwrite").parquet(path)
        states = df.sparkSession.read.schema(df.schema).parquet(path)
        self.__dict__["contractor_job_stats"] = rollups.contractor_job_stats(states)
        self.__dict__["customer_job_stats"] = rollups.customer_job_stats(states)
        self.__dict__["service_category_demand"] = rollups.service_category_demand(states)

    @classmethod
    def built(cls, spark: SparkSession, directory: str, target_dir: str, names: tuple[str, ...] = BUILD_ORDER):
        """The graph over ``directory`` that reads the models written by ``build``."""
        graph = cls.load(spark, directory)
        return graph.replaced({n: spark.read.parquet(os.path.join(target_dir, "models", n)) for n in names})
