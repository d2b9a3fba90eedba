"""Incremental upkeep of the job fact, the scorecards and the KPIs.

``MarketStore`` keeps the raw tables, ``fct_jobs`` and its roll-up states cut into a
fixed number of buckets of jobs. A batch of new or changed rows rewrites the buckets it
touches and no other: their fact is computed anew from their raw rows, and so are their
states (``rollups.job_states``). As the states of a bucket are replaced whole, what a
changed or moved row counted for before is retracted without any inverse of a sum, a
minimum or a maximum. Scorecards and KPIs are made from the merged states.

- Rows are upserts: all stored rows with the primary key of a batch row give way to
  the batch's rows. Rows without a primary key are added. Batches of different keys
  can come in any order; a payout or adjustment may come before its job.
- A row that moves to another job touches the bucket it leaves too. A changed service,
  contractor or user touches the buckets of the jobs that refer to it.
- Only what a batch changes is made anew in the buckets it touches: tables it has no rows of
  stay, and if it has payouts or adjustments alone the fact keeps its other columns. The rows
  of a table that nothing is stored of are put down once, as its buckets.
- A batch is one commit: its data are put down first, then a manifest that names the
  folder of every bucket is created (``sources.snapshots.commit_manifest``). Readers see
  one version; a batch that dies changes nothing they see and can be applied again; of
  two batches applied to one version the second gets ``SnapshotConflict``.

The driver holds the manifest, one entry for each bucket and part. Buckets of raw rows are
written through a rebalancing shuffle, so that a bucket with a very large job is split over
tasks and files. The fact has one row for a job: jobs and the roll-ups of their payouts and
adjustments move to their bucket once, meet there, and the fact and its states are written
from where they are.
"""

from __future__ import annotations

import uuid
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bazaar.operators import marts, rollups
from bazaar.operators import scorecards as sc
from bazaar.plans.graph import Marketplace
from bazaar.sources import manifest, staged, versions
from bazaar.sources.schemas import RAW_SCHEMAS
from bazaar.sources.snapshots import commit_manifest, hadoop_path

#: Cut by job, with their primary keys.
JOB_TABLES = {"jobs": "job_id", "payouts": "payout_id", "adjustments": "adjustment_id"}
#: Kept whole, with their primary keys and the column of the fact that refers to them.
DIMENSIONS = {
    "users": ("user_id", "customer_id"),
    "contractor_profiles": ("user_id", "contractor_id"),
    "services": ("service_id", "service_id"),
}
FACT, STATES = "fct_jobs", "job_states"
BUCKET = "bucket"
#: The tables that a job has several rows of: the model of their roll-up, and its columns in the fact.
CHILDREN = {
    "payouts": ("payouts_by_job", marts.PAYOUT_AGG_COLUMNS),
    "adjustments": ("adjustments_by_job", marts.ADJUSTMENT_AGG_COLUMNS),
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class MarketView(Marketplace):
    """All models of one version of a store. The fact and the scorecards read what is stored."""

    def __init__(self, raw: dict[str, DataFrame], facts: DataFrame, states: DataFrame):
        states = rollups.merged(states)
        super().__init__(
            raw,
            {
                "fct_jobs": facts,
                "contractor_job_stats": rollups.contractor_job_stats(states),
                "customer_job_stats": rollups.customer_job_stats(states),
                "service_category_demand": rollups.service_category_demand(states),
            },
        )
        self.states = states

    @cached_property
    def customer_health_summary(self) -> DataFrame:
        return sc.customer_health_summary(self.dim_users, self.customer_job_stats, rollups.last_request(self.states))

    @cached_property
    def reference_date(self) -> DataFrame:
        return sc.reference_date(rollups.last_request(self.states))

    @cached_property
    def kpis(self) -> DataFrame:
        return rollups.marketplace_kpis(self.states)


class MarketStore:
    """A folder with the upkept tables. The number of buckets is set by the first batch."""

    def __init__(self, spark: SparkSession, directory: str, buckets: int | None = None):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def version(self) -> int:
        """The newest version, 0 before the first batch."""
        known = versions(self.spark, self.directory)
        return known[-1] if known else 0

    def _manifest(self, version: int) -> dict:
        if not version:
            return {"buckets": self.buckets, "tables": {}, "parts": {}}
        return manifest(self.spark, self.directory, version)[1]

    def _read(self, folders: list[str], schema) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.directory}/{f}" for f in folders])

    def _raw(self, state: dict, buckets: set[str] | None = None) -> dict[str, DataFrame]:
        """The raw tables of a version, the job-grain ones of some buckets only."""
        out = {t: self._read([state["tables"][t]] if t in state["tables"] else [], RAW_SCHEMAS[t]) for t in DIMENSIONS}
        for t in JOB_TABLES:
            found = state["parts"].get(t, {})
            out[t] = self._read([f for b, f in found.items() if buckets is None or b in buckets], RAW_SCHEMAS[t])
        return out

    def _schemas(self, raw: dict[str, DataFrame]):
        facts = Marketplace({t: self.spark.createDataFrame([], RAW_SCHEMAS[t]) for t in raw}).fct_jobs
        return facts.schema, rollups.job_states(facts).schema

    def read(self, version: int | None = None) -> MarketView:
        """The models of a version (the newest by default); later batches do not change what it reads."""
        version = self.version() if version is None else version
        state = self._manifest(version)
        raw = self._raw(state)
        fact_schema, states_schema = self._schemas(raw)
        part = lambda name, schema: self._read(list(state["parts"].get(name, {}).values()), schema)
        return MarketView(raw, part(FACT, fact_schema), part(STATES, states_schema))

    def _bucket(self, state: dict) -> Column:
        return F.pmod(F.xxhash64("job_id"), F.lit(state["buckets"])).cast("int").alias(BUCKET)

    def _write(self, df: DataFrame, folder: str) -> dict[str, str]:
        """Write rows with a bucket column; bucket -> folder of those that have rows."""
        return self._written(df.hint("rebalance", BUCKET), folder)

    def _written(self, df: DataFrame, folder: str) -> dict[str, str]:
        """``_write`` of rows that are together with those of their bucket."""
        df.write.partitionBy(BUCKET).parquet(f"{self.directory}/{folder}")
        target, fs = hadoop_path(self.spark, f"{self.directory}/{folder}")
        names = (s.getPath().getName() for s in fs.listStatus(target))
        return {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET}=")}

    def _fact(self, fresh: Marketplace, old: DataFrame | None, bucket: Column) -> DataFrame:
        """The fact with its bucket column, partitioned by it.

        Of the stored fact ``old``, if given, all columns but the roll-ups of ``fresh``'s children stay.
        """
        children = [t for t in CHILDREN if t in fresh.raw]
        if old is None:
            jobs = marts.with_context(
                fresh.int_jobs_enriched,
                fresh.int_services_enriched,
                fresh.int_contractor_profiles_enriched,
                fresh.int_users_enriched,
            ).select(*marts.JOB_COLUMNS, *marts.CONTEXT_COLUMNS)
        else:
            jobs = old.drop("net_revenue_usd", *[c for t in children for c in CHILDREN[t][1]])
        rows = jobs.select("*", bucket, F.lit(True).alias("_job"))
        for name in children:
            by_job = fresh.model(CHILDREN[name][0]).where("job_id IS NOT NULL")
            rows = rows.unionByName(by_job.select("*", bucket, F.lit(False).alias("_job")), allowMissingColumns=True)
        # a job has one row of each roll-up at most: the greatest value is the only one
        job = Window.partitionBy(BUCKET, "job_id")
        rolled = {c: F.max(c).over(job) for t in children for c in CHILDREN[t][1]}
        joined = rows.repartition(BUCKET).withColumns(rolled).where("_job")
        return marts.with_financials(joined, *marts.CONTEXT_COLUMNS, BUCKET)

    def apply(self, batch: dict[str, DataFrame], base: int | None = None) -> set[int]:
        """Apply rows of any of the raw tables as the next version; returns the buckets that were rewritten."""
        if unknown := set(batch) - set(JOB_TABLES) - set(DIMENSIONS):
            raise ValueError(f"not source tables: {', '.join(sorted(unknown))}")
        base = self.version() if base is None else base
        state = self._manifest(base)
        write = f"data/{uuid.uuid4().hex}"
        stored = self._raw(state)
        bucket = self._bucket(state)
        # the batch is written once: what it holds is then the same for every step
        rows, new = {}, {}
        for name, df in batch.items():
            folder = f"{write}/batch/{name}"
            if name in JOB_TABLES and not state["parts"].get(name):
                # nothing to merge with: these are the table's buckets
                new[name] = self._write(staged(df, name).select("*", bucket), f"{write}/{name}")
                rows[name] = self._read(list(new[name].values()), RAW_SCHEMAS[name])
                continue
            if name in DIMENSIONS and name not in state["tables"]:
                folder = f"{write}/{name}"
            staged(df, name).write.parquet(f"{self.directory}/{folder}")
            rows[name] = self._read([folder], RAW_SCHEMAS[name])

        numbers = {b for found in new.values() for b in found}
        touched = []
        for name, key in JOB_TABLES.items():
            if name in rows and name not in new:
                touched.append(rows[name].select(bucket))
                touched.append(stored[name].join(rows[name].select(key), key, "left_semi").select(bucket))
        if state["parts"].get(FACT):
            facts = self._read(list(state["parts"][FACT].values()), self._schemas(stored)[0])
            for name, (key, reference) in DIMENSIONS.items():
                if name in rows:
                    changed = rows[name].select(F.col(key).alias(reference))
                    touched.append(facts.join(changed, reference, "left_semi").select(bucket))
        if touched:  # at most one row for each bucket
            numbers |= {str(r[0]) for r in _union(touched).distinct().collect()}

        tables = dict(state["tables"])
        for name, (key, _) in DIMENSIONS.items():
            if name in rows:
                tables[name] = f"{write}/{name}"
                if name in state["tables"]:
                    kept = stored[name].join(rows[name].select(key).distinct(), key, "left_anti")
                    _union([kept, rows[name]]).write.parquet(f"{self.directory}/{tables[name]}")
        # what the batch does not change stays
        parts = {p: dict(found) for p, found in state["parts"].items()}
        if numbers:
            old = self._raw(state, numbers)
            for name, key in JOB_TABLES.items():
                if name not in rows:
                    continue
                if name not in new:
                    kept = old[name].join(rows[name].select(key).distinct(), key, "left_anti")
                    new[name] = self._write(_union([kept, rows[name]]).select("*", bucket), f"{write}/{name}")
                parts[name] = {b: f for b, f in parts.get(name, {}).items() if b not in numbers} | new[name]
            raw = self._raw({"tables": tables, "parts": parts}, numbers)
            fact = None
            if set(rows) <= set(CHILDREN):
                raw = {name: raw[name] for name in rows}
                found = [f for b, f in parts.get(FACT, {}).items() if b in numbers]
                fact = self._read(found, self._schemas(stored)[0])
            made = self._fact(Marketplace(raw), fact, bucket).persist()
            try:
                now = {
                    FACT: self._written(made, f"{write}/{FACT}"),
                    STATES: self._written(rollups.job_states(made, BUCKET), f"{write}/{STATES}"),
                }
            finally:
                made.unpersist()
            for name, found in now.items():
                parts[name] = {b: f for b, f in parts.get(name, {}).items() if b not in numbers} | found
        commit_manifest(
            self.spark, self.directory, base + 1, {"buckets": state["buckets"], "tables": tables, "parts": parts}
        )
        target, fs = hadoop_path(self.spark, f"{self.directory}/{write}/batch")
        fs.delete(target, True)
        return {int(b) for b in numbers}

    def expire(self, keep: int = 1) -> list[int]:
        """Remove all but the newest ``keep`` versions, and the folders that only they name."""
        if keep < 1:
            raise ValueError("at least one version stays")
        known = versions(self.spark, self.directory)
        old, new = known[:-keep], known[-keep:]

        def folders(version: int) -> set[str]:
            state = self._manifest(version)
            return set(state["tables"].values()).union(*(found.values() for found in state["parts"].values()))

        used = set().union(*(folders(v) for v in new)) if new else set()
        gone = set().union(*(folders(v) for v in old)) - used if old else set()
        # manifests go first, so no reader finds a version whose data is going
        for path in [f"manifests/{v:020d}.json" for v in old] + sorted(gone):
            target, fs = hadoop_path(self.spark, f"{self.directory}/{path}")
            fs.delete(target, True)
        return old


def late_batches(m: Marketplace) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The raw tables as they arrive: all but the adjustments after the last payout of their job, then those."""
    paid = m.stg_payouts.groupBy("job_id").agg(F.max("payout_date").alias("last_paid"))
    dated = m.stg_adjustments.join(paid, "job_id", "left")
    is_late = F.coalesce(F.col("adjustment_date") > F.col("last_paid"), F.lit(False))
    columns = m.stg_adjustments.columns
    first = {**m.staged_sources, "adjustments": dated.where(~is_late).select(*columns)}
    return first, {"adjustments": dated.where(is_late).select(*columns)}


def upkept(m: Marketplace, directory: str, buckets: int | None = None) -> MarketView:
    """The models after the raw tables have come in as ``late_batches``."""
    store = MarketStore(m.stg_jobs.sparkSession, directory, buckets)
    for batch in late_batches(m):
        store.apply(batch)
    return store.read()
