"""Known answers on the fixture data, views, and the Parquet round trip."""

from __future__ import annotations

import os
import tempfile
from decimal import Decimal

from conftest import SF_SMALL

from bazaar.plans.graph import MODELS, Marketplace
from bazaar.sources import load_sources, write_sources


def test_fixture_sources_known_counts(spark):
    m = Marketplace.load(spark, SF_SMALL)
    counts = {name: df.count() for name, df in m.staged_sources.items()}
    assert counts == {
        "users": 160,
        "contractor_profiles": 10,
        "services": 200,
        "jobs": 1500,
        "adjustments": 180,
        "payouts": 1275,
    }


def test_kpis_and_segments_known_answers(spark):
    m = Marketplace.load(spark, SF_SMALL)
    from bazaar.operators.kpis import marketplace_kpis

    k = marketplace_kpis(m.fct_jobs).collect()[0]
    assert k["gross_booking_value_usd"] == Decimal("518965.60")
    assert (k["total_jobs"], k["completed_jobs"], k["canceled_jobs"]) == (1500, 1275, 225)
    assert k["cancellation_rate_pct"] == 15.0
    seg = {r["health_segment"]: r["count"] for r in m.customer_health_summary.groupBy("health_segment").count().collect()}
    assert seg == {"at_risk": 97, "healthy": 4, "high_value": 44, "low_engagement": 2, "never_ordered": 9, "suspended": 4}
    cats = {r["service_category"]: r["total_jobs"] for r in m.service_category_performance.collect()}
    assert cats == {"cleaning": 364, "electrical": 356, "landscaping": 390, "plumbing": 390}


def test_views_are_registered(spark):
    m = Marketplace.load(spark, SF_SMALL)
    m.register_views()
    assert spark.sql("SELECT count(*) AS n FROM fct_jobs").collect()[0]["n"] == 1500
    assert set(MODELS) <= {t.name for t in spark.catalog.listTables()}


def test_parquet_round_trip(spark):
    out = tempfile.mkdtemp(prefix="bazaar-sources-")
    write_sources(load_sources(spark, SF_SMALL), out)
    assert os.path.isdir(os.path.join(out, "jobs.parquet"))
    again = Marketplace.load(spark, out)
    derived = Marketplace.load(spark, SF_SMALL)
    assert again.fct_jobs.count() == 1500
    assert again.fct_jobs.exceptAll(derived.fct_jobs).count() == 0


def test_build_writes_every_model_once(spark):
    target = tempfile.mkdtemp(prefix="bazaar-build-")
    m = Marketplace.load(spark, SF_SMALL)
    before = m.fct_jobs
    paths = m.build(target)
    assert len(paths) == 15 and m.fct_jobs is before  # the graph itself is unchanged
    assert spark.read.parquet(paths["fct_jobs"]).count() == 1500
    assert spark.read.parquet(paths["customer_health_summary"]).count() == 160
    built = Marketplace.built(spark, SF_SMALL, target)
    assert built.fct_jobs.inputFiles()[0].split("/models/")[1].startswith("fct_jobs/")
    assert built.service_category_performance.count() == 4


def test_appended_rows_are_seen(spark):
    """A query lists the files that are there when it is called."""
    from bazaar.plans.registry import queries

    out = tempfile.mkdtemp(prefix="bazaar-append-")
    write_sources(load_sources(spark, SF_SMALL), out)
    assert queries()["stg_jobs"](spark, out).count() == 1500
    more = spark.read.parquet(f"{out}/jobs.parquet").limit(7)
    more.selectExpr(*[c if c != "job_id" else "job_id + 1000000 AS job_id" for c in more.columns]).write.mode(
        "append"
    ).parquet(f"{out}/jobs.parquet")
    assert queries()["stg_jobs"](spark, out).count() == 1507
    assert queries()["fct_jobs"](spark, out).count() == 1507


def test_data_tests_leave_nothing_behind(spark):
    from bazaar.operators import quality
    from bazaar.session import checkpoint_dir

    m = Marketplace.load(spark, SF_SMALL)
    plan = m.fct_jobs._jdf.queryExecution().toString()
    views = {t.name for t in spark.catalog.listTables()}
    assert quality.test_summary(m).where("NOT passed").count() == 0
    assert m.fct_jobs._jdf.queryExecution().toString() == plan
    assert {t.name for t in spark.catalog.listTables()} == views
    runs = os.path.join(checkpoint_dir(spark).replace("file:", ""), "runs")
    assert not os.path.isdir(runs) or not os.listdir(runs)


def test_lost_parent_rows_fail_the_relationship(spark):
    """The declared parent is read: a dimension written with a lost row is found out."""
    from bazaar.operators import quality

    m = Marketplace.load(spark, SF_SMALL)
    lost = m.dim_services.first()["service_id"]
    short = m.replaced({"dim_services": m.dim_services.where(f"service_id <> {lost}")})
    rows = quality.declared_test_results(short, ("relationships",)).where("failures > 0").collect()
    assert [(r["model"], r["test"]) for r in rows] == [("fct_jobs", "relationships:dim_services.service_id")]


def test_folder_of_a_cluster_must_be_named(spark, monkeypatch):
    import pytest

    from bazaar import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def _written(spark, change=lambda name, df: df):
    out = tempfile.mkdtemp(prefix="bazaar-contract-")
    for name, df in load_sources(spark, SF_SMALL).items():
        df = change(name, df)
        if df is not None:
            df.write.parquet(f"{out}/{name}.parquet")
    return out


def test_missing_column_is_an_error(spark):
    import pytest

    out = _written(spark, lambda n, df: df.drop("gross_amount") if n == "jobs" else df)
    with pytest.raises(ValueError, match="'jobs'.*gross_amount is missing"):
        Marketplace.load(spark, out)


def test_wrong_type_is_an_error_and_narrow_types_are_read(spark):
    import pytest

    out = _written(spark, lambda n, df: df.withColumn("is_active", df.user_id.cast("string")) if n == "users" else df)
    with pytest.raises(ValueError, match="is_active is string, not boolean"):
        Marketplace.load(spark, out)
    narrow = lambda n, df: df.withColumn("user_id", df.user_id.cast("int")) if n == "users" else df
    assert Marketplace.load(spark, _written(spark, narrow)).stg_users.schema["user_id"].dataType.simpleString() == "bigint"


def test_missing_table_is_an_error(spark):
    import pytest

    out = _written(spark, lambda n, df: None if n == "payouts" else df)
    with pytest.raises(FileNotFoundError, match="payouts"):
        load_sources(spark, out)


def test_nanosecond_and_millisecond_timestamps(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq

    out = _written(spark)
    wanted = Marketplace.load(spark, out).stg_jobs
    for unit in ("ns", "ms", "us"):
        copy = tempfile.mkdtemp(prefix="bazaar-units-")
        for name in ("users", "contractor_profiles", "services", "jobs", "adjustments", "payouts"):
            table = pq.read_table(f"{out}/{name}.parquet")
            fields = [pa.field(f.name, pa.timestamp(unit) if pa.types.is_timestamp(f.type) else f.type) for f in table.schema]
            pq.write_table(table.cast(pa.schema(fields)), f"{copy}/{name}.parquet", version="2.6", coerce_timestamps=None)
        got = Marketplace.load(spark, copy).stg_jobs
        assert got.schema == wanted.schema and got.exceptAll(wanted).count() == 0


def test_not_a_number_is_found(spark):
    from pyspark.sql import functions as F

    from bazaar.operators import integrity

    spoil = lambda n, df: (
        df.withColumn("payout_amount", F.when(F.col("payout_id") % 100 == 0, F.lit(float("nan"))).otherwise(F.col("payout_amount")))
        if n == "payouts"
        else df
    )
    m = Marketplace.load(spark, _written(spark, spoil))
    n = m.stg_payouts.where("isnan(payout_amount)").count()
    assert n > 0
    found = {r["check_name"]: r["violations"] for r in integrity.source_integrity(m.staged_sources).collect()}
    assert found["payout_amount_non_negative"] == n
    missing = {r["column_name"]: r["null_count"] for r in integrity.profile_table(m.stg_payouts, "payouts").collect()}
    assert missing["payout_amount"] == n


def test_source_layouts(spark):
    import pytest

    with pytest.raises(FileNotFoundError):
        load_sources(spark, SF_SMALL, layout="marketplace")
    assert load_sources(spark, SF_SMALL, layout="tpch")["jobs"].count() == 1500
    out = tempfile.mkdtemp(prefix="bazaar-layout-")
    write_sources(load_sources(spark, SF_SMALL, layout="auto"), out, files_per_table=2)
    read_back = load_sources(spark, out)  # auto: the marketplace tables are found
    assert read_back["payouts"].inputFiles() and read_back["payouts"].count() == 1275
