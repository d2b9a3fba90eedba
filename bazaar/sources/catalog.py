"""Reading, checking, staging and writing the six raw marketplace tables.

A source directory either holds the marketplace tables themselves
(``jobs.parquet``, ``payouts.parquet`` ...) or the TPC-H-style test tables they
are derived from. Which one is meant is told by the folder: the layout is
"marketplace" if it has any of the six tables, and then all six must be there and
carry the declared columns.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.sources import fixtures
from bazaar.sources.schemas import RAW_SCHEMAS, TABLE_NAMES

LAYOUTS = ("auto", "marketplace", "snapshot", "tpch")
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.TimestampNTZType, T.TimestampType, T.DateType)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _accepts(declared: T.DataType, found: T.DataType) -> bool:
    """Whether a column of type ``found`` can be read as ``declared`` without loss of meaning."""
    if isinstance(declared, T.LongType):
        return isinstance(found, NUMBERS[:4])
    if isinstance(declared, T.DoubleType):
        return isinstance(found, NUMBERS)
    if isinstance(declared, T.TimestampNTZType):
        return isinstance(found, TIMES)
    return type(declared) is type(found)


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a raw table in their declared types.

    Raises, naming the table and every column at fault, if one is missing or has a
    type that cannot stand for the declared one.
    """
    faults = []
    found = {f.name: f.dataType for f in df.schema.fields}
    for field in RAW_SCHEMAS[table].fields:
        if field.name not in found:
            faults.append(f"{field.name} is missing")
        elif not _accepts(field.dataType, found[field.name]):
            faults.append(f"{field.name} is {found[field.name].simpleString()}, not {field.dataType.simpleString()}")
    if faults:
        raise ValueError(f"source table {table!r}: {'; '.join(faults)}")
    return df.select(
        *[
            F.col(f.name) if found[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in RAW_SCHEMAS[table].fields
        ]
    )


def _own_schema(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw table with the schema of its files, nanosecond timestamps included.

    Spark has no nanosecond type. A column that holds nanoseconds since the epoch is
    read as a whole number and divided, which keeps the microseconds.
    """
    key = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        df = spark.read.parquet(path)
        # forces the schema to be read while the setting holds
        found = {f.name: f.dataType for f in df.schema.fields}
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    nanos = [
        f.name
        for f in RAW_SCHEMAS[table].fields
        if isinstance(f.dataType, T.TimestampNTZType) and isinstance(found.get(f.name), T.LongType)
    ]
    if not nanos:
        return df
    as_time = lambda c: F.timestamp_micros(F.floor(F.col(c) / 1000).cast("long")).cast("timestamp_ntz")
    return df.withColumns({c: as_time(c) for c in nanos})


def read_raw(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Scan the raw Parquet tables (A1-A6), each with its own schema checked against the declared one."""
    paths = {name: f"{directory.rstrip('/')}/{name}.parquet" for name in TABLE_NAMES}
    missing = [name for name, path in paths.items() if not exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"{directory} lacks the source tables {', '.join(missing)}")
    return read_paths(spark, paths)


def read_paths(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The raw tables at given paths, in their declared columns and types."""
    return {name: conform(_own_schema(spark, path, name), name) for name, path in paths.items()}


def load_sources(spark: SparkSession, directory: str, layout: str = "auto") -> dict[str, DataFrame]:
    """The six raw tables as lazy DataFrames.

    ``layout``: "marketplace" reads ``<table>.parquet`` for the six tables, "snapshot" the newest
    version of ``write_snapshot``, "tpch" derives them from the TPC-H-style test tables, "auto"
    takes the first if the folder has any of the six tables and the second if it has manifests. A marketplace folder that lacks a table is an
    error in either case, never a reason to read something else.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "auto":
        here = any(exists(spark, f"{directory.rstrip('/')}/{name}.parquet") for name in TABLE_NAMES)
        committed = not here and exists(spark, f"{directory.rstrip('/')}/manifests")
        layout = "marketplace" if here else "snapshot" if committed else "tpch"
    if layout == "marketplace":
        return read_raw(spark, directory)
    if layout == "snapshot":
        from bazaar.sources.snapshots import read_snapshot

        return read_snapshot(spark, directory)
    return fixtures.derive_sources(fixtures.TpchInputs.read(spark, directory))


def staged(raw: DataFrame, table: str) -> DataFrame:
    """Staging model: the raw table unchanged, after checking its columns.

    Missing columns fail here, at the ingestion boundary, instead of deep
    inside a mart.
    """
    return conform(raw, table)


# Layout key per table: its own key, or job_id for the job-grain children.
LAYOUT_KEYS = {
    "users": "user_id",
    "contractor_profiles": "user_id",
    "services": "service_id",
    "jobs": "job_id",
    "adjustments": "job_id",
    "payouts": "job_id",
}


def write_sources(
    sources: dict[str, DataFrame], directory: str, mode: str = "overwrite", files_per_table: int | None = None
) -> None:
    """Persist the six raw tables as Parquet (one directory per table).

    Without ``files_per_table`` rows keep the engine's partitioning (parallel
    write, no extra shuffle). With it, each table is hash-partitioned on its
    layout key into that many files, so later scans split evenly and the three
    job-grain tables share one layout.
    """
    for name in TABLE_NAMES:
        df = staged(sources[name], name)
        if files_per_table:
            df = df.repartition(files_per_table, LAYOUT_KEYS[name])
        df.write.mode(mode).parquet(os.path.join(directory, f"{name}.parquet"))


def write_bucketed(sources: dict[str, DataFrame], directory: str, buckets: int) -> dict[str, DataFrame]:
    """Write the six tables bucketed and sorted on their layout keys, and read them as such.

    Jobs, adjustments and payouts then meet on job_id without a shuffle. The folder
    is an ordinary marketplace folder too.
    """
    for name in TABLE_NAMES:
        df = staged(sources[name], name).repartition(buckets, LAYOUT_KEYS[name])
        (
            df.write.format("parquet")
            .mode("overwrite")
            .option("path", f"{directory.rstrip('/')}/{name}.parquet")
            .bucketBy(buckets, LAYOUT_KEYS[name])
            .sortBy(LAYOUT_KEYS[name])
            .saveAsTable(_table_name(directory, name))
        )
    spark = sources[TABLE_NAMES[0]].sparkSession
    return read_bucketed(spark, directory, buckets)


def read_bucketed(spark: SparkSession, directory: str, buckets: int) -> dict[str, DataFrame]:
    """The tables of ``write_bucketed``, declared to Spark with their buckets."""
    out = {}
    for name in TABLE_NAMES:
        table, key = _table_name(directory, name), LAYOUT_KEYS[name]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_SCHEMAS[name].fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
            f"INTO {buckets} BUCKETS LOCATION '{directory.rstrip('/')}/{name}.parquet'"
        )
        out[name] = conform(spark.table(table), name)
    return out


def _table_name(directory: str, name: str) -> str:
    return f"raw_{name}_{uuid.uuid5(uuid.NAMESPACE_URL, directory.rstrip('/')).hex}"
