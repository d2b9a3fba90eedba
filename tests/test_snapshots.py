"""Snapshots of the six raw tables: one commit, pinned readers, conflicts, expiry."""

import os

import pytest
from builders import adjustment, contractor, job, payout, raw_tables, service, user
from pyspark.sql import functions as F

from bazaar.sources import (
    TABLE_NAMES, SnapshotConflict, expire, load_sources, manifest, read_snapshot, versions, write_snapshot,
)

DAY = "2024-02-01 00:00:00"


def tables(spark, n):
    """Tables whose every row count is n, so that a mixture of two versions shows."""
    return raw_tables(
        spark,
        users=[user(i) for i in range(n)],
        contractor_profiles=[contractor(i) for i in range(n)],
        services=[service(i, 0) for i in range(n)],
        jobs=[job(i, 0, 0, 0, DAY, DAY) for i in range(n)],
        adjustments=[adjustment(i, i, DAY, "refund", 1.0) for i in range(n)],
        payouts=[payout(i, 0, i, DAY, 0.2, 1.0) for i in range(n)],
    )


def counts(sources):
    return {name: df.count() for name, df in sources.items()}


def failing(df):
    first = df.columns[0]
    broken = F.when(F.col(first) >= 0, F.raise_error(F.lit("executor lost")).cast("long")).otherwise(F.col(first))
    return df.withColumn(first, broken.cast(df.schema[first].dataType))


def test_readers_see_one_version(spark, tmp_path):
    at = f"file://{tmp_path}/raw"
    assert versions(spark, at) == []
    assert write_snapshot(tables(spark, 2), at) == 1
    pinned = read_snapshot(spark, at)
    assert write_snapshot(tables(spark, 3), at, files_per_table=2) == 2
    assert counts(pinned) == dict.fromkeys(TABLE_NAMES, 2)
    assert counts(load_sources(spark, at)) == dict.fromkeys(TABLE_NAMES, 3)
    assert counts(read_snapshot(spark, at, 1)) == dict.fromkeys(TABLE_NAMES, 2)


@pytest.mark.parametrize("broken", TABLE_NAMES)
def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path, broken):
    at = f"file://{tmp_path}/raw"
    write_snapshot(tables(spark, 1), at)
    new = tables(spark, 2)
    new[broken] = failing(new[broken])
    with pytest.raises(Exception, match="executor lost"):
        write_snapshot(new, at)
    assert versions(spark, at) == [1]
    assert counts(load_sources(spark, at)) == dict.fromkeys(TABLE_NAMES, 1)
    assert write_snapshot(tables(spark, 2), at) == 2
    assert counts(load_sources(spark, at)) == dict.fromkeys(TABLE_NAMES, 2)


def test_some_tables_and_conflicts(spark, tmp_path):
    at = f"file://{tmp_path}/raw"
    with pytest.raises(ValueError, match="lacks"):
        write_snapshot({"jobs": tables(spark, 1)["jobs"]}, at)
    write_snapshot(tables(spark, 1), at)
    assert write_snapshot({"payouts": tables(spark, 4)["payouts"]}, at, base=1) == 2
    assert counts(read_snapshot(spark, at)) == dict.fromkeys(TABLE_NAMES, 1) | {"payouts": 4}
    one, two = manifest(spark, at, 1)[1], manifest(spark, at, 2)[1]
    assert {n for n in TABLE_NAMES if one[n] != two[n]} == {"payouts"}
    with pytest.raises(SnapshotConflict):
        write_snapshot({"jobs": tables(spark, 5)["jobs"]}, at, base=1)
    assert counts(read_snapshot(spark, at)) == dict.fromkeys(TABLE_NAMES, 1) | {"payouts": 4}
    assert not [n for n in os.listdir(tmp_path / "raw" / "manifests") if n.endswith(".draft")]
    with pytest.raises(ValueError, match="orders"):
        write_snapshot({"orders": tables(spark, 1)["jobs"]}, at)


def test_expiry_keeps_what_newer_versions_read(spark, tmp_path):
    at = f"file://{tmp_path}/raw"
    write_snapshot(tables(spark, 1), at)
    write_snapshot({"payouts": tables(spark, 2)["payouts"]}, at)
    write_snapshot({"payouts": tables(spark, 3)["payouts"]}, at)
    assert expire(spark, at, keep=2) == [1] and versions(spark, at) == [2, 3]
    assert counts(read_snapshot(spark, at, 2)) == dict.fromkeys(TABLE_NAMES, 1) | {"payouts": 2}
    assert expire(spark, at) == [2] and expire(spark, at) == []
    assert counts(load_sources(spark, at)) == dict.fromkeys(TABLE_NAMES, 1) | {"payouts": 3}
