"""One commit for the six raw tables: data files, and a manifest that names them.

A snapshot folder has ``data/`` (Parquet folders, never changed once written) and
``manifests/`` (one small JSON file per version: table -> data folder). A write puts
its data down first and then creates the next manifest, which either exists whole
or not at all. Readers take the paths of one manifest, so they see all six tables of one version,
whatever is being written; a write that dies between two tables leaves no manifest and
thereby nothing to see.

Tables that a write does not name are those of the version before it. Two writers that start
from the same version cannot both commit: the second one gets ``SnapshotConflict``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from bazaar.sources.catalog import LAYOUT_KEYS, read_paths, staged
from bazaar.sources.schemas import TABLE_NAMES

MANIFESTS = "manifests"


class SnapshotConflict(RuntimeError):
    """Another write has committed the version that this one would be."""


def hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest_path(directory: str, version: int) -> str:
    return f"{directory.rstrip('/')}/{MANIFESTS}/{version:020d}.json"


def versions(spark: SparkSession, directory: str) -> list[int]:
    """Committed versions, oldest first; none for a folder without snapshots."""
    folder, fs = hadoop_path(spark, f"{directory.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(folder))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, directory: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """A version (the newest by default) and its data folders, relative to ``directory``."""
    if version is None:
        known = versions(spark, directory)
        if not known:
            raise FileNotFoundError(f"{directory} has no snapshot")
        version = known[-1]
    text = spark.read.text(_manifest_path(directory, version), wholetext=True).first()[0]
    return version, json.loads(text)


def read_snapshot(spark: SparkSession, directory: str, version: int | None = None) -> dict[str, DataFrame]:
    """The six raw tables of one version; later writes do not change what these frames read."""
    _, folders = manifest(spark, directory, version)
    return read_paths(spark, {name: f"{directory.rstrip('/')}/{folders[name]}" for name in TABLE_NAMES})


def commit_manifest(spark: SparkSession, directory: str, version: int, folders: dict) -> None:
    """Create a manifest by a rename that does not replace: atomic on HDFS and local disks.

    Object stores without such a rename need a committer of their own, as for any table there.
    """
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    draft, fs = hadoop_path(spark, f"{directory.rstrip('/')}/{MANIFESTS}/.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(folders, indent=1, sort_keys=True), "utf-8"))
    finally:
        stream.close()
    final = jvm.org.apache.hadoop.fs.Path(_manifest_path(directory, version))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    plain = gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), plain)
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(final):
            raise SnapshotConflict(f"version {version} of {directory} was committed by another write") from error
        raise


def write_snapshot(
    sources: dict[str, DataFrame], directory: str, base: int | None = None, files_per_table: int | None = None
) -> int:
    """Write the given tables as the next version and return its number.

    The first version needs all six tables. ``base`` is the version the tables were made from (the
    newest when the write starts by default); if it is no longer the newest at the end, the write is a
    ``SnapshotConflict`` and readers see nothing of it.
    """
    if not sources:
        raise ValueError("no table to write")
    spark = next(iter(sources.values())).sparkSession
    known = versions(spark, directory)
    if base is None:
        base = known[-1] if known else 0
    folders = manifest(spark, directory, base)[1] if base else {}
    if unknown := set(sources) - set(TABLE_NAMES):
        raise ValueError(f"not source tables: {', '.join(sorted(unknown))}")
    if lacking := set(TABLE_NAMES) - set(sources) - set(folders):
        raise ValueError(f"the first snapshot lacks {', '.join(sorted(lacking))}")
    write = uuid.uuid4().hex
    for name, df in sources.items():
        df = staged(df, name)
        if files_per_table:
            df = df.repartition(files_per_table, LAYOUT_KEYS[name])
        folders[name] = f"data/{write}/{name}.parquet"
        df.write.mode("errorifexists").parquet(f"{directory.rstrip('/')}/{folders[name]}")
    commit_manifest(spark, directory, base + 1, folders)
    return base + 1


def expire(spark: SparkSession, directory: str, keep: int = 1) -> list[int]:
    """Remove all but the newest ``keep`` versions, and the data that only they name.

    Manifests go first, so no reader finds a version whose data is going. Data of writes
    still under way has no manifest and is not touched.
    """
    if keep < 1:
        raise ValueError("at least one version stays")
    known = versions(spark, directory)
    old, new = known[:-keep], known[-keep:]
    named = {v: set(manifest(spark, directory, v)[1].values()) for v in known}
    used = set().union(*(named[v] for v in new)) if new else set()
    for v in old:
        target, fs = hadoop_path(spark, _manifest_path(directory, v))
        fs.delete(target, False)
    for folder in sorted(set().union(*(named[v] for v in old)) - used) if old else []:
        target, fs = hadoop_path(spark, f"{directory.rstrip('/')}/{folder}")
        fs.delete(target, True)
    return old
