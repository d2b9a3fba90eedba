"""SparkSession construction and shared-storage settings."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Timestamps are zone-less (TIMESTAMP_NTZ) in the
# sources, but a UTC session zone keeps any LTZ detour deterministic.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "bazaar",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the base settings applied.

    On a cluster leave ``master`` as None (spark-submit decides) and size
    ``shuffle_partitions`` to the data: roughly total shuffle bytes / 128 MB.
    AQE coalesces small partitions at runtime, so erring high is cheap.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it), or from the folder
    the session was given. Only on a local master, where one machine holds
    everything, is a scratch folder made when neither is set; on a cluster that
    would be a different disk for every executor, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
    local = tempfile.mkdtemp(prefix="bazaar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local


class RunFolder:
    """Tables of one run, under a folder of its own in the shared checkpoint folder.

    Leaving the ``with`` block deletes the folder, so results must have been read or
    written elsewhere by then. The run's id in the path keeps concurrent runs apart.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/runs/{label}-{uuid.uuid4().hex}"

    def __enter__(self) -> "RunFolder":
        return self

    def __exit__(self, *_) -> None:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back: its lineage then starts at the files."""
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")
