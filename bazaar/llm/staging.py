"""Run-scoped tables in the shared checkpoint folder, and small frame helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.session import checkpoint_dir

#: Words are runs of anything but these six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


class Scratch:
    """Tables of one run, written once under the shared checkpoint folder.

    Writing a table cuts lineage: later jobs read files that survive the loss of any
    executor. ``drop`` deletes tables that no later step reads, ``keep`` all but those
    that the returned frame reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.id = uuid.uuid4().hex
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{self.id}"
        self.names: dict[str, str | None] = {}  # and the table of the catalog, if it is one

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.names[name] = None
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def bucketed(self, df: DataFrame, name: str, *keys: str) -> DataFrame:
        """``df`` written once, bucketed by ``keys``: later joins and groups on them need no shuffle of it."""
        table = self.names[name] = f"{name}_{self.id}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.format("parquet").option("path", self.path(name)).bucketBy(buckets, *keys).saveAsTable(table)
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            if table := self.names.pop(name, None):
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)

    def keep(self, *names: str) -> None:
        self.drop(*[n for n in self.names if n not in names])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``modulus`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def smallest_hashes(keys: DataFrame, hashed: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``keys``, those with the smallest 64-bit hash.

    A threshold that about twice as many rows pass is applied before the ordering, so
    what is ordered is bounded by ``rows`` and not by the number of partitions.
    """
    n = keys.count()
    share = min(1.0, (2 * rows + 1_000) / max(n, 1))
    bound = min(int(share * (1 << 63)), (1 << 63) - 1)
    return (
        keys.withColumn("_hash", hashed.bitwiseAND(F.lit((1 << 63) - 1)))
        .where(F.col("_hash") <= F.lit(bound))
        .orderBy("_hash", *keys.columns)
        .limit(rows)
        .drop("_hash")
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(df: DataFrame) -> Column:
    """A 64-bit content key over every column; rows with equal keys are repeats."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def pick_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text hash) is in ``kept``; repeated rows once.

    ``kept`` has ``doc_id`` and ``text_hash`` (xxhash64 of the text), one row per
    key. Repeats of a row are combined map-side before the shuffle, and the join
    reuses that shuffle.
    """
    cols = docs.columns
    keyed = docs.select(
        F.col("doc_id").alias("_k_doc"),
        F.xxhash64("text").alias("_k_text"),
        F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"),
    )
    once = keyed.groupBy("_k_doc", "_k_text").agg(F.first("_row").alias("_row"))
    want = kept.select(F.col("doc_id").alias("_w_doc"), F.col("text_hash").alias("_w_text"))
    return once.join(
        want, F.col("_k_doc").eqNullSafe(F.col("_w_doc")) & (F.col("_k_text") == F.col("_w_text")), "left_semi"
    ).select(*[F.col("_row").getField(c).alias(c) for c in cols])
