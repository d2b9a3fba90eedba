"""Exact dedup by a persistent digest index, bucketed and sorted by hash.

A text's digest is the SHA-256 of the text with each run of white space replaced
by one space. The index is a bucketed, sorted table of digests; new documents are
grouped by digest (copies combine map-side, so a group of any size costs one row
per task), checked by a sort-merge anti join, and what is new is appended.
DataFrame functions only.

Defined cases: a null text counts as empty, and empty texts equal each other. In a
group the smallest doc_id stays, null ids last; of repeated rows with the same id
one stays, and the ``kept`` flag of all of them is true (they are the same row).
Extra columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm.staging import SPACE, Scratch, row_key

#: Production bucket count of an index: a power of two near total digests * 48 B / 128 MB.
BUCKETS = 32


def digest(text: Column) -> Column:
    normal = F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")
    return F.sha2(normal.cast("binary"), 256)


class DigestIndex:
    """A table (digest, keep_id, n_rows, batch), bucketed and sorted by digest.

    ``location`` is the shared folder of the index; opening an existing folder
    continues it. Every batch has a name that the caller chooses and gives again when it
    repeats a lost job: what that batch itself put into the index is not "seen" to it, and is not
    put there twice, so a repeat returns the same rows, even if the lost job had appended
    some or all of them. Batches are added one after another, not at the same time.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int = BUCKETS):
        self.spark, self.location, self.buckets = spark, location, buckets
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, location).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT, n_rows BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'"
        )

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """Rows of ``groups`` whose digest the index lacks or has from ``batch``, by sort-merge anti join."""
        known = self.read() if batch is None else self.read().where(F.col("batch") != batch)
        return groups.join(known.hint("merge").select("digest"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Append what is new of (digest, keep_id, n_rows); one file per bucket and task."""
        (
            self.unseen(groups)
            .select("digest", "keep_id", "n_rows", F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )


def digests(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))


def groups_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n_rows"))


def open_index(index: DigestIndex | None, batch: str | None, scratch: Scratch) -> tuple[DigestIndex, str]:
    """The caller's index and batch name, or a fresh index of this run."""
    if index is None:
        return DigestIndex(scratch.spark, scratch.path("index")), batch or scratch.id
    if not batch:
        raise ValueError("a batch that goes into a lasting index needs a name, so that it can be repeated")
    return index, batch


def exact_groups(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Without an index a fresh one is made. With an index that already holds a
    digest, ``keep_id`` is the id kept then, and none of the new rows is kept
    unless it is that document. ``batch`` names these rows (see ``DigestIndex``).
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    index, batch = open_index(index, batch, scratch)
    rows = scratch.table(digests(docs), "digests")
    index.append(groups_of(rows), batch)
    known = index.read().select("digest", "keep_id")
    here = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    return rows.join(here.join(known, "digest"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """``docs`` with one row of each group of equal texts, and none the index had.

    The row with the smallest doc_id stays. Groups combine map-side before their
    shuffle, and the anti join reuses it. The survivors' digests are appended under
    the name ``batch``; the same rows under the same name give the same result again.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    index, batch = open_index(index, batch, scratch)
    cols = docs.columns
    first = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), row_key(docs).alias("c"))
    grouped = (
        docs.select(digest(F.col("text")).alias("digest"), first.alias("_first"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
        .groupBy("digest")
        .agg(F.min_by("_row", "_first").alias("_row"), F.count(F.lit(1)).alias("n_rows"))
    )
    kept = scratch.table(index.unseen(grouped, batch), "kept")
    index.append(kept.select("digest", F.col("_row.doc_id").cast("long").alias("keep_id"), "n_rows"), batch)
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in cols])


EXACT_SQL = r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
