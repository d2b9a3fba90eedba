"""Mixing sources to target weights by hash-threshold histograms.

Every source has a weight; all sources together give as many words as there are.
A target stops at ``LIMIT`` times its source's size and the excess is shared anew by
weight. A target of r whole sizes and a rest takes every document r times and, once
more, the documents whose hash lies below a threshold. The threshold comes from
sums of words by source and hash bucket: the bucket in which the sum reaches the
rest is split into finer buckets, and only its documents are read again. Nothing is
sorted; the documents are filtered by hash.

Defined cases: a null text has size 0; a null source is a source of its own, last
in order; without any word all targets are 0 and nothing is taken. Rows with equal
doc_id have equal hashes and are taken alike (a null id hashes as an empty one).
Extra columns are not read by the query.
"""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.staging import Scratch

WEIGHTS = (1, 2, 3)
LIMIT = 3
#: Bits of a document's hash, and of one level of buckets.
HASH_BITS = 60
LEVEL_BITS = 12


@F.pandas_udf(T.LongType())
def _n_words(text: pd.Series) -> pd.Series:
    return text.map(lambda t: len(t.encode().split()) if t else 0).astype("int64")


def doc_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the decimal doc_id, so that SQL engines agree on it."""
    digits = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digits, 1, HASH_BITS // 4), 16, 10).cast("long")


def doc_sizes(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.coalesce(_n_words("text"), F.lit(0)).cast("long").alias("size"),
        doc_hash(F.col("doc_id")).alias("h"),
    )


def ranked_sources(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """source, source_size, weight: rank by code point, null last, over a range partitioning.

    One row per source. The offsets window reads one row per partition.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = scratch.table(
        totals.repartitionByRange(n, F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "sources",
    )
    counts = parts.groupBy("part").count()
    before = counts.select(
        "part", (F.sum("count").over(W.orderBy("part")) - F.col("count")).alias("before")
    )
    local = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    rank = F.col("before") + F.col("local") - 1
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    return (
        parts.withColumn("local", local)
        .join(before, "part")
        .select(
            "source",
            "source_size",
            F.element_at(weights, (rank % len(WEIGHTS) + 1).cast("int")).cast("long").alias("weight"),
        )
    )


def targets(sources: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``sources`` with ``target``: shares by weight, capped, the excess shared anew until none is above.

    Each round is one aggregate over the sources; its three sums are exact integers.
    """
    big = "decimal(38,0)"
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    capped = F.lit(False)
    cap = (F.col("source_size") * limit).cast(big)
    share = lambda rest: F.col("weight").cast(big) * F.lit(Decimal(rest)).cast(big)
    state = None
    while True:
        held, weight = sources.agg(
            F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight").cast(big)))
        ).first()
        rest, weight = int(total - (held or 0)), int(weight or 0)
        if (rest, weight) == state or not weight:
            break
        state = (rest, weight)
        capped = share(rest) > cap * F.lit(Decimal(weight)).cast(big)
    rest, weight = state or (0, 1)
    return sources.withColumn(
        "target",
        F.when(capped, cap.cast("double")).otherwise(
            (F.col("weight") * F.lit(rest)).cast("double") / F.lit(float(max(weight, 1)))
        ),
    )


def mix(sizes: DataFrame, limit: int = LIMIT, scratch: Scratch | None = None) -> DataFrame:
    """source, source_size, target, repeats and cut of every source.

    A document is taken ``repeats`` times, and once more if its hash is below ``cut``.
    """
    scratch = scratch or Scratch(sizes.sparkSession, "mixing")
    named = targets(scratch.table(ranked_sources(sizes, scratch), "ranked"), limit)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(limit)))
    state = named.withColumn("repeats", F.coalesce(whole, F.lit(0)).cast("long")).select(
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("key"),
        "*",
        (F.col("target") - F.col("repeats") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("low"),  # hashes below are taken
        F.lit(0).cast("long").alias("taken"),
        (F.col("target") <= F.col("repeats") * F.col("source_size")).alias("done"),
    )
    state = scratch.table(state, "level-0")
    rows = sizes.select(
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("key"),
        "size",
        "h",
    ).where("size > 0")
    levels = HASH_BITS // LEVEL_BITS
    for level in range(1, levels + 1):
        shift = HASH_BITS - level * LEVEL_BITS
        open_ = state.where("NOT done").select("key", "low", "rest", "taken")
        inside = rows.join(open_.select("key", "low"), "key")
        if level > 1:
            inside = inside.where(
                F.shiftright("h", shift + LEVEL_BITS) == F.shiftright("low", shift + LEVEL_BITS)
            )
        cells = inside.groupBy("key", F.shiftright("h", shift).alias("cell")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")
        )
        # at most 2^LEVEL_BITS cells a source
        running = F.sum("words").over(W.partitionBy("key").orderBy("cell").rowsBetween(W.unboundedPreceding, 0))
        edge = (
            cells.withColumn("upto", running)
            .join(open_.select("key", "rest", "taken"), "key")
            .where(F.col("taken") + F.col("upto") >= F.col("rest"))
            .groupBy("key")
            .agg(F.min_by(F.struct("cell", "words", "upto", "n"), "cell").alias("e"))
        )
        last = F.lit(level == levels) | (F.col("e.n") == 1)
        prior = F.col("taken") + F.col("e.upto") - F.col("e.words")
        after = F.col("taken") + F.col("e.upto")
        add = (after - F.col("rest")) <= (F.col("rest") - prior)  # the nearer of with and without the last cell
        state = scratch.table(
            state.join(edge, "key", "left").select(
                "key", "source", "source_size", "target", "weight", "repeats", "rest",
                F.when(F.col("done") | F.col("e").isNull(), F.col("low"))
                .otherwise(F.shiftleft(F.col("e.cell") + F.when(last & add, 1).otherwise(0), shift)).alias("low"),
                F.when(F.col("done") | F.col("e").isNull(), F.col("taken")).otherwise(prior).alias("taken"),
                (F.col("done") | F.col("e").isNull() | last).alias("done"),
            ),
            f"level-{level}",
        )
        scratch.drop(f"level-{level - 1}")
        if state.where("NOT done").isEmpty():
            break
    scratch.drop("sources", "ranked")
    return state.select("source", "source_size", "target", "repeats", F.col("low").alias("cut"))


def _copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source and h among its columns) with ``copies``, ``source_size`` and ``target``."""
    plan = plan.withColumnRenamed("source", "_mix_source")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("_mix_source"))).withColumn(
        "copies", F.col("repeats") + (F.col("h") < F.col("cut")).cast("long")
    )


def mixture(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.table(doc_sizes(docs), "sizes")
    return _copies(sizes, mix(sizes, limit, scratch)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def apply_mixture(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``docs`` as mixed: a document taken k times is k rows, one taken 0 times is left out."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.table(doc_sizes(docs), "sizes")
    plan = mix(sizes, limit, scratch)
    cols = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), "source", doc_hash(F.col("doc_id")).alias("h"))
    copies = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    repeated = _copies(rows, plan).where("copies > 0").select("_row", F.explode(copies).alias("_k"))
    return repeated.select(*[F.col("_row").getField(c).alias(c) for c in cols])


MIX_SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
    FROM documents
), s0 AS (
    SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source
), s1 AS (
    SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
           sum(source_size) OVER () AS total FROM s0
), s2 AS (
    -- by the ratio of cap and weight: a source is capped while its share of what is left exceeds its cap
    SELECT *, 3 * source_size AS cap,
           coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
           sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
    FROM s1 WINDOW o AS (ORDER BY 3 * source_size::DOUBLE / w, source NULLS LAST)
), s3 AS (
    SELECT *, w * (total - caps_before) > cap * w_left AS capped FROM s2
), rest AS (
    SELECT max(total) - coalesce(sum(cap) FILTER (capped), 0) AS words, coalesce(sum(w) FILTER (NOT capped), 1) AS w
    FROM s3
), s4 AS (
    SELECT s3.source, s3.source_size,
           CASE WHEN capped THEN cap::DOUBLE ELSE (s3.w * rest.words)::DOUBLE / rest.w::DOUBLE END AS target
    FROM s3, rest
), s5 AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS repeats FROM s4
), s6 AS (
    SELECT *, target - repeats * source_size AS remainder FROM s5
), g AS (
    SELECT source, h, sum(size) AS words FROM d WHERE size > 0 GROUP BY source, h
), g2 AS (
    SELECT g.source, g.h, g.words, sum(g.words) OVER (PARTITION BY g.source ORDER BY g.h) AS upto FROM g
), cut AS (
    SELECT g2.source, max(g2.h) FILTER (
        upto < remainder OR (upto - words < remainder AND upto - remainder <= remainder - (upto - words))
    ) AS last_h
    FROM g2 JOIN s6 ON g2.source IS NOT DISTINCT FROM s6.source WHERE remainder > 0 GROUP BY g2.source
)
SELECT d.doc_id, d.size, s6.source_size::BIGINT AS source_size, s6.target,
       (d.size * (s6.repeats + CASE WHEN d.h <= cut.last_h THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source
LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
"""
