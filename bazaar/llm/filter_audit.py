"""Filter interaction audit over a sparse document-term matrix.

1. Whole texts are cut into words and stored as CSR shards of some megabytes: row
   starts, column numbers, counts, and the shard's own words. What else the filters need
   of a text (capitals, marks, length, a 128-bit key) is stored beside its row.
2. The words of all shards are encoded in one global dictionary, dealt to buckets by hash
   and numbered bucket by bucket. Only a shard's distinct words are shuffled, packed as one
   row for a bucket, and numbers come back the same way; the shard's columns are then
   replaced by the global numbers.
3. Row sums of the matrix are words and its nonzero counts distinct words: they decide
   filters A and B. C and D come from the row's counts, E from the least id of equal texts.
4. A document's five failures are one mask. Documents are counted by part and mask, map-side
   combined; the audit of all orders and steps follows from those counts, at most
   32 rows a part.

Defined cases: a null text is empty; null and empty texts are identical to each other. A
null doc_id is no smaller id for others and has no smaller one, so it never fails E;
repeated rows do not fail E because of each other. A null part is the empty string. Several
label rows of one id: any of them with the mark counts; label rows without an id are of no
document. An empty table has no parts and gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.staging import Scratch

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
MARKS = "#$%&*|"
#: Bytes of text in one shard of the matrix (or one text).
SHARD_BYTES = 8 << 20
#: Bytes of text for each bucket of the dictionary.
BUCKET_BYTES = 64 << 20

_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in MARKS]] = True

DOCUMENT, SHARD, WORDS = range(3)


@dataclass
class Shard:
    """CSR rows of some texts; columns are numbers of ``words``, which are ordered by bucket."""

    starts: np.ndarray
    columns: np.ndarray
    counts: np.ndarray
    words: list[bytes]
    ends: np.ndarray  # of the buckets, in ``words``


def csr(texts: list[bytes], buckets: int) -> Shard:
    numbers: dict[bytes, int] = {}
    found, lengths = [], np.zeros(len(texts), np.int64)
    for r, text in enumerate(texts):
        ids = [numbers.setdefault(w, len(numbers)) for w in text.split()]  # bytes: the six ASCII blanks only
        found.append(np.array(ids, np.int64))
        lengths[r] = len(ids)
    words = list(numbers)
    bucket = np.fromiter((crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    renumbered = np.empty(len(words), np.int64)
    renumbered[order] = np.arange(len(words))
    column = renumbered[np.concatenate(found)] if found else np.zeros(0, np.int64)
    key = np.repeat(np.arange(len(texts)), lengths) * max(len(words), 1) + column
    entry, counts = np.unique(key, return_counts=True)
    row, column = np.divmod(entry, max(len(words), 1))
    starts = np.searchsorted(row, np.arange(len(texts) + 1))
    return Shard(starts, column, counts, [words[k] for k in order], np.searchsorted(bucket[order], np.arange(buckets), "right"))


def facts(docs: DataFrame, part: str) -> DataFrame:
    """doc_id, part, text and its 128-bit key, of every row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit("second"), text).alias("t2"),
        text.alias("text"),
    )


MATRIX = (
    ("kind", pa.int32(), "int"), ("shard", pa.int64(), "long"), ("at", pa.int32(), "int"),
    ("doc_id", pa.int64(), "long"), ("part", pa.string(), "string"), ("t1", pa.int64(), "long"), ("t2", pa.int64(), "long"),
    ("over_capitals", pa.bool_(), "boolean"), ("marked", pa.bool_(), "boolean"),
    ("starts", pa.binary(), "binary"), ("columns", pa.binary(), "binary"), ("counts", pa.binary(), "binary"),
    ("bucket", pa.int32(), "int"), ("words", pa.binary(), "binary"),
)


def _rows(values: dict, n: int) -> pa.RecordBatch:
    """``n`` rows of MATRIX; columns that are not given are null."""
    given = [pa.array(values[c], t) if c in values else pa.nulls(n, t) for c, t, _ in MATRIX]
    return pa.RecordBatch.from_arrays(given, names=[c for c, _, _ in MATRIX])


def matrix_rows(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the three kinds: documents, CSR shards, and a shard's words of one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            body = batch.column("text").cast(pa.large_binary())
            total, at = np.cumsum(np.asarray(pc.binary_length(body))), 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SHARD_BYTES, "right")))
                piece, texts = batch.slice(at, end - at), body.slice(at, end - at).to_pylist()
                n = len(texts)
                capital, marked = np.zeros(n, bool), np.zeros(n, bool)
                for k, text in enumerate(texts):
                    data = np.frombuffer(text, np.uint8)
                    points = len(data) - int(((data & 0xC0) == 0x80).sum())  # less continuation bytes
                    capital[k] = 100 * int(_CAPITAL[data].sum()) > CAPITAL_PERCENT * points
                    marked[k] = bool(_MARK[data].any())
                same = {c: piece.column(c) for c in ("doc_id", "part", "t1", "t2")}
                yield _rows(
                    {"kind": np.full(n, DOCUMENT, np.int32), "shard": np.full(n, shard), "at": np.arange(n, dtype=np.int32),
                     "over_capitals": capital, "marked": marked} | same, n,
                )
                m = csr(texts, buckets)
                yield _rows(
                    {"kind": [SHARD], "shard": [shard], "starts": [m.starts.astype(np.int64).tobytes()],
                     "columns": [m.columns.astype(np.uint32).tobytes()], "counts": [m.counts.astype(np.uint32).tobytes()]}, 1,
                )
                edges = np.concatenate(([0], m.ends))
                held = np.flatnonzero(np.diff(edges)).tolist()
                joined = [b" ".join(m.words[edges[b] : edges[b + 1]]) for b in held]  # words hold no blank
                yield _rows({"kind": [WORDS] * len(held), "shard": [shard] * len(held), "bucket": held, "words": joined}, len(held))
                shard += 1
                at = end

    return run


def global_numbers(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """One bucket of the dictionary: its words get numbers, and each shard those of its words, in their order."""

    def run(group: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        ids = []
        for joined in group.column("words"):
            held = [numbers.setdefault(w, len(numbers)) for w in joined.as_py().split(b" ")]
            ids.append((np.array(held, np.int64) * buckets + group.column("bucket")[0].as_py()).tobytes())
        return pa.table({"shard": group.column("shard"), "bucket": group.column("bucket"), "ids": pa.array(ids, pa.binary())})

    return run


COUNTED = pa.schema([("shard", pa.int64()), ("at", pa.int32()), ("n_words", pa.int64()), ("n_distinct", pa.int64())])


def row_counts(shard: pa.Table, numbers: pa.Table) -> pa.Table:
    """Row sums and nonzero counts of one shard of the global matrix."""
    if not shard.num_rows:
        return COUNTED.empty_table()
    cell = lambda name, kind: np.frombuffer(shard.column(name)[0].as_py(), kind)
    starts, counts = cell("starts", np.int64), cell("counts", np.uint32)
    parts = numbers.sort_by("bucket").column("ids").to_pylist()
    ids = np.frombuffer(b"".join(parts), np.int64)
    columns, rows = ids[cell("columns", np.uint32)], len(starts) - 1
    row = np.repeat(np.arange(rows), np.diff(starts))
    sums = np.bincount(row, counts, rows).astype(np.int64)
    # entries of one row and one global column are one entry
    order = np.lexsort((columns, row))
    fresh = np.ones(len(row), bool)
    fresh[1:] = (np.diff(columns[order]) != 0) | (np.diff(row[order]) != 0)
    nonzero = np.bincount(row[order][fresh], minlength=rows).astype(np.int64)
    number = np.full(rows, shard.column("shard")[0].as_py())
    return pa.table([number, np.arange(rows, dtype=np.int32), sums, nonzero], schema=COUNTED)


def document_term_counts(docs: DataFrame, scratch: Scratch, part: str = "lang") -> DataFrame:
    """doc_id, part, t1, t2, over_capitals, marked, n_words and n_distinct of every row."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    schema = ", ".join(f"{c} {t}" for c, _, t in MATRIX)
    stored = scratch.table(facts(docs, part).mapInArrow(matrix_rows(buckets), schema), "matrix")
    words = stored.where(F.col("kind") == WORDS).select("shard", "bucket", "words")
    ids = words.groupBy("bucket").applyInArrow(global_numbers(buckets), "shard long, bucket int, ids binary")
    ids = scratch.table(ids, "global-numbers")
    shards = stored.where(F.col("kind") == SHARD).select("shard", "starts", "columns", "counts")
    counted = (
        shards.groupBy("shard")
        .cogroup(ids.groupBy("shard"))
        .applyInArrow(row_counts, "shard long, at int, n_words long, n_distinct long")
    )
    kept = stored.where(F.col("kind") == DOCUMENT).select("shard", "at", "doc_id", "part", "t1", "t2", "over_capitals", "marked")
    return kept.join(counted, ["shard", "at"])


def failures(docs: DataFrame, scratch: Scratch, part: str = "lang") -> DataFrame:
    """doc_id, part and mask (bit k: filter k of FILTERS fails) of every row."""
    counted = document_term_counts(docs, scratch, part)
    least = facts(docs, part).groupBy("t1", "t2").agg(F.min("doc_id").alias("least_id"))
    # written, so that a text with very many copies can be split in the join
    least = scratch.table(least, "least")
    failing = (
        F.col("n_words") < MIN_WORDS,
        100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words"),
        F.col("over_capitals"),
        F.col("marked"),
        F.coalesce(F.col("doc_id") > F.col("least_id"), F.lit(False)),
    )
    mask = sum((F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(failing)), F.lit(0))
    return counted.join(least, ["t1", "t2"]).select("doc_id", "part", mask.alias("mask"))


def steps() -> Column:
    """All orders and steps, as an array of (filter_order, step, bit, earlier)."""
    listed = []
    for order in permutations(range(len(FILTERS))):
        for s, f in enumerate(order):
            name = "".join(FILTERS[k] for k in order)
            earlier = sum(1 << k for k in order[:s])
            listed.append(f"named_struct('filter_order', '{name}', 'step', {s + 1}, 'bit', {1 << f}, 'earlier', {earlier})")
    return F.expr(f"array({', '.join(listed)})")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order and step: see the module's text."""
    scratch = Scratch(docs.sparkSession, "filter-audit")
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    rows = failures(docs, scratch, part).join(marked, F.col("doc_id") == F.col("label_id"), "left")
    found = scratch.table(
        rows.groupBy("part", "mask").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
        ),
        "masks",
    )
    scratch.keep("masks")
    has, before = F.col("mask").bitwiseAND(F.col("s.bit")) != 0, F.col("mask").bitwiseAND(F.col("s.earlier")) != 0
    total = lambda n, condition: F.sum(F.when(condition, F.col(n)).otherwise(F.lit(0))).cast("long")
    orders = 1
    for k in range(2, len(FILTERS) + 1):
        orders *= k
    # a failing document is removed by each of its failed filters in equally many orders
    share = F.col("n") * F.expr(f"{orders} div greatest(bit_count(mask), 1)")
    return (
        found.select("*", F.explode(steps()).alias("s"))
        .groupBy("part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step"))
        .agg(
            total("n", ~has & ~before).alias("kept"),
            total("n", has & ~before).alias("removed"),
            total("n", has & before).alias("redundant"),
            total("n", F.col("mask") == F.col("s.bit")).alias("unique_fails"),
            total("n_good", has & ~before).alias("good_lost"),
            total("n_toxic", has & ~before).alias("toxic_lost"),
            F.sum(F.when(has, share).otherwise(F.lit(0))).cast("long").alias("shapley"),
        )
    )


AUDIT_SQL = r"""
WITH t AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents
), w AS (
    SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY body) AS least_id FROM t
), f AS (
    SELECT doc_id, part,
        (len(words) < 200)::INT
        + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
        + 4 * (100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body))::INT
        + 8 * regexp_matches(body, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > least_id, false)::INT AS mask
    FROM w
), l AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS n_good, sum(coalesce(toxic, 0)) AS n_toxic
    FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask
), letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
    JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
), s AS (
    SELECT filter_order, step::INT AS step, bit,
        (SELECT coalesce(sum(p.bit), 0) FROM letters p WHERE contains(left(filter_order, (step - 1)::INT), p.letter)) AS earlier
    FROM orders, range(1, 6) r(step) JOIN letters ON letter = substr(filter_order, step, 1)
), x AS (
    SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (bit | earlier::INT) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit <> 0 AND mask & earlier::INT = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit <> 0 AND mask & earlier::INT <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit <> 0 AND mask & earlier::INT = 0 THEN n_good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit <> 0 AND mask & earlier::INT = 0 THEN n_toxic ELSE 0 END) AS toxic_lost
    FROM m, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM x
"""
