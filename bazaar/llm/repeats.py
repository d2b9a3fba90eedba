"""Suffix-array dedup: every byte inside a long string that starts anywhere else goes.

1. Distinct texts are written once, bucketed by a 128-bit key with their number of
   copies; no later step shuffles text.
2. Every window (of ``WINDOW`` bytes) belongs to the least hash of the grams inside it.
   Consecutive windows with the same least hash are a piece. Equal windows have
   equal least hashes, so only pieces of one hash can share a window, and counting
   hashes finds the few that matter. Pieces travel as numbers.
3. A piece that occurs twice as a whole is repeated. Pieces that share a hash but
   differ are compared: what two of them can share around the gram of the hash is cut
   out, and of that the Burrows-Wheeler transform and common prefixes
   are built column by column (``columnwise``), in blocks of whole hash groups; a
   window whose suffix shares ``WINDOW`` bytes with a neighbour is repeated.
4. A hash with more than ``GROUP`` different pieces (the edge of a passage that very
   many documents share) is not put into one block: its windows are counted one by
   one, by a 128-bit hash, with map-side sums.
5. Repeated windows are joined into spans per text and cut out.

Defined cases: a null or empty text has no bytes and nothing removed; equal rows are
copies of each other, so each loses all its bytes if it has a window at all; a text
shorter than a window is kept whole; texts of any length are cut into pieces of
bounded length; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.columnwise import repeated_windows
from bazaar.llm.staging import Scratch

WINDOW = 400
GRAM = 128
#: Different pieces of one hash that are compared in one block.
GROUP = 2_000
#: Bytes of pieces in one block.
BLOCK_BYTES = 2 << 20
#: Bytes of texts that are hashed at once.
BATCH_BYTES = 1 << 20
PLACE_BITS = 24

U = np.uint64
MULTIPLIER = U(0x100000001B3)
MIX = U(0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray, gram: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each position that has them."""
    with np.errstate(over="ignore"):
        h = (data.astype(U) + U(1 + seed)) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(31)
        whole, total, power, size = None, 0, MULTIPLIER, 1
        # double the hashed length, and join the doublings that make up ``gram``
        while True:
            if gram & size:
                if whole is None:
                    whole, total = h, size
                else:
                    n = len(data) - total - size + 1
                    whole = whole[: max(n, 0)] * power + h[total : total + max(n, 0)]
                    total += size
            size *= 2
            if size > gram or len(h) <= size // 2:
                break
            h = h[: -(size // 2)] * power + h[size // 2 :]
            power = power * power
        if total < gram:
            return np.zeros(0, U)
        h = whole.copy()
        for _ in range(2):
            h ^= h >> U(32)
            h *= MIX
        h ^= h >> U(29)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def cut_pieces(texts: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """Pieces of all texts: (text, first window in the text, windows, hash, place of its gram in the piece, ties).

    ``ties`` says that the least hash occurs at several places of the piece: only
    then can a piece hold the same window twice.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data) - window + 1
    if n <= 0:
        return [np.zeros(0, np.int64)] * 6
    width = window - gram + 1
    hashes = gram_hashes(data, gram)
    # the place in the low bits makes the leftmost of equal hashes the least
    packed = (hashes >> U(PLACE_BITS) << U(PLACE_BITS)) | np.arange(len(hashes), dtype=U)
    least = sliding_least(packed, width)[:n]
    value = least >> U(PLACE_BITS)
    valid = np.ones(n, bool)
    for end, size in zip(ends.tolist(), lengths.tolist(), strict=True):
        valid[max(end - size, end - window + 1) : end] = False  # windows that leave their text
    changed = np.ones(n, bool)
    changed[1:] = value[1:] != value[:-1]
    after_gap = np.ones(n, bool)
    after_gap[1:] = ~valid[:-1]
    begins = valid & (changed | after_gap)
    edges = np.append(np.flatnonzero(begins | (~valid & ~after_gap)), n)
    run = begins[edges[:-1]]
    first, end = edges[:-1][run], edges[1:][run]
    moved = np.zeros(n + 1, np.int64)
    moved[2:] = np.cumsum((least[1:] != least[:-1]) & ~begins[1:] & valid[1:])
    tie = moved[end] > moved[first + 1]
    parts = -(-(end - first) // width)
    which = np.repeat(np.arange(len(first)), parts)
    offset = (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * width
    start = first[which] + offset
    windows = np.minimum(width, end[which] - start)
    place = (least[first] & ((U(1) << U(PLACE_BITS)) - U(1))).astype(np.int64)
    text = np.searchsorted(ends, start, "right")
    return [
        text,
        start - (ends - lengths)[text],
        windows,
        hashes[place].view(np.int64)[which],
        place[which] - start,
        tie[which] | (parts[which] > 1),
    ]


def in_batches(batches: Iterator[pa.RecordBatch], size_of: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most`` bytes in column ``size_of`` (or one row)."""
    for batch in batches:
        sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(size_of)], np.int64)
        total = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def text_keys(text) -> list:
    data = F.coalesce(text, F.lit(""))
    return [F.xxhash64(data).alias("t1"), F.xxhash64(F.lit("second"), data).alias("t2")]


PIECES = "t1 long, t2 long, start long, windows long, m long, place long, d1 long, d2 long, tie boolean, n long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_batches(batches, 2, BATCH_BYTES):
        texts = batch.column(2).to_pylist()
        # one text beyond the batch size is hashed by itself, in overlapping parts
        for part, shift, rows in _parts(texts):
            text, start, windows, m, place, tie = cut_pieces(part)
            d1, d2 = (np.empty(len(text), np.uint64) for _ in range(2))
            for k, (t, s, w) in enumerate(zip(text.tolist(), start.tolist(), windows.tolist(), strict=True)):
                piece = part[t][s : s + w + WINDOW - 1]
                d1[k], d2[k] = xxhash.xxh3_64_intdigest(piece), xxhash.xxh3_64_intdigest(piece, 1)
            row = pa.array(rows[text], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row), batch.column(1).take(row), pa.array(start + shift), pa.array(windows),
                    pa.array(m), pa.array(place), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(tie.astype(bool)),
                    batch.column(3).take(row),
                ],
                names=["t1", "t2", "start", "windows", "m", "place", "d1", "d2", "tie", "n"],
            )


def _parts(texts: list[bytes]):
    """(texts, their first byte, their rows): one batch, or a long text's parts that share WINDOW - 1 bytes."""
    if len(texts) > 1 or len(texts[0]) <= BATCH_BYTES:
        yield texts, 0, np.arange(len(texts))
        return
    for s in range(0, len(texts[0]) - WINDOW + 1, BATCH_BYTES):
        yield [texts[0][s : s + BATCH_BYTES + WINDOW - 1]], s, np.zeros(1, np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (t1, t2, body, wanted pieces) to rows of pieces with their bytes."""
    for batch in batches:
        t1, t2 = np.asarray(batch.column("t1")), np.asarray(batch.column("t2"))
        for k in range(batch.num_rows):
            body = batch.column("body")[k].as_buffer()
            want = batch.column("want")[k].as_py()
            cols = {c: [w[c] for w in want] for c in ("start", "windows", "m", "place", "tie", "single", "hot")}
            data = [
                body.slice(s, n + WINDOW - 1).to_pybytes() for s, n in zip(cols["start"], cols["windows"], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(want), t1[k])), pa.array(np.full(len(want), t2[k])),
                    pa.array(cols["start"], pa.int64()), pa.array(cols["m"], pa.int64()),
                    pa.array(cols["place"], pa.int64()), pa.array(cols["tie"], pa.bool_()),
                    pa.array(cols["single"], pa.bool_()), pa.array(cols["hot"], pa.bool_()), pa.array(data, pa.binary()),
                ],
                names=["t1", "t2", "start", "m", "place", "tie", "single", "hot", "bytes"],
            )


def _spans_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _span_batch(t1: list, t2: list, begin: list, end: list) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.int64()) for c in (t1, t2, begin, end)]
    return pa.RecordBatch.from_arrays(arrays, names=["t1", "t2", "begin", "end"])


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


def _most_shared(texts: list[bytes]) -> list[int]:
    """For each text the longest prefix that it shares with another: with a neighbour in order."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    most = [0] * len(texts)
    for i, j in zip(order, order[1:], strict=False):
        n = _shared(texts[i], texts[j])
        most[i], most[j] = max(most[i], n), max(most[j], n)
    return most


def _trimmed(group: list[tuple]) -> list[tuple]:
    """The parts of a hash group's pieces that can hold a shared window.

    Two pieces that share a window agree around the gram, to its left and to its
    right. What no other piece shares is cut off; a piece that is left with less than
    a window is dropped: nothing can match it.
    """
    if any(row["tie"] for row in group):
        return [(row["t1"], row["t2"], row["start"], row["single"], row["bytes"]) for row in group]
    left = _most_shared([row["bytes"][: row["place"]][::-1] for row in group])
    right = _most_shared([row["bytes"][row["place"] + GRAM :] for row in group])
    out = []
    for row, before, after in zip(group, left, right, strict=True):
        first = row["place"] - before
        body = row["bytes"][first : row["place"] + GRAM + after]
        if len(body) >= WINDOW:
            out.append((row["t1"], row["t2"], row["start"] + first, row["single"], body))
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by hash to spans of repeated windows, in blocks of whole hash groups."""
    held: list[tuple] = []
    group: list[dict] = []
    size = 0

    def flush() -> pa.RecordBatch:
        lengths = np.array([len(r[4]) for r in held], np.int64)
        found = repeated_windows(b"".join(r[4] for r in held), np.cumsum(lengths) - lengths, lengths, WINDOW)
        out: tuple[list, list, list, list] = ([], [], [], [])
        for (t1, t2, start, single, _), marks in zip(held, found, strict=True):
            if single:
                for a, b in zip(*(x.tolist() for x in _spans_of(marks)), strict=True):
                    for column, value in zip(out, (t1, t2, start + a, start + b - 1 + WINDOW), strict=True):
                        column.append(value)
        return _span_batch(*out)

    for batch in batches:
        for row in batch.select(["t1", "t2", "start", "m", "place", "tie", "single", "bytes"]).to_pylist():
            if group and row["m"] != group[0]["m"]:
                parts, group = _trimmed(group), []
                held += parts
                size += sum(len(part[4]) for part in parts)
                if size > BLOCK_BYTES:
                    yield flush()
                    held, size = [], 0
            group.append(row)
    held += _trimmed(group) if group else []
    if held:
        yield flush()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of pieces, by a 128-bit hash of its bytes."""
    for batch in batches:
        for k in range(batch.num_rows):
            data = np.frombuffer(batch.column("bytes")[k].as_buffer(), np.uint8)
            h1, h2 = gram_hashes(data, WINDOW), gram_hashes(data, WINDOW, 77)
            start = batch.column("start")[k].as_py()
            constant = [np.full(len(h1), batch.column(c)[k].as_py()) for c in ("t1", "t2")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), *map(pa.array, constant),
                    pa.array(start + np.arange(len(h1))), pa.array(np.full(len(h1), batch.column("single")[k].as_py())),
                ],
                names=["h1", "h2", "t1", "t2", "at", "single"],
            )


RESULT = "t1 long, t2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for body, spans in zip(batch.column("body"), batch.column("spans"), strict=True):
            data = np.frombuffer(body.as_buffer(), np.uint8)
            change = np.zeros(len(data) + 1, np.int64)
            if spans.is_valid and len(spans):
                flat = spans.values
                np.add.at(change, np.asarray(flat.field("begin")), 1)
                np.add.at(change, np.asarray(flat.field("end")), -1)
            gone = np.cumsum(change[:-1]) > 0
            n = int(gone.sum())
            kept = data[~gone] if n else data
            rows.append((len(data), n, len(_spans_of(gone)[0]), hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        types = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("t1"), batch.column("t2"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]],
            names=["t1", "t2", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and whether any byte went, of every row of ``docs``."""
    assert WINDOW % 8 == 0
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_keys(F.col("text")), "text")

    # 1. distinct texts, bucketed
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    once = rows.groupBy("t1", "t2").agg(
        F.first(F.coalesce("text", F.lit(""))).cast("binary").alias("body"), F.count(F.lit(1)).alias("n")
    )
    texts = scratch.bucketed(once, "texts", "t1", "t2")

    # 2. pieces as numbers, and the hashes that more than one window can share
    cut = scratch.table(texts.select("t1", "t2", "body", "n").mapInArrow(_pieces, PIECES), "pieces")
    shared = (
        cut.groupBy("m")
        .agg(F.sum("n").alias("total"), F.max("tie").alias("ties"), (F.min("d1") != F.max("d1")).alias("differ"))
        .where("total > 1 OR ties")
        .select("m", (F.col("differ") | F.col("ties")).alias("open"))
    )
    # written before they are joined, so that a very common hash can be split
    found = scratch.table(cut.join(scratch.table(shared, "hashes"), "m"), "shared")
    scratch.drop("pieces")

    # 3. whole pieces that occur twice; the others of an open hash are compared
    distinct = scratch.table(
        found.where("open")
        .groupBy("m", "d1", "d2")
        .agg(
            F.sum("n").alias("occurs"), F.max("tie").alias("tie"), F.first("t1").alias("t1"), F.first("t2").alias("t2"),
            F.first("start").alias("start"), F.first("windows").alias("windows"), F.first("place").alias("place"),
        ),
        "distinct",
    )
    groups = (
        distinct.groupBy("m")
        .agg(F.count(F.lit(1)).alias("different"), F.min("occurs").alias("least"), F.max("tie").alias("ties"))
        .where("least = 1 AND (different > 1 OR ties)")
        .select("m", (F.col("different") > GROUP).alias("hot"))
    )
    wanted = distinct.join(scratch.table(groups, "groups"), "m").select(
        "t1", "t2", F.struct("start", "windows", "m", "place", "tie", (F.col("occurs") == 1).alias("single"), "hot").alias("want")
    )
    per_text = wanted.groupBy("t1", "t2").agg(F.collect_list("want").alias("want"))  # at most the pieces of one text
    slices = texts.select("t1", "t2", "body").join(per_text, ["t1", "t2"]).mapInArrow(
        _slices, "t1 long, t2 long, start long, m long, place long, tie boolean, single boolean, hot boolean, bytes binary"
    )
    slices = scratch.table(slices, "slices")
    grouped = slices.where("NOT hot").repartition(buckets, "m").sortWithinPartitions("m")
    spans = "t1 long, t2 long, begin long, end long"
    compared = scratch.table(grouped.mapInArrow(_compare, spans), "compared")

    # 4. hashes with very many different pieces: window by window
    each = slices.where("hot").mapInArrow(
        _windows, "h1 long, h2 long, t1 long, t2 long, at long, single boolean"
    )
    each = scratch.table(each, "windows")
    often = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c"), F.count_if(~F.col("single")).alias("w"))
    often = often.where("c > 1 OR w > 0").select("h1", "h2")
    counted = each.where("single").join(often, ["h1", "h2"]).select(
        "t1", "t2", F.col("at").alias("begin"), (F.col("at") + WINDOW).alias("end")
    )

    # 5. spans per text, and the cut
    whole = found.where("NOT open").select("t1", "t2", "start", "windows").union(
        found.where("open")
        .join(distinct.where("occurs > 1").select("m", "d1", "d2"), ["m", "d1", "d2"])
        .select("t1", "t2", "start", "windows")
    ).select("t1", "t2", F.col("start").alias("begin"), (F.col("start") + F.col("windows") - 1 + WINDOW).alias("end"))
    per_text = (
        whole.union(compared).union(counted).groupBy("t1", "t2")
        .agg(F.collect_list(F.struct("begin", "end")).alias("spans"))  # at most the windows of one text
    )
    results = texts.select("t1", "t2", "body").join(per_text, ["t1", "t2"], "left").mapInArrow(_cut_out, RESULT)
    results = scratch.table(results, "results")
    scratch.keep("results")
    return rows.select("doc_id", "t1", "t2").join(results, ["t1", "t2"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("lost_bytes")
    )
