"""SimHash near-dedup by a generalised pigeonhole search.

1. Fingerprints: whole text, A-Z lower-cased, words, shingles (repeats included),
   XXH64 of each shingle; a bit is set if it is set in over half of the hashes.
2. Distinct fingerprints only: equal ones are one node, so a group of copies of
   any size is one row.
3. Hub links: within each partition value, every fingerprint is compared with
   three hubs (least, greatest, least mixed value). This needs aggregates alone and joins most of a
   dense group without its pairs.
4. Search: bits are grouped into partitions by correlation. A fingerprint gets a
   threshold per partition, minus one at least, with sum(t + 1) = distance + 1; a
   pair within the distance then agrees within t bits in some partition. A dynamic
   program picks the thresholds by estimated candidates. The fingerprint probes
   all values within its threshold; pairs that hub links have joined already are
   passed over, the others are verified by their distance.
5. Components over all links.

Defined cases: a null, empty or blank text has fingerprint zero, linked like any
other; fewer words than a shingle are one shingle; rows with a null doc_id get a
fingerprint, and a component id from the non-null ids of their group (null if
there is none); repeated rows are repeated in the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.components import connected_components
from bazaar.llm.staging import Scratch, pick_rows

BITS = 64
PARTITIONS = 3
SEED = 42
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit SimHash of a UTF-8 text."""
    words = (text or b"").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    last = ends[shingle - 1 :] - 1 if len(words) >= shingle else ends[-1:] - 1
    hashing = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        pairs = zip(starts[at : at + CHUNK].tolist(), last[at : at + CHUNK].tolist(), strict=False)
        hashes = np.array([hashing(joined[a:b], SEED) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for row in range(0, len(bits), 255):  # sums of at most 255 fit into a byte
            ones += np.add.reduce(bits[row : row + 255], axis=0, dtype=np.uint8)
    packed = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash and fp of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(2).cast(pa.binary())
            fp = [fingerprint(x.as_py(), shingle) for x in text]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fp, pa.int64())], names=["doc_id", "text_hash", "fp"]
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return slim.mapInArrow(run, "doc_id long, text_hash long, fp long")


# -- partitions --------------------------------------------------------------


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        fp = np.asarray(batch.column(0)).astype("<i8")
        bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
        both += (bits.T @ bits).astype(np.int64)
    i, j = np.triu_indices(BITS)
    yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(both[i, j])], names=["i", "j", "n"])


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, share of ones by bit, and correlation of bits, over all fingerprints."""
    rows = nodes.select("fp").mapInArrow(_bit_counts, "i long, j long, n long")
    both = np.zeros((BITS, BITS))
    for i, j, n in rows.groupBy("i", "j").agg(F.sum("n")).collect():  # 2,080 rows
        both[i, j] = both[j, i] = n
    total = nodes.count()
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    corr = (both / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    return total, share, np.abs(corr)


def group_bits(corr: np.ndarray, parts: int) -> list[np.ndarray]:
    """Bits in ``parts`` groups of near-equal size, correlated bits together."""
    left = set(range(BITS))
    groups = []
    for k in range(parts):
        room = BITS // parts + (k < BITS % parts)
        rest = sorted(left)
        sub = corr[np.ix_(rest, rest)]
        group = [rest[int(sub.sum(1).argmax())]]
        while len(group) < room:
            near = [(-corr[b, group].mean(), b) for b in left.difference(group)]
            group.append(min(near)[1])
        left -= set(group)
        groups.append(np.array(sorted(group)))
    return groups


def masks_within(bits: np.ndarray, distance: int) -> list[np.ndarray]:
    """For each e up to ``distance``, the masks with exactly e of ``bits`` set (as int64)."""
    one = [np.uint64(1) << np.uint64(b) for b in bits]
    out = []
    for e in range(distance + 1):
        sums = [np.bitwise_or.reduce(np.array(c, np.uint64)) if c else np.uint64(0) for c in combinations(one, e)]
        out.append(np.array(sums, np.uint64).view(np.int64))
    return out


def distance_tail(share: np.ndarray, fp: np.ndarray, bits: np.ndarray, distance: int) -> np.ndarray:
    """P(a random row differs from each fp in exactly e of ``bits``), e = 0..distance, bits taken as independent."""
    p = np.zeros((len(fp), distance + 1))
    p[:, 0] = 1
    for b in bits:
        one = (fp.view(np.uint64) >> np.uint64(b)) & np.uint64(1)
        differs = np.where(one == 1, 1 - share[b], share[b])[:, None]
        moved = np.concatenate([np.zeros((len(fp), 1)), p[:, :-1]], 1)
        p = p * (1 - differs) + moved * differs
    return p


def allocate(cost: np.ndarray) -> np.ndarray:
    """Thresholds per row and partition of least total cost.

    ``cost[r, i, t]`` is the cost of giving partition i of row r the threshold
    t - 1 (t = 0: the partition is not probed). The t of a row sum to the last t.
    """
    rows, parts, size = cost.shape
    best = np.full((rows, size), np.inf)
    best[:, 0] = 0
    came = np.zeros((parts, rows, size), np.int64)
    for i in range(parts):
        options = np.full((rows, size, size), np.inf)
        for t in range(size):
            options[:, t:, t] = best[:, : size - t] + cost[:, i, t : t + 1]
        came[i] = options.argmin(2)
        best = options.min(2)
    picked = np.zeros((rows, parts), np.int64)
    at = np.full(rows, size - 1)
    for i in reversed(range(parts)):
        picked[:, i] = came[i, np.arange(rows), at]
        at -= picked[:, i]
    return picked - 1


# -- links -------------------------------------------------------------------


def _signed(mask: np.ndarray) -> int:
    return int(np.bitwise_or.reduce(np.uint64(1) << mask.astype(np.uint64)).view(np.int64))


def near_links(nodes: DataFrame, distance: int, scratch: Scratch, parts: int = PARTITIONS) -> DataFrame:
    """Links (a, b) of distinct fingerprints, enough to join all pairs within ``distance``."""
    total, share, corr = bit_statistics(nodes)
    groups = group_bits(corr, parts)
    part_masks = [_signed(g) for g in groups]
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance

    # the index: one row per fingerprint and partition
    index = nodes.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
                    for i, m in enumerate(part_masks)
                ]
            )
        ).alias("k"),
    ).select("fp", "k.part", "k.value")
    sizes = index.groupBy("part", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("fp").alias("h0"),
        F.max("fp").alias("h1"),
        F.min_by("fp", F.xxhash64("fp")).alias("h2"),
    )
    # written before they are joined, so that a dense value can be split
    sizes = scratch.table(sizes.where("n > 1"), "sizes")
    counted = scratch.table(index.join(sizes, ["part", "value"], "left"), "counted")
    hubs = counted.where("n > 1").select("fp", F.explode(F.array("h0", "h1", "h2")).alias("hub"))
    hub_links = scratch.table(hubs.where((F.col("fp") != F.col("hub")) & close("fp", "hub")).distinct(), "hubs")
    first = connected_components(hub_links.select(F.col("fp").alias("a"), F.col("hub").alias("b")), scratch, "hub-cc")
    labelled = scratch.table(
        counted.groupBy("fp")
        .agg(*[F.max(F.when(F.col("part") == i, F.coalesce("n", F.lit(1)))).alias(f"n{i}") for i in range(parts)])
        .join(first.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp")),
        "labelled",
    )
    masks = [masks_within(g, distance) for g in groups]

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(s, 2048) for s in range(0, whole.num_rows, 2048)):
                fp = np.asarray(batch.column("fp"))
                comp = np.asarray(batch.column("component"))
                cost = np.zeros((len(fp), parts, distance + 2))
                for i, g in enumerate(groups):
                    tail = distance_tail(share, fp, g, distance)
                    same = np.asarray(batch.column(f"n{i}")).astype(float)
                    for e in range(distance + 1):
                        # exact for equal values, estimated for those around; a probe costs about a candidate
                        cost[:, i, e + 1] = (
                            same + total * tail[:, 1 : e + 1].sum(1) + sum(len(m) for m in masks[i][: e + 1])
                        )
                given = allocate(cost)
                for i in range(parts):
                    for e in range(distance + 1):
                        take = given[:, i] >= e
                        if take.any():
                            f = fp[take]
                            around = ((f & part_masks[i])[:, None] ^ masks[i][e][None, :]).ravel()
                            each = len(masks[i][e])
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(np.full(len(around), i, np.int32)),
                                    pa.array(around),
                                    pa.array(np.repeat(f, each)),
                                    pa.array(np.repeat(comp[take], each)),
                                ],
                                names=["part", "value", "q", "qc"],
                            )

    asked = labelled.mapInArrow(probes, "part int, value long, q long, qc long")
    data = labelled.select(
        "fp",
        "component",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
                    for i, m in enumerate(part_masks)
                ]
            )
        ).alias("k"),
    ).select("k.part", "k.value", "fp", "component")
    # probes of a value that only the asker's own component holds are passed over before the pairs are looked at
    held = data.groupBy("part", "value").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
    held = scratch.table(held, "held")
    open_probes = scratch.table(
        asked.join(held, ["part", "value"]).where("c0 <> c1 OR c0 <> qc").select("part", "value", "q", "qc"), "probes"
    )
    pairs = (
        open_probes.join(data, ["part", "value"])
        .where((F.col("qc") != F.col("component")) & close("q", "fp"))
        .select(F.least("qc", "component").alias("a"), F.greatest("qc", "component").alias("b"))
        .distinct()
    )
    return hub_links.select(F.col("fp").alias("a"), F.col("hub").alias("b")).union(pairs)


def near_duplicate_groups(docs: DataFrame, shingle: int = 3, distance: int = 3, parts: int = PARTITIONS) -> DataFrame:
    """doc_id, text_hash, fp and component_id (smallest doc_id reachable) of every row."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.table(fingerprints(docs, shingle), "rows")
    nodes = scratch.table(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    groups = connected_components(near_links(nodes, distance, scratch, parts), scratch, "cc")
    labelled = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_fp = scratch.table(labelled.join(least, "component").select("fp", "component_id"), "by-fp")
    scratch.keep("rows", "by-fp")
    return rows.join(by_fp, "fp")


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs``."""
    return near_duplicate_groups(docs, shingle, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id.

    Of several rows with that id in the group, the one with the smallest text hash
    stays. A group of rows without any doc_id keeps its first text.
    """
    groups = near_duplicate_groups(docs, shingle, distance)
    # a group without ids is told apart by its fingerprint's least text hash
    named = groups.where("component_id IS NOT NULL AND doc_id = component_id")
    kept = named.groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"))
    nameless = groups.where("component_id IS NULL").groupBy("doc_id", "fp").agg(F.min("text_hash").alias("text_hash"))
    return pick_rows(docs, kept.unionByName(nameless.select("doc_id", "text_hash")))
