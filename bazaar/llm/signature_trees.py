"""N-gram Jaccard join with signature trees.

A document's set is its distinct word shingles, as 64-bit hashes. Two sets link when their
Jaccard similarity is at least ``PERCENT`` hundredths. Equal sets are one node.

1. Order of shingles: frequent ones last, by hash otherwise. Frequencies are counted over all
   documents, packed by hash bucket; of the most frequent shingles a bounded list is broadcast.
   Any common order is right, so a shingle that the list lacks costs time, not links.
2. A set of n shingles has a prefix: its first n - ceil(0.8 n) + 1 in that order. Sets
   that link share a shingle of both prefixes, so every shingle that several prefixes hold
   is the root of a signature tree over those sets.
3. Near copies are linked first: each set is compared with the least set of equal min-hash, then
   each component at a root with the root's least component (no more pairs than sets). Roots
   whose sets are all connected by then are passed over.
4. In a tree the sets are leaves, ordered by size and component; a node holds the
   OR of its sets' bitmaps, their range of sizes, their greatest remainder (shingles from
   the root's on) and excess (shingles less bits), and their range of components. Pairs of nodes are
   traversed from the root down. A pair is pruned if the greatest overlap that bitmaps, sizes
   and remainders allow is less than its least sizes need, or if it is one component.
   A root of over ``CHUNK`` sets is cut into chunks by size, which are nodes of the upper
   level: pairs of chunks are pruned first, and each that is left is a traversal of its own.
   A set brings the ``EARLIER`` live roots of its prefix that come last before this one: a pair that
   has one of them in common has been put out there, or at a root before it, and is not repeated.
5. Surviving pairs, of large sets those that a wider bitmap leaves, are verified by their texts: first one pair for every two components,
   then all whose components are still different. Components over all links.

Defined cases: a null, empty or blank text has an empty set, links with nothing and is its own
component; fewer words than a shingle are one shingle. Rows with a null doc_id take the
least id of their component, null if it has none. Repeated rows are repeated in the
result. Texts of any length are whole. Extra columns are not read.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.components import connected_components
from bazaar.llm.staging import Scratch

SHINGLE = 5
PERCENT = 80
#: Shingles of more sets than this come last in the order.
FREQUENT = 64
#: At most so many of them are broadcast (8 bytes each); the bound of frequency is doubled until they fit.
MOST_FREQUENT = 1 << 20
#: Words of a signature's bitmap.
BITMAP = 32
#: Words of the bitmap that pairs of sets of over so many shingles are looked at by before their texts are.
WIDE, LARGE_SET = 256, 1_000
#: Children of a tree's node, and sets that one traversal takes from each side.
FANOUT = 8
CHUNK = 1_024
#: Live roots of a set's prefix that are looked at, so that near copies are not put out at every root.
EARLIER = 8
#: Min-hashes of a set that near copies are first looked up by.
MIN_HASHES = 3
#: Bytes of text that are handled at once, and shingles of one counting bucket.
BATCH_BYTES = 2 << 20
BUCKET_SHINGLES = 2_000_000

U = np.uint64
HALF = U(1) << U(63)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
        h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Words of up to so many bytes are hashed together, longer ones by themselves.
SHORT_WORD = 64
_BYTE = _mixed(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_POWER = np.array([pow(0xD1342543DE82EF95, k, 1 << 64) for k in range(SHORT_WORD)], U)
#: Bytes whose words are hashed at once; a longer text is cut at blanks.
BLOCK_BYTES = 2 << 20


def _block_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of the words of one block, A-Z lower-cased."""
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, U), starts
    size = ends - starts
    first = np.cumsum(size) - size
    letters = _LOWER[data[~blank]]
    at = np.arange(len(letters)) - np.repeat(first, size)
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_BYTE[letters] * _POWER[np.minimum(at, SHORT_WORD - 1)], first)
        for k in np.flatnonzero(size > SHORT_WORD).tolist():
            h[k] = xxhash.xxh3_64_intdigest(letters[first[k] : first[k] + size[k]].tobytes())
        return _mixed(h + size.astype(U) * U(0x9E3779B97F4A7C15)), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word: runs of anything but ASCII white space."""
    whole, at, found = np.frombuffer(data, np.uint8), 0, []
    while at < len(whole):
        end = at + BLOCK_BYTES
        while end < len(whole) and not _BLANK[whole[end]]:
            end += 1  # the block ends where a word does
        h, starts = _block_words(whole[at:end])
        found.append((h, starts + at))
        at = end
    if not found:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate([h for h, _ in found]), np.concatenate([x for _, x in found])


def _combined(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` neighbours."""
    n = max(len(words) - size + 1, 0)
    with np.errstate(over="ignore"):
        h = np.full(n, U(size))  # a whole short text is no shingle of another length
        for k in range(size):
            h = _mixed(h * U(0x9E3779B97F4A7C15) + words[k : k + n])
    return h


def shingles(texts: list[bytes | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Shingle hashes of each UTF-8 text, in order and repeats included."""
    given = [t or b"" for t in texts]
    h, starts = word_hashes(b"\n".join(given))
    ends = np.cumsum([len(t) + 1 for t in given])
    last = np.searchsorted(starts, ends)  # words before the end of each text
    every, out, first = _combined(h, size), [], 0
    for e in last.tolist():
        n = e - first
        out.append(every[first : e - size + 1] if n >= size else _combined(h[first:e], n) if n else np.zeros(0, U))
        first = e
    return out


def batches_of(batches: Iterator[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of about ``most`` bytes of column ``text`` (or one row), and their texts."""
    for batch in batches:
        body = batch.column("text").cast(pa.large_binary())
        total, at = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(body), 0))), 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at), body.slice(at, end - at).to_pylist()
            at = end


# -- frequent shingles -----------------------------------------------------------


def frequent_shingles(docs: DataFrame, scratch: Scratch, shingle: int, more_than: int = FREQUENT) -> tuple[np.ndarray, int]:
    """The first 32 + k bits of shingles found more than ``more_than`` times, ascending, and k.

    Only shingles of the lower half of all hashes are counted: the others come late in the
    order by themselves.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, int(np.ceil(np.log2(max(size / 12 / BUCKET_SHINGLES, 1)))))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in batches_of(batches):
            found = np.concatenate(shingles(texts, shingle))
            cut, times = np.unique(found[found < HALF] >> U(32 - bits), return_counts=True)
            edges = np.searchsorted(cut >> U(32), np.arange((1 << bits) + 1).astype(U))
            held = np.flatnonzero(np.diff(edges))
            low, many = (cut & U(0xFFFFFFFF)).astype(np.uint32), times > 1
            part = lambda b: slice(edges[b], edges[b + 1])  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(held.astype(np.int32)),
                    pa.array([low[part(b)].tobytes() for b in held], pa.binary()),
                    # most occur once in a batch: only other counts are stated
                    pa.array([np.flatnonzero(many[part(b)]).astype(np.uint32).tobytes() for b in held], pa.binary()),
                    pa.array([times[part(b)][many[part(b)]].astype(np.int64).tobytes() for b in held], pa.binary()),
                ],
                names=["bucket", "low", "at", "times"],
            )

    def frequent(group: pa.Table) -> pa.Table:
        lows, times = [], []
        for k in range(group.num_rows):
            cell = lambda name, kind: np.frombuffer(group.column(name)[k].as_py(), kind)  # noqa: E731, B023
            lows.append(cell("low", np.uint32))
            n = np.ones(len(lows[-1]), np.int64)
            n[cell("at", np.uint32)] = cell("times", np.int64)
            times.append(n)
        low, which = np.unique(np.concatenate(lows), return_inverse=True)
        total = np.bincount(which, np.concatenate(times), len(low)).astype(np.int64)
        often = total > more_than
        first = int(group.column("bucket")[0].as_py()) << 32
        return pa.table({"cut": low[often].astype(np.int64) + first, "n": total[often]})

    packed = docs.select("text").mapInArrow(counted, "bucket int, low binary, at binary, times binary")
    found = scratch.table(packed.groupBy("bucket").applyInArrow(frequent, "cut long, n long"), "frequent")
    classes = found.groupBy(F.floor(F.log2("n")).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()  # 63 rows at most
    least, room = 0, MOST_FREQUENT
    for c, n in sorted(((r.c, r.n) for r in classes), reverse=True):
        room -= n
        if room < 0:
            least = 1 << (c + 1)
            break
    cuts = np.array([r.cut for r in found.where(F.col("n") >= least).select("cut").collect()], np.int64)
    return np.sort(cuts).astype(U), bits


# -- nodes -----------------------------------------------------------------------


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def bitmap(tokens: np.ndarray, words: int = BITMAP) -> np.ndarray:
    bits = np.zeros(words * 64, bool)
    bits[(tokens % U(words * 64)).astype(np.int64)] = True
    return np.packbits(bits).view(U)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


SETS = (
    "doc_id long, t1 long, t2 long, k1 long, k2 long, n long, prefix array<long>, late int, "
    "bits binary, wide binary, mins array<long>"
)


def sets_of(docs: DataFrame, frequent: np.ndarray, cut_bits: int, shingle: int) -> DataFrame:
    """One row per row: the set's key, size, prefix in order (the last ``late`` of it frequent), bitmap and min-hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    odd = [U((2 * k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for k in range(1, MIN_HASHES + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch, texts in batches_of(batches):
            sets = [np.unique(x) for x in shingles(texts, shingle)]
            sizes = np.array([len(x) for x in sets], np.int64)
            starts = np.cumsum(sizes) - sizes
            every = np.concatenate(sets)
            late = every >= HALF
            if len(often):
                cut = every >> U(32 - cut_bits)
                late |= often[np.minimum(np.searchsorted(often, cut), len(often) - 1)] == cut
            mins = np.zeros((len(sets), MIN_HASHES), np.int64)
            if len(every):
                for k, o in enumerate(odd):
                    mins[sizes > 0, k] = signed(np.minimum.reduceat(_mixed(every ^ o), starts[sizes > 0]))
            prefix, rest, bits, wide, keys = [], [], [], [], []
            for x, at, n in zip(sets, starts.tolist(), sizes.tolist(), strict=True):
                keys.append(xxhash.xxh3_128_digest(x.tobytes()))
                behind = late[at : at + n]
                take = prefix_length(n) if n else 0
                first = x[~behind][:take]
                after = x[behind][: take - len(first)]
                prefix.append(signed(np.concatenate((first, after))))
                rest.append(len(after))
                bits.append(bitmap(x).tobytes())
                wide.append(bitmap(x, WIDE).tobytes() if n > LARGE_SET else None)
            key = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            ends = np.arange(len(sets) + 1, dtype=np.int32) * MIN_HASHES
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", "t1", "t2")], pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy()),
                    pa.array(sizes), pa.array(prefix, pa.list_(pa.int64())), pa.array(rest, pa.int32()), pa.array(bits, pa.binary()),
                    pa.array(wide, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(mins.ravel())),
                ],
                names=[f.split()[0] for f in SETS.split(", ")],
            )

    keyed = docs.select("doc_id", "t1", "t2", "text")
    return keyed.mapInArrow(run, SETS)


# -- signature trees ---------------------------------------------------------------


class Nodes:
    """Nodes of one level: OR of bitmaps, ranges of sizes and components, greatest remainder and excess."""

    def __init__(self, bits, low, high, rest, excess, c0, c1):
        self.bits, self.low, self.high, self.rest, self.excess, self.c0, self.c1 = bits, low, high, rest, excess, c0, c1

    @classmethod
    def of_sets(cls, bits, n, rest, component) -> "Nodes":
        return cls(bits, n, n, rest, n - np.bitwise_count(bits).sum(1, dtype=np.int64), component, component)

    def __len__(self) -> int:
        return len(self.low)

    def parents(self, starts: np.ndarray) -> "Nodes":
        over = lambda f, x: f.reduceat(x, starts, axis=0)
        return Nodes(
            over(np.bitwise_or, self.bits), over(np.minimum, self.low), over(np.maximum, self.high), over(np.maximum, self.rest),
            over(np.maximum, self.excess), over(np.minimum, self.c0), over(np.maximum, self.c1),
        )


def possible(a: Nodes, i: np.ndarray, b: Nodes, j: np.ndarray, sets: bool = False) -> np.ndarray:
    """Whether some set below node i of ``a`` may link with one below node j of ``b`` and is not connected with it."""
    least = a.low[i] + b.low[j]
    most = np.minimum(np.minimum(a.high[i], b.high[j]), np.minimum(a.rest[i], b.rest[j]))
    one = (a.c0[i] == a.c1[i]) & (b.c0[j] == b.c1[j]) & (a.c0[i] == b.c0[j])
    # overlap o links sizes x and y if 100 o >= PERCENT (x + y - o)
    keep = ~one & ((100 + PERCENT) * most >= PERCENT * least)
    k = np.flatnonzero(keep)
    x, y = a.bits[i[k]], b.bits[j[k]]
    common = np.bitwise_count(x & y).sum(1, dtype=np.int64)
    most = np.minimum(most[k], common + np.minimum(a.excess[i[k]], b.excess[j[k]]))
    if sets:  # a bit that only one of them has is a shingle that the other lacks
        most = np.minimum(most, a.low[i[k]] - (np.bitwise_count(x).sum(1, dtype=np.int64) - common))
        most = np.minimum(most, b.low[j[k]] - (np.bitwise_count(y).sum(1, dtype=np.int64) - common))
    keep[k] = (100 + PERCENT) * most >= PERCENT * least[k]
    return keep


def tree(leaves: Nodes, fanout: int = FANOUT) -> list[tuple[Nodes, np.ndarray]]:
    """Levels from the leaves up: nodes, and the first child of each (and an end)."""
    levels = [(leaves, np.zeros(0, np.int64))]
    while len(levels[-1][0]) > 1:
        below = levels[-1][0]
        starts = np.arange(0, len(below), fanout)
        levels.append((below.parents(starts), np.append(starts, len(below))))
    return levels


def traverse(left: Nodes, right: Nodes | None = None, fanout: int = FANOUT, most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves (of one tree, i < j, or of two) that no bound rules out, level by level from the roots."""
    a = tree(left, fanout)
    b = tree(right, fanout) if right is not None else a
    depth = max(len(a), len(b)) - 1
    for levels in (a, b):  # trees of unlike height: the lower one's root stands in the levels above
        while len(levels) <= depth:
            levels.append((levels[-1][0], np.arange(len(levels[-1][0]) + 1)))
    stack = [(depth, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, i, j = stack.pop()
        keep = possible(a[level][0], i, b[level][0], j, sets=level == 0)
        if level == 0 and right is None:
            keep &= i < j
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if level == 0:
            yield i, j
            continue
        (_, ca), (_, cb) = a[level], b[level]
        wide, high = ca[i + 1] - ca[i], cb[j + 1] - cb[j]
        each = wide * high
        pair = np.repeat(np.arange(len(i)), each)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        x, y = ca[i][pair] + k // high[pair], cb[j][pair] + k % high[pair]
        if right is None:
            x, y = x[x <= y], y[x <= y]
        for at in range(0, len(x), most):
            stack.append((level - 1, x[at : at + most], y[at : at + most]))


def _nodes(t: pa.Table) -> Nodes:
    bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), U).reshape(-1, BITMAP)
    return Nodes.of_sets(bits, *(np.asarray(t.column(c)) for c in ("n", "rest", "component")))


def _ordered(t: pa.Table) -> pa.Table:
    return t.sort_by([("n", "ascending"), ("component", "ascending"), ("id", "ascending")])


def _earlier(t: pa.Table) -> np.ndarray:
    """Roots before this one, ``EARLIER`` a row; 0 is none."""
    return np.asarray(pc.list_flatten(t.column("earlier"))).reshape(-1, EARLIER)


def _first_time(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i of ``x`` and j of ``y`` have no earlier root in common."""
    fresh = np.ones(len(i), bool)
    for k in range(EARLIER):
        one = x[i, k]
        fresh &= ~((one[:, None] == y[j]) & (one != 0)[:, None]).any(1)
    return fresh


PAIRS = "a long, b long, ca long, cb long, apart long"


def _batch(left: pa.Table, right: pa.Table, x: Nodes, y: Nodes, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Pairs of rows with their components (ca < cb) and number of bits that only one of them has."""
    ids, other = np.asarray(left.column("id"))[i], np.asarray(right.column("id"))[j]
    apart = np.bitwise_count(x.bits[i] ^ y.bits[j]).sum(1, dtype=np.int64)
    ca, cb = x.c0[i], y.c0[j]
    columns = (ids, other, np.minimum(ca, cb), np.maximum(ca, cb), apart)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "ca", "cb", "apart"])


def _pairs(left: pa.Table, right: pa.Table | None) -> Iterator[pa.RecordBatch]:
    """Pairs of leaves that a traversal leaves."""
    x, y = _nodes(left), _nodes(right) if right is not None else None
    other = right if right is not None else left
    before, before_other = _earlier(left), _earlier(other)
    for i, j in traverse(x, y):
        fresh = _first_time(before, i, before_other, j)
        yield _batch(left, other, x, y or x, i[fresh], j[fresh])


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Groups of consecutive rows with equal keys, whatever batches they come in."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        values = np.stack([np.asarray(t.column(k)) for k in keys])
        edges = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(0)) + 1
        if held and any(held[-1].column(k)[-1].as_py() != t.column(k)[0].as_py() for k in keys):
            yield pa.concat_tables(held)
            held = []
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(t)], strict=True):
            if s:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(s, e - s))
    if held:
        yield pa.concat_tables(held)


def _pairs_of_small(t: pa.Table, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of roots of at most ``FANOUT`` sets (trees of one node), for all of them at once."""
    if not len(starts):
        return
    each = sizes * sizes
    root = np.repeat(np.arange(len(starts)), each)
    k = np.arange(len(root)) - np.repeat(np.cumsum(each) - each, each)
    i, j = k // sizes[root], k % sizes[root]
    i, j = (starts[root] + i)[i < j], (starts[root] + j)[i < j]
    x, before = _nodes(t), _earlier(t)
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        keep = _first_time(before, a, before, b)
        keep[keep] = possible(x, a[keep], x, b[keep], sets=True)
        yield _batch(t, t, x, x, a[keep], b[keep])


def small_trees(rows: DataFrame) -> DataFrame:
    """Pairs of the roots of at most ``CHUNK`` sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            token = np.asarray(t.column("token"))
            edges = np.concatenate(([0], np.flatnonzero(token[1:] != token[:-1]) + 1))
            yield from whole(t, edges)
            held = t.slice(edges[-1])  # the last root may go on in the next batch
        if held is not None:
            yield from whole(held, np.array([0, len(held)]))

    def whole(t: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts, sizes = edges[:-1], np.diff(edges)
        few = sizes <= FANOUT
        yield from _pairs_of_small(t, starts[few], sizes[few])
        for s, n in zip(starts[~few].tolist(), sizes[~few].tolist(), strict=True):
            yield from _pairs(_ordered(t.slice(s, n)), None)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "token").sortWithinPartitions("token").mapInArrow(run, PAIRS)


def large_trees(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of the roots of more sets: chunks of near size, then traversals of the pairs of chunks that are left.

    ``sets`` is the number of a root's sets. Chunks are bands of sizes, each dealt by hash
    to as many as it may need.
    """
    band = F.floor(F.log("n") / float(np.log(1.05))).cast("long")
    chunked = rows.withColumn("band", band)
    sizes = chunked.groupBy("token", "band").agg(F.count(F.lit(1)).alias("in_band"))
    chunked = chunked.join(sizes, ["token", "band"]).withColumn(
        "chunk", F.col("band") * 1_000_000 + F.pmod(F.xxhash64("id"), F.ceil(F.col("in_band") / CHUNK))
    )
    chunked = scratch.table(chunked.select("token", "chunk", "id", "n", "rest", "component", "bits", "earlier"), "chunked")
    schema = "token long, chunk long, bits binary, low long, high long, rest long, excess long, c0 long, c1 long"

    def summary(t: pa.Table) -> pa.Table:
        top = _nodes(t).parents(np.zeros(1, np.int64))
        return pa.table(
            {"token": t.column("token")[:1], "chunk": t.column("chunk")[:1], "bits": pa.array([top.bits.tobytes()], pa.binary())}
            | {c: getattr(top, c) for c in ("low", "high", "rest", "excess", "c0", "c1")}
        )

    nodes = scratch.table(chunked.groupBy("token", "chunk").applyInArrow(summary, schema), "chunk-nodes")
    fields = [f.split()[0] for f in schema.split(", ")][2:]
    side = lambda s: nodes.select("token", F.col("chunk").alias(f"chunk{s}"), *[F.col(c).alias(f"{c}{s}") for c in fields])

    def pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.arange(batch.num_rows)
            both = []
            for s in "xy":
                bits = np.frombuffer(b"".join(batch.column(f"bits{s}").to_pylist()), U).reshape(-1, BITMAP)
                both.append(Nodes(bits, *(np.asarray(batch.column(f"{c}{s}")) for c in fields[1:])))
            keep = possible(both[0], at, both[1], at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep)) for c in ("token", "chunkx", "chunky")], names=["token", "x", "y"]
            )

    # nodes of a root, not its sets: one for CHUNK of them, and only those whose sizes can link
    near = side("x").join(side("y"), "token").where(
        (F.col("chunkx") <= F.col("chunky")) & (100 * F.col("highx") >= PERCENT * F.col("lowy")) & (100 * F.col("highy") >= PERCENT * F.col("lowx"))
    )
    cells = near.mapInArrow(pruned, "token long, x long, y long")
    cells = scratch.table(cells.withColumn("cell", F.monotonically_increasing_id()), "cells")
    ends = cells.select("token", "cell", F.explode(F.array_distinct(F.array("x", "y"))).alias("chunk"), "x", "y")
    placed = chunked.join(ends.withColumn("right", (F.col("chunk") != F.col("x"))), ["token", "chunk"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches, "cell"):
            right = group.filter(group.column("right"))
            left = group.filter(pc.invert(group.column("right")))
            yield from _pairs(_ordered(left), _ordered(right) if right.num_rows else None)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ("cell", "right", "id", "n", "rest", "component", "bits", "earlier")
    return placed.select(*columns).repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(run, PAIRS)


# -- links -----------------------------------------------------------------------


class Join:
    """One run of the join: its tables and the steps over them."""

    def __init__(self, docs: DataFrame, shingle: int = SHINGLE, frequent: int = FREQUENT):
        self.shingle = shingle
        self.scratch = scratch = Scratch(docs.sparkSession, "signature-trees")
        text = F.coalesce("text", F.lit(""))
        keyed = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2"), text.alias("text"),
        )
        # bucketed by their key: no later step shuffles all texts
        self.texts = scratch.bucketed(keyed, "texts", "t1", "t2")
        often, bits = frequent_shingles(docs, scratch, shingle, frequent)
        sets = scratch.table(sets_of(keyed, often, bits, shingle), "sets")
        self.rows = scratch.table(sets.select("doc_id", "k1", "k2", "n"), "rows")
        one = F.struct("doc_id", "t1", "t2", "n", "prefix", "late", "bits", "wide", "mins")
        nodes = (
            sets.where("n > 0")
            .groupBy("k1", "k2")
            .agg(F.min("doc_id").alias("least_id"), F.first(one).alias("s"))
            .select("k1", "k2", "least_id", "s.*", F.monotonically_increasing_id().alias("id"))
        )
        self.nodes = scratch.table(nodes, "nodes")
        scratch.drop("sets", "frequent")
        self._released()

    def verified(self, pairs: DataFrame, label: str) -> DataFrame:
        """Those of ``pairs`` (a, b) whose sets link, by their texts."""
        scratch, shingle = self.scratch, self.shingle
        pairs = scratch.table(self._near_enough(pairs.select("a", "b").distinct()), f"{label}-pairs")
        place = self.nodes.select("id", "doc_id", "t1", "t2")

        def bodies(ids: DataFrame, name: str) -> DataFrame:
            wanted = ids.join(place, F.col(name) == F.col("id")).drop("id").withColumnRenamed("doc_id", "_d")
            # stated over both sides at once, so that it is no key of the join: the join's keys are the buckets'
            same = F.when(F.col("_d").isNull(), F.col("doc_id").isNull()).otherwise(
                F.coalesce(F.col("_d").bitwiseXOR(F.col("doc_id")) == 0, F.lit(False))
            )
            found = wanted.join(self.texts, ["t1", "t2"]).where(same)
            return found.select(*ids.columns, F.col("text").alias(f"text_{name}"))

        left = scratch.table(bodies(pairs, "a"), f"{label}-left")
        right = bodies(pairs.select("b").distinct(), "b").dropDuplicates(["b"])
        right = scratch.table(right, f"{label}-right")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, other = None, None
            for batch in batches:
                keep = np.zeros(batch.num_rows, bool)
                left, right = (batch.column(c).cast(pa.large_binary()) for c in ("text_a", "text_b"))
                for k in range(batch.num_rows):
                    b = batch.column("b")[k].as_py()
                    if b != last:
                        last, other = b, np.unique(shingles([right[k].as_py()], shingle)[0])
                    one = np.unique(shingles([left[k].as_py()], shingle)[0])
                    common = len(np.intersect1d(one, other, assume_unique=True))
                    keep[k] = 100 * common >= PERCENT * (len(one) + len(other) - common)
                mask = pa.array(keep)
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])

        links = scratch.table(left.join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), f"{label}-links")
        scratch.drop(f"{label}-left", f"{label}-right", f"{label}-pairs")
        return links

    def _near_enough(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` without those of large sets that their wide bitmaps rule out."""
        large = self.nodes.where("wide IS NOT NULL")
        side = lambda c: large.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"bits{c}"))
        both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 2_048):
                    batch = whole.slice(at, 2_048)
                    keep = np.ones(batch.num_rows, bool)
                    k = np.flatnonzero(np.asarray(pc.and_(pc.is_valid(batch.column("bitsa")), pc.is_valid(batch.column("bitsb")))))
                    if len(k):
                        found = []
                        for c, s in enumerate("ab"):
                            bits = np.frombuffer(b"".join(batch.column(f"bits{s}").take(pa.array(k)).to_pylist()), U)
                            n = np.asarray(batch.column(f"n{s}").take(pa.array(k)))
                            found.append(Nodes.of_sets(bits.reshape(-1, WIDE), n, n, np.full(len(n), c)))
                        keep[k] = possible(found[0], np.arange(len(k)), found[1], np.arange(len(k)), sets=True)
                    yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

        return both.select("a", "b", "na", "bitsa", "nb", "bitsb").mapInArrow(run, "a long, b long")

    def near_copies(self) -> DataFrame:
        """Links of sets with the least set of an equal min-hash, where bitmaps allow one."""
        keys = self.nodes.select("id", "n", "bits", F.posexplode("mins").alias("p", "m"))
        least = keys.groupBy("p", "m").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
        # written first, so that a key with very many sets can be split in the join
        least = self.scratch.table(least, "least")
        ends = keys.join(least, ["p", "m"]).where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))
        return self.verified(self._bits_allow(self.scratch.table(ends.distinct(), "hub-ends")), "near")

    def _bits_allow(self, ends: DataFrame) -> DataFrame:
        """Those of the pairs ``ends`` (a, b) whose bitmaps allow a link."""
        side = lambda s, name: self.nodes.select(F.col("id").alias(name), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"bits{s}"))
        both = ends.join(side("x", "a"), "a").join(side("y", "b"), "b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.arange(batch.num_rows)
                found = []
                for k, s in enumerate("xy"):
                    bits = np.frombuffer(b"".join(batch.column(f"bits{s}").to_pylist()), U).reshape(-1, BITMAP)
                    n = np.asarray(batch.column(f"n{s}"))
                    found.append(Nodes.of_sets(bits, n, n, np.full(len(n), k)))
                mask = pa.array(possible(found[0], at, found[1], at, sets=True))
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])

        return both.select("a", "b", "nx", "bitsx", "ny", "bitsy").mapInArrow(run, "a long, b long")

    def hub_links(self, live: DataFrame, label: str) -> DataFrame:
        """Links of the components at a root with the least of them, by one pair of sets each."""
        hubs = live.groupBy("token").agg(F.min(F.struct("component", "id")).alias("h"))
        # written first, so that a root with very many sets can be split in the join
        hubs = self.scratch.table(hubs, f"{label}-hubs")
        ends = (
            live.join(hubs, "token")
            .where("component <> h.component")
            .groupBy("component", F.col("h.component").alias("hub"))
            .agg(F.min(F.struct("id", F.col("h.id").alias("hub_id"))).alias("p"))
        )
        ends = self.scratch.table(ends.select(F.col("p.id").alias("a"), F.col("p.hub_id").alias("b")), f"{label}-ends")
        links = self.verified(self._bits_allow(ends), label)
        self.scratch.drop(f"{label}-hubs", f"{label}-ends")
        return links

    def still_apart(self, live: DataFrame, known: DataFrame) -> DataFrame:
        """``live`` with the components of ``known``, without roots whose sets are of one."""
        now = live.drop("component").join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
        roots = now.groupBy("token").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
        return now.join(roots.where("c0 <> c1").select("token"), "token").select("token", "id", "place", "component", "sets")

    def with_earlier(self, live: DataFrame) -> DataFrame:
        """``live`` with the roots of a set that come last before each.

        Two sets of different components that share a root share it here too, as every row of a live
        root is kept, and less of both is left at a later root than at an earlier one.
        """
        in_order = Window.partitionBy("id").orderBy("place")
        before = [F.coalesce(F.lag("token", k).over(in_order), F.lit(0)) for k in range(1, EARLIER + 1)]
        return live.withColumn("earlier", F.array(*before))

    def shared_entries(self, known: DataFrame) -> DataFrame:
        """(token, id, place, component, sets) of roots whose sets are of several components."""
        scratch = self.scratch
        total = self.nodes.agg(F.sum(F.size("prefix"))).first()[0] or 0
        buckets = max(16, -(-total // BUCKET_SHINGLES))

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Entries of shingles that are not frequent, by bucket."""
            for batch in batches:
                ids, prefix, late = (batch.column(c) for c in ("id", "prefix", "late"))
                lengths = np.asarray(pc.list_value_length(prefix)).astype(np.int64)
                token = np.asarray(prefix.flatten())
                place = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                first = place < np.repeat(lengths - np.asarray(late), lengths)
                owner = np.repeat(np.asarray(ids), lengths)[first]
                token, place = token[first], place[first]
                bucket = (token.view(U) % U(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                held = np.flatnonzero(np.diff(edges))
                part = lambda x, b: x[order[edges[b] : edges[b + 1]]].tobytes()  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held.astype(np.int32))]
                    + [pa.array([part(x, b) for b in held], pa.binary()) for x in (token, owner, place.astype(np.int32))],
                    names=["bucket", "tokens", "ids", "places"],
                )

        def unpacked(group: pa.Table) -> pa.Table:
            """Entries of shingles that several sets have."""
            column = lambda c, kind: np.frombuffer(b"".join(group.column(c).to_pylist()), kind)
            token, ids, place = column("tokens", np.int64), column("ids", np.int64), column("places", np.int32)
            order = np.argsort(token, kind="stable")
            token = token[order]
            same = np.zeros(len(token) + 1, bool)
            same[1:-1] = token[1:] == token[:-1]
            keep = order[same[1:] | same[:-1]]
            return pa.table({"token": np.sort(token[same[1:] | same[:-1]]), "id": ids[keep], "place": place[keep]})

        schema = "token long, id long, place int"
        rare = (
            self.nodes.select("id", "prefix", "late")
            .mapInArrow(packed, "bucket int, tokens binary, ids binary, places binary")
            .groupBy("bucket")
            .applyInArrow(unpacked, schema)
        )
        often = self.nodes.where("late > 0").select("id", F.size("prefix") - F.col("late"), F.posexplode("prefix").alias("place", "token"))
        often = often.toDF("id", "early", "place", "token").where("place >= early").select("token", "id", "place")
        entries = rare.unionByName(often).join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
        entries = scratch.table(entries.select("token", "id", "place", "component"), "entries")
        roots = entries.groupBy("token").agg(
            F.min("component").alias("c0"), F.max("component").alias("c1"), F.count(F.lit(1)).alias("sets")
        )
        roots = scratch.table(roots.where("c0 <> c1").select("token", "sets"), "roots")
        return entries.join(roots, "token")

    def _released(self) -> None:
        """Shuffle files whose frames are gone are deleted when the driver collects its garbage: now, not at some time."""
        gc.collect()
        self.scratch.spark._jvm.System.gc()

    def components(self) -> DataFrame:
        """(id, component) of the nodes that link with another."""
        scratch = self.scratch
        known = scratch.table(self._connected(self.near_copies(), "near-cc"), "known-0")
        live = scratch.table(self.shared_entries(known), "live")
        scratch.drop("entries", "roots")
        self._released()
        known = scratch.table(self._merged(known, self.hub_links(live, "hub"), "hub"), "known-hub")
        live = scratch.table(self.still_apart(live, known), "still-live")
        scratch.drop("live", "known-0")
        self._released()
        leaves = self.nodes.select("id", "n", "bits")
        live = self.with_earlier(live)
        rows = lambda wanted: live.where(wanted).join(leaves, "id").select(
            "token", "id", "n", (F.col("n") - F.col("place")).alias("rest"), "component", "bits", "earlier"
        )
        small = small_trees(rows(F.col("sets") <= CHUNK))
        large = large_trees(rows(F.col("sets") > CHUNK), scratch)
        found = scratch.table(small.unionByName(large).distinct(), "found")
        scratch.drop("still-live", "chunked", "chunk-nodes", "cells")
        self._released()
        # one pair for every two components, the most alike
        best = found.groupBy("ca", "cb").agg(F.min_by(F.struct("a", "b"), F.struct("apart", "a", "b")).alias("p"))
        first = self.verified(best.select("p.a", "p.b"), "best")
        known = scratch.table(self._merged(known, first, "first"), "known-1")
        side = lambda c: known.select(F.col("id").alias(c), F.col("component").alias(f"now_{c}"))
        now = found.join(side("a"), "a", "left").join(side("b"), "b", "left")
        apart = F.coalesce("now_a", "a") != F.coalesce("now_b", "b")
        rest = now.where(apart).join(best.select("p.a", "p.b"), ["a", "b"], "left_anti")
        second = self.verified(rest, "rest")
        known = scratch.table(self._merged(known, second, "second"), "known-2")
        scratch.drop("found", "known-hub", "known-1")
        return known

    def _connected(self, links: DataFrame, label: str) -> DataFrame:
        return connected_components(links, self.scratch, label).select(F.col("node").alias("id"), "component")

    def _merged(self, known: DataFrame, links: DataFrame, label: str) -> DataFrame:
        """``known`` after further links: components are joined, and new nodes enter."""
        side = lambda c: known.select(F.col("id").alias(c), F.col("component").alias(f"c_{c}"))
        between = links.join(side("a"), "a", "left").join(side("b"), "b", "left")
        between = between.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
        turned = self._connected(between, f"{label}-cc").withColumnRenamed("component", "after")
        turned = self.scratch.table(turned, f"{label}-turned")
        moved = known.join(turned.select(F.col("id").alias("component"), "after"), "component", "left")
        moved = moved.select("id", F.coalesce("after", "component").alias("component"))
        fresh = turned.join(known.select("id"), "id", "left_anti").select("id", F.col("after").alias("component"))
        return moved.unionByName(fresh)

    def result(self) -> DataFrame:
        scratch = self.scratch
        nodes = self.nodes.select("id", "k1", "k2", "least_id").join(self.components(), "id", "left")
        nodes = nodes.withColumn("component", F.coalesce("component", "id"))
        least = nodes.groupBy("component").agg(F.min("least_id").alias("component_id"))
        least = scratch.table(least, "component-ids")
        by_key = scratch.table(nodes.join(least, "component").select("k1", "k2", "component_id"), "by-key")
        scratch.keep("rows", "by-key")
        joined = self.rows.join(by_key, ["k1", "k2"], "left")
        # an empty set is alone
        return joined.select(
            "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
        )


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    return Join(docs, shingle, frequent).result()
