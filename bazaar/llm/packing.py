"""Best-fit packing of token sequences by linear grouping.

A document is its token ids and id 0. Documents longer than a sequence are cut
into whole sequences; the first piece takes the rest. Whole pieces fill a sequence
each. The others are packed by their lengths:

1. Linear grouping: lengths above a threshold are sorted and cut into groups of equal
   cardinality; within a group they count as its longest.
2. Configurations: with so few sizes, the fewest sequences are a linear programme
   over the sets of sizes that fit, solved by column generation (a simplex over the
   groups, a knapsack for the next column) and rounded down.
3. Substitution: each place of a configuration takes an actual document of the
   group; the space that rounding up had reserved is free again.
4. Best fit: what rounding down left over, then the small documents, longest
   first, each into the sequence with the least space that holds it.

Rounding costs most where many small sizes share a sequence, so the plan is made
for several thresholds (``LARGE_SHARES``) and the one with the fewest sequences used.

The plan is made from the histogram of lengths (at most one count per length, so
it is bounded by the sequence length whatever the input) as runs: documents r to
r + n of a length go to sequences s to s + n at one offset. Each document finds its
run by its length and its rank among documents of that length; ranks come from
counts per partition, so no length is sorted or gathered in one task.

Defined cases: a null or empty text is the single id 0; repeated rows are packed
each; a null doc_id is packed like any other; extra columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bazaar.llm.staging import Scratch

CAPACITY = 2048
#: Lengths above a threshold are large. The plan is made for each of these shares of
#: a sequence, and the one with the fewest sequences is used.
LARGE_SHARES = (0.25, 0.34, 0.4, 0.44, 0.5)
GROUPS = 96
#: Places of a run are looked up by length * RANKS + rank.
RANKS = 1 << 48
SPECIAL = "<|endoftext|>"

_LOADED: dict[str | None, object] = {}


def byte_bpe(vocabulary: str | None = None):
    """Encoder of the 50k byte-level BPE: a function from text to ids.

    ``vocabulary`` is the file of ranks (default: the public file). Its ids are
    those that ``tokenizers`` gives with the JSON file of the same vocabulary,
    special strings included; that library encodes the rare text that the faster
    one refuses.
    """
    if vocabulary not in _LOADED:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
        )
        slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

        def encode(text: str) -> list[int]:
            try:
                if SPECIAL in text:
                    return fast.encode(text, allowed_special="all")
                return fast.encode_ordinary(text)
            except BaseException as error:  # the pattern matcher gives up on some very long runs
                if isinstance(error, (KeyboardInterrupt, SystemExit)):
                    raise
                return slow.encode(text, add_special_tokens=False).ids

        _LOADED[vocabulary] = encode
    return _LOADED[vocabulary]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first is the rest, all others are whole."""
    first = n - capacity * ((n - 1) // capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and the piece's place (part, local) among pieces of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = byte_bpe(vocabulary), TaskContext.get().partitionId(), defaultdict(int)
        for whole in batches:
            for batch in (whole.slice(s, 512) for s in range(0, whole.num_rows, 512)):
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = np.array(encode(text or "") + [0], "<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        crc = zlib.crc32(ids[start : start + length])
                        rows.append((doc_id, k, start, length, crc, part, seen[length]))
                        seen[length] += 1
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"],
                )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# -- the plan, from counts by length -------------------------------------------


def linear_groups(counts: dict[int, int], small: int, groups: int) -> list[list[list[int]]]:
    """Runs [length, first rank, count] of the lengths above ``small``, longest first, in groups of equal cardinality."""
    total = sum(n for length, n in counts.items() if length > small)
    out: list[list[list[int]]] = []
    seen = 0
    for length in sorted((x for x in counts if x > small), reverse=True):
        rank, left = 0, counts[length]
        while left:
            k = seen * groups // total
            until = -(-(k + 1) * total // groups)  # first place of the next group
            take = min(left, until - seen)
            if len(out) <= k:
                out += [[] for _ in range(k + 1 - len(out))]
            out[k].append([length, rank, take])
            rank, left, seen = rank + take, left - take, seen + take
    return [g for g in out if g]


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """(places per size, sequences) of an optimal fractional packing, by column generation."""
    k = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    basis = columns.copy()
    for _ in range(60 * k):
        inverse = np.linalg.inv(basis)
        x = inverse @ demand
        price = np.maximum(inverse.sum(0), 0)
        # the most valuable set of sizes that fits, by number of places
        value = np.zeros(capacity + 1)
        steps = []
        for _ in range(int(capacity // sizes.min())):
            step = np.full(capacity + 1, -1)
            better = value.copy()
            for g in range(k):
                gain = value[: capacity + 1 - sizes[g]] + price[g]
                at = gain > better[sizes[g] :] + 1e-12
                better[sizes[g] :][at], step[sizes[g] :][at] = gain[at], g
            if (step < 0).all():
                break
            value = better
            steps.append(step)
        if value[capacity] <= 1 + 1e-9:
            break
        column, room = np.zeros(k), capacity
        for step in reversed(steps):
            if step[room] >= 0:
                column[step[room]] += 1
                room -= sizes[step[room]]
        change = inverse @ column
        ratio = np.full(k, np.inf)
        ratio[change > 1e-9] = x[change > 1e-9] / change[change > 1e-9]
        basis[:, int(ratio.argmin())] = column
    x = np.linalg.solve(basis, demand)
    return [(basis[:, j].astype(int), float(x[j])) for j in range(k)]


class _Runs:
    """A group's documents, handed out longest first as runs of one length."""

    def __init__(self, runs: list[list[int]]):
        self.runs = [r[:] for r in reversed(runs)]

    def take(self, n: int) -> list[tuple[int, int, int]]:
        out = []
        while n:
            length, rank, count = self.runs[-1]
            t = min(n, count)
            out.append((length, rank, t))
            n -= t
            if t == count:
                self.runs.pop()
            else:
                self.runs[-1] = [length, rank + t, count - t]
        return out


def pack_plan(counts: dict[int, int], capacity: int = CAPACITY):
    """Runs (length, first rank, count, first sequence, offset), and the number of sequences."""
    plans = [grouped_plan(counts, capacity, int(capacity * share), GROUPS) for share in LARGE_SHARES]
    return min(plans, key=lambda p: p[1])


def grouped_plan(counts: dict[int, int], capacity: int, small: int, groups: int):
    """The plan with lengths above ``small`` as large ones, in ``groups`` groups."""
    plan: list[tuple[int, int, int, int, int]] = []
    by_gap: dict[int, list[tuple[int, int]]] = defaultdict(list)
    used = 0
    grouped = linear_groups(counts, min(small, capacity), groups)
    rest: dict[int, list[tuple[int, int]]] = defaultdict(list)
    if grouped:
        sizes = np.array([g[0][0] for g in grouped])
        demand = np.array([sum(r[2] for r in g) for g in grouped], float)
        # groups may share a size; the programme needs each size once
        distinct, which = np.unique(sizes, return_inverse=True)
        pools = [_Runs([r for g, w in zip(grouped, which, strict=True) if w == k for r in g]) for k in range(len(distinct))]
        wanted = np.array([demand[which == k].sum() for k in range(len(distinct))])
        left = wanted.copy()
        for places, x in configurations(distinct, wanted, capacity):
            n = int(min([x + 1e-6, *(left[k] // places[k] for k in np.flatnonzero(places))]))
            if n <= 0:
                continue
            left -= n * places
            slots = [pools[k].take(n) for k in np.flatnonzero(places)[::-1] for _ in range(places[k])]
            ends = sorted({int(e) for s in slots for e in np.cumsum([t for _, _, t in s])})
            at = [[0, 0] for _ in slots]  # run and place in it
            begin = 0
            for end in ends:
                offset = 0
                for s, a in zip(slots, at, strict=True):
                    length, rank, count = s[a[0]]
                    plan.append((length, rank + a[1], end - begin, used + begin, offset))
                    offset += length
                    a[1] += end - begin
                    if a[1] == count:
                        a[0], a[1] = a[0] + 1, 0
                by_gap[capacity - offset].append((used + begin, end - begin))
                begin = end
            used += n
        for pool in pools:
            for length, rank, count in pool.runs:
                rest[length].append((rank, count))
    for length, n in counts.items():
        if length <= small and n:
            rest[length].append((0, n))
    gaps = 0  # bit g is set if some sequence has exactly g free
    for g, runs in by_gap.items():
        if runs:
            gaps |= 1 << g
    for length in sorted(rest, reverse=True):
        for first, count in rest[length]:
            rank, n = first, count
            while n:
                fits = gaps >> length
                if not fits:
                    opened = -(-n // (capacity // length))
                    by_gap[capacity].append((used, opened))
                    used += opened
                    gaps |= 1 << capacity
                    continue
                g = length + (fits & -fits).bit_length() - 1
                s, m = by_gap[g].pop()
                t = min(n, m)
                plan.append((length, rank, t, s, capacity - g))
                if t < m:
                    by_gap[g].append((s + t, m - t))
                if not by_gap[g]:
                    gaps &= ~(1 << g)
                if g > length:
                    by_gap[g - length].append((s, t))
                    gaps |= 1 << (g - length)
                rank, n = rank + t, n - t
    return plan, used


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    scratch = Scratch(docs.sparkSession, "packing")
    cut_ = scratch.table(pieces(docs, capacity, vocabulary), "pieces")
    counts = cut_.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition and length
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    counts = scratch.table(counts.withColumn("before", before), "counts")
    # one count per length: at most ``capacity`` rows
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    plan, sequences = pack_plan({k: v for k, v in histogram.items() if k < capacity}, capacity)
    runs = np.array(sorted((length * RANKS + rank, s - rank, o) for length, rank, _, s, o in plan), np.int64).reshape(-1, 3)
    starts, shift, offsets = runs[:, 0].copy(), runs[:, 1].copy(), runs[:, 2].copy()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            sequence, offset = sequences + rank, np.zeros(len(rank), np.int64)
            partial = length < capacity
            if partial.any():
                run = np.searchsorted(starts, length[partial] * RANKS + rank[partial], "right") - 1
                sequence[partial] = shift[run] + rank[partial]
                offset[partial] = offsets[run]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    ranked = cut_.join(counts, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("rank")
    )
    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
