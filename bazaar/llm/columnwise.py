"""Column-wise construction of the Burrows-Wheeler transform and common prefixes of a collection.

One symbol of every string is inserted per round, from the last to the first. A
round reads the files of the round before from start to end and writes the next
(files stay in memory up to ``SPOOL`` bytes and go to the task's disk beyond):

* ``key``: for every suffix in order, its first symbol and the place of the suffix
  that follows it (so keys ascend);
* ``bwt``: for every suffix in order, the symbol before it.

The place of a new suffix is the number of smaller keys. Its common prefix with its
neighbours is one more than the least common prefix between the neighbours' rests.

A symbol is several bytes, named by the rank of a 64-bit hash: the most of ``WIDTHS`` that part a window
evenly. A text is entered as so many strings, one for each first byte, so that every byte position starts a
suffix, and a column is inserted so many times less often than with single bytes. A round goes through all
suffixes, so wide symbols cost fewer passes; a window still is several of them.
"""

from __future__ import annotations

from tempfile import SpooledTemporaryFile

import numpy as np

#: Bytes of a symbol, multiples of 8.
WIDTHS = (40, 32, 24, 16, 8)
CHUNK = 1 << 18
SPOOL = 64 << 20
BLOCK = 8


def symbol_width(window: int) -> int:
    """Bytes of the symbols that windows of ``window`` bytes are made of."""
    return next(w for w in WIDTHS if window % w == 0)


def name_symbols(data: np.ndarray, width: int) -> np.ndarray:
    """For each position, a number from 1 for the ``width`` bytes there. The last width - 1 have none."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(np.uint64).ravel()
    n = len(data) - width + 1
    with np.errstate(over="ignore"):
        mixed = words * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        joined = mixed[:n] * np.uint64(0xD6E8FEB86659FD93)
        for k in range(8, width, 8):
            joined ^= mixed[k : k + n]
            joined ^= joined >> np.uint64(32)
            joined *= np.uint64(0xC2B2AE3D27D4EB4F)
        joined ^= joined >> np.uint64(32)
    order = np.argsort(joined)
    ranks = np.empty(len(joined), np.int64)
    ordered = joined[order]
    ranks[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ranks


class Minima:
    """Least value of any range of an array: spans of up to ``BLOCK`` values at every place, doubling spans of whole blocks."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.blocks = -(-max(n, 1) // BLOCK)
        padded = np.full((self.blocks + 1) * BLOCK, 255, np.uint8)
        padded[:n] = values
        self.short = [padded]
        while 2 ** (len(self.short) - 1) < BLOCK:
            half = 2 ** (len(self.short) - 1)
            self.short.append(np.minimum(self.short[-1][:-half], self.short[-1][half:]))
        spans = [self.short[-1][: self.blocks * BLOCK : BLOCK].copy()]
        while 2 ** len(spans) <= self.blocks:
            half, last = 2 ** (len(spans) - 1), spans[-1]
            spans.append(last.copy())  # as long as the others; what lies beyond its last whole span is not asked for
            np.minimum(last[:-half], last[half:], out=spans[-1][:-half])
        self.spans = np.concatenate(spans)

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minima of [first, end), each not empty."""
        out = np.empty(len(first), np.uint8)
        length = end - first
        for k, values in enumerate(self.short):
            last = 2 ** (k + 1) > BLOCK
            at = np.flatnonzero((length >= 2**k) & (last | (length < 2 ** (k + 1))))
            out[at] = np.minimum(values[first[at]], values[end[at] - 2**k])
        # the ends are read; between them whole blocks
        low, high = -(-first // BLOCK), end // BLOCK
        at = np.flatnonzero(high > low)
        low, high = low[at], high[at]
        level = np.frexp(high - low)[1].astype(np.int64) - 1
        base = level * self.blocks
        inside = np.minimum(self.spans[base + low], self.spans[base + high - (1 << level)])
        out[at] = np.minimum(out[at], inside)
        return out


class Collection:
    """The suffixes inserted so far, in order; ``key`` and ``bwt`` in files, common prefixes as bytes."""

    def __init__(self, strings: int):
        self.size = strings
        self.key, self.bwt = self._file(), self._file()
        self.key.write(np.arange(strings, dtype=np.int64).tobytes())  # the empty suffixes: symbol 0
        self.bwt.write(np.zeros(strings, np.int32).tobytes())
        self.lcp = np.zeros(strings, np.uint8)
        self.place = np.arange(strings)  # of each string's longest suffix so far

    @staticmethod
    def _file() -> SpooledTemporaryFile:
        return SpooledTemporaryFile(max_size=SPOOL)

    def close(self) -> None:
        self.key.close()
        self.bwt.close()

    def insert(self, who: np.ndarray, symbols: np.ndarray) -> None:
        """Put ``symbols`` (one each) in front of the strings ``who``."""
        new = (symbols << 32) | self.place[who]
        order = np.argsort(new)
        new, who, symbols = new[order], who[order], symbols[order]
        spot = self.place[who]
        ranks, before, after = self._ranks(new)
        # a new suffix may have another new one as its neighbour
        same = np.zeros(len(new), bool)
        same[1:] = (ranks[1:] == ranks[:-1]) & (symbols[1:] == symbols[:-1])
        before[1:] = np.where(same[1:], spot[:-1], before[1:])
        after[:-1] = np.where(same[1:], spot[1:], after[:-1])
        minima = Minima(self.lcp)
        up, down = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        has = before >= 0
        up[has] = 1 + minima.of(before[has] + 1, spot[has] + 1).astype(np.int64)
        has = after >= 0
        down[has] = 1 + minima.of(spot[has] + 1, after[has] + 1).astype(np.int64)
        up, down = np.minimum(up, 254).astype(np.uint8), np.minimum(down, 254).astype(np.uint8)
        # for each place, how many new suffixes come before it or take it
        moved = np.cumsum(np.bincount(ranks, minlength=self.size + 1), dtype=np.int32)
        self._write(new, symbols, spot, ranks, moved, up, down, same)
        self.place = self.place + moved[self.place]
        self.place[who] = ranks + np.arange(len(ranks))

    def _ranks(self, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each new key the number of smaller keys, and the rests' places of its neighbours with its symbol, or -1."""
        ranks = np.full(len(new), self.size, np.int64)
        before, after = np.full(len(new), -1, np.int64), np.full(len(new), -1, np.int64)
        begun, at, last = 0, 0, -1
        self.key.seek(0)
        while at < self.size:
            keys = np.frombuffer(self.key.read(8 * min(CHUNK, self.size - at)), np.int64)
            done = begun + int(np.searchsorted(new[begun:], keys[-1]))
            here = new[begun:done]
            r = np.searchsorted(keys, here)
            ranks[begun:done] = at + r
            left = np.where(r > 0, keys[r - 1], last)
            right = keys[r]
            before[begun:done] = np.where(left >> 32 == here >> 32, left & 0xFFFFFFFF, -1)
            after[begun:done] = np.where(right >> 32 == here >> 32, right & 0xFFFFFFFF, -1)
            begun, at, last = done, at + len(keys), keys[-1]
        rest = new[begun:]
        before[begun:] = np.where(last >> 32 == rest >> 32, last & 0xFFFFFFFF, -1)
        return ranks, before, after

    def _write(self, new, symbols, spot, ranks, moved, up, down, same) -> None:
        """The next files: old entries with shifted places, new ones between them."""
        new = (new & ~0xFFFFFFFF) | (spot + moved[spot])
        # the suffix after a new one now follows it; its common prefix is that with the new one
        follower = np.ones(len(new), bool)
        follower[:-1] = ~same[1:]
        size = self.size + len(new)
        lcp = np.empty(size, np.uint8)
        fresh = np.zeros(size, bool)
        fresh[ranks + np.arange(len(new))] = True
        old = self.lcp.copy()
        inside = follower & (ranks < self.size)
        old[ranks[inside]] = down[inside]
        lcp[~fresh], lcp[fresh] = old, up
        before = np.argsort(spot)
        key, bwt = self._file(), self._file()
        self.key.seek(0)
        self.bwt.seek(0)
        for at in range(0, self.size, CHUNK):
            n = min(CHUNK, self.size - at)
            keys = np.frombuffer(self.key.read(8 * n), np.int64)
            marks = np.frombuffer(self.bwt.read(4 * n), np.int32).copy()
            keys = keys + moved[keys & 0xFFFFFFFF]
            a, b = np.searchsorted(spot[before], (at, at + n))
            marks[spot[before[a:b]] - at] = symbols[before[a:b]]
            end = at + n if at + n < self.size else self.size + 1
            a, b = np.searchsorted(ranks, (at, end))
            where = ranks[a:b] - at
            key.write(np.insert(keys, where, new[a:b]).tobytes())
            bwt.write(np.insert(marks, where, 0).tobytes())
        self.close()
        self.key, self.bwt = key, bwt
        self.lcp, self.size = lcp, size

    def following(self) -> np.ndarray:
        """For every suffix, the place of the suffix without its first symbol."""
        self.key.seek(0)
        return np.frombuffer(self.key.read(), np.int64) & 0xFFFFFFFF


def repeated_windows(data: bytes, starts: np.ndarray, lengths: np.ndarray, window: int) -> list[np.ndarray]:
    """For each text data[start : start + length], which of its windows occur more than once in the collection.

    ``window`` is a multiple of 8. A window is a place of a text; windows of
    one text count against each other too.
    """
    width = symbol_width(window)
    need = window // width
    windows = np.maximum(0, lengths - window + 1)
    ends = np.cumsum(windows)
    marks = np.zeros(int(windows.sum()), bool)
    out = np.split(marks, ends[:-1])
    text = np.repeat(np.arange(len(out)), np.minimum(width, windows))
    if not len(text):
        return out
    names = name_symbols(np.frombuffer(data, np.uint8), width)
    phase = np.concatenate([np.arange(min(width, n)) for n in windows.tolist()])
    count = (lengths[text] - phase) // width  # symbols of each string
    first = starts[text] + phase
    suffixes = Collection(len(text))
    for k in range(1, int(count.max()) + 1):
        who = np.flatnonzero(count >= k)
        suffixes.insert(who, names[first[who] + (count[who] - k) * width])
    near = suffixes.lcp >= need
    near[:-1] |= near[1:].copy()  # with the next, as well as with the one before
    follow, at = suffixes.following(), suffixes.place.copy()
    suffixes.close()
    begin = (ends - windows)[text] + phase
    for k in range(int(count.max()) - need + 1):
        live = np.flatnonzero(count - k >= need)
        marks[begin[live] + k * width] = near[at[live]]
        at[live] = follow[at[live]]
    return out
