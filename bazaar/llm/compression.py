"""Quality rules by compression bands.

The zstandard ratio (bytes / compressed bytes) of a whole text and of its fixed
chunks is high for repetitive text and near one for incompressible text. A text is
rejected if its ratio leaves the band of its length, or if too many of its chunks
leave the band of chunks. Base counts (words, symbols, repeated lines and words)
come first; a text that fails them is rejected whatever its ratio.

A ratio grows with the length, so limits do. They are the corpus's own: medians and
quartiles of the ratio, by quarter octave of the length, over every different text that
passes the base counts, give a smooth centre and spread, and the band is the centre
plus and minus ``WIDTH`` spreads. The fixed ``BANDS`` hold beside it, so a corpus that
is junk throughout does not pass for normal. Texts of equal length and ratio count once, so
copies, however many, do not move a limit.

Defined cases: a null or empty text has zero counts and fails; a text with a single
long word is judged like any other; repeated rows are judged each; extra columns
are not read; where no text passes the base counts (an empty table, too), only the fixed
limits are there, and a text shorter than a chunk is judged as a whole alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm.staging import Scratch

LEVEL = 3
CHUNK = 2048
#: Half the width of a band, in spreads (a quartile's distance from the median / 0.6745).
WIDTH = 3.0
#: Length classes in an octave, and the least spread as a share of the centre.
CLASSES = 4
LEAST_SPREAD = 0.02
#: Fixed outer limits: (bytes below which it holds, lowest ratio, highest ratio) of a whole
#: text. Short texts share less with themselves, so both grow with the length.
BANDS = (
    (512, 0.9, 2.6),
    (2_048, 1.15, 3.0),
    (8_192, 1.25, 3.6),
    (32_768, 1.3, 4.4),
    (131_072, 1.3, 5.0),
    (float("inf"), 1.3, 6.0),
)
#: Fixed outer limits of a chunk, and the share of chunks that may leave their band.
CHUNK_BAND = (1.2, 3.6)
CHUNKS_OUT = 0.25
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    fresh = count()
    ids = np.fromiter((numbers[w] if w in numbers else numbers.setdefault(w, next(fresh)) for w in words), np.int64, n)
    pair = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) > 1_000_000:  # keeps the triple's key inside 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    triple = pair[:-1] * len(numbers) + ids[2:]
    _, which, times = np.unique(triple, return_inverse=True, return_counts=True)
    often = times[which] > 1
    marked = np.zeros(n, bool)
    for k in range(3):
        marked[k : n - 2 + k] |= often
    return int(marked.sum())


def repeated_lines(text: str) -> int:
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            repeats += line in seen
            seen.add(line)
    return repeats


def ratio(data: bytes, compressor: zstandard.ZstdCompressor) -> float:
    return len(data) / len(compressor.compress(data))


def chunk_ratios(data: bytes, compressor: zstandard.ZstdCompressor) -> list[float]:
    """Ratios of the fixed chunks; the tail is a full chunk that overlaps the one before."""
    starts = list(range(0, len(data) - CHUNK + 1, CHUNK))
    if starts and starts[-1] + CHUNK < len(data):
        starts.append(len(data) - CHUNK)
    return [ratio(data[s : s + CHUNK], compressor) for s in starts]


def measure(text: str | None, compressor: zstandard.ZstdCompressor) -> tuple:
    """The base counts, whether they fail, bytes, ratio (0 if empty) and ratios of the chunks."""
    text = text or ""
    data = text.encode()
    words = data.split()  # bytes: the six ASCII blanks only
    repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * len(words)
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), repeated_lines(text),
        repeat, failed, len(data), ratio(data, compressor) if data else 0.0, chunk_ratios(data, compressor),
    )


BASE = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
MEASURED = f"{BASE}, n_bytes long, ratio double, chunks array<double>"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    names = [field.split()[0] for field in MEASURED.split(", ")]
    types = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
    for batch in batches:
        rows = [measure(x.as_py(), compressor) for x in batch.column(1)]
        cols = zip(*rows, strict=True) if rows else [[]] * len(types)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=names
        )


# -- limits ------------------------------------------------------------------------


def smooth(at: np.ndarray, y: np.ndarray, weight: np.ndarray, degree: int) -> np.ndarray:
    """Coefficients, highest power first, of a curve that single odd classes do not bend."""
    degree = min(degree, len(at) - 1)
    trust = np.ones(len(at))
    for _ in range(20):
        curve = np.polyfit(at, y, degree, w=np.sqrt(weight * trust))
        off = np.abs(y - np.polyval(curve, at))
        scale = max(1.4826 * np.median(off), 0.01)
        trust = 1 / (1 + (off / scale) ** 2) ** 2
    return curve


def band_curves(classes: list[tuple[int, int, float, float, float]]) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """Centre and spread as curves of the class, and the least and greatest class.

    ``classes`` holds (class, different texts, lower quartile, median, upper quartile). A class weighs
    the root of its texts, so that the many short texts do not set the limits of long ones.
    """
    if not classes:
        return None
    at, n, low, middle, high = (np.array(c, float) for c in zip(*sorted(classes), strict=True))
    weight = np.sqrt(n)
    known = n >= 4 if (n >= 4).any() else n > 0  # quartiles of fewer say nothing of the spread
    spread = smooth(at[known], ((high - low) / 2 / 0.6745)[known], weight[known], 1)
    return smooth(at, middle, weight, 2), spread, at.min(), at.max()


def length_class(n_bytes: Column) -> Column:
    return F.floor(F.log2(n_bytes.cast("double")) * CLASSES).cast("int")


def _power(curve: np.ndarray, x: Column) -> Column:
    total = F.lit(0.0)
    for c in curve:
        total = total * x + F.lit(float(c))
    return total


def limits(measured: DataFrame) -> tuple[tuple | None, tuple[float, float]]:
    """Curves of the whole texts' band, and the band of chunks; the driver gets a row per class."""
    texts = measured.where("NOT base_failed").groupBy("n_bytes", "ratio").agg(F.min("chunks").alias("chunks"))
    quartiles = [0.25, 0.5, 0.75]
    rows = (
        texts.groupBy(length_class(F.col("n_bytes")).alias("class"))
        .agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("ratio", quartiles, 10_000).alias("q"))
        .collect()  # at most CLASSES rows for each power of two
    )
    curves = band_curves([(r["class"], r["n"], *r["q"]) for r in rows])
    q = texts.select(F.explode("chunks").alias("c")).agg(F.percentile_approx("c", quartiles, 10_000).alias("q")).first()["q"]
    if q is None:
        return curves, CHUNK_BAND
    wide = WIDTH * max((q[2] - q[0]) / 2 / 0.6745, LEAST_SPREAD * q[1])
    return curves, (max(CHUNK_BAND[0], q[1] - wide), min(CHUNK_BAND[1], q[1] + wide))


def compression_rules(docs: DataFrame) -> DataFrame:
    """Base counts, verdict, and what it rests on: ratio, its limits, share of chunks out of their band."""
    scratch = Scratch(docs.sparkSession, "compression")
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    measured = scratch.table(slim.mapInArrow(_measure, MEASURED), "measured")
    curves, (chunk_low, chunk_high) = limits(measured)

    size, low, high = F.col("n_bytes"), F.lit(BANDS[-1][1]), F.lit(BANDS[-1][2])
    for below, lo, hi in reversed(BANDS[:-1]):
        low, high = (F.when(size < below, F.lit(x)).otherwise(y) for x, y in ((lo, low), (hi, high)))
    if curves:
        centre, spread, first, last = curves
        at = F.greatest(F.lit(first), F.least(F.lit(last), F.log2(F.greatest(size, F.lit(1)).cast("double")) * CLASSES - 0.5))
        middle = _power(centre, at)
        wide = WIDTH * F.greatest(_power(spread, at), LEAST_SPREAD * middle)
        low, high = F.greatest(low, middle - wide), F.least(high, middle + wide)
    out = F.size(F.filter("chunks", lambda c: ~c.between(chunk_low, chunk_high)))
    share = F.when(F.size("chunks") > 0, out / F.size("chunks")).otherwise(F.lit(0.0))
    judged = measured.select("*", low.alias("low"), high.alias("high"), share.alias("chunks_out"))
    good = F.col("ratio").between(F.col("low"), F.col("high")) & (F.col("chunks_out") <= CHUNKS_OUT)
    names = [field.split()[0] for field in BASE.split(", ")]
    return judged.select(*names, (~F.col("base_failed") & good).alias("kept"), "ratio", "low", "high", "chunks_out")
