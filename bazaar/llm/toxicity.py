"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a fixed and of a learned insult lexicon,
closeness of insults to second-person words, capitals, punctuation and
obfuscation rates. The learned lexicon, the trees and the calibration come from a
bounded sample of labelled rows (``TRAIN_ROWS``); the features of a training row
use a lexicon learned on the other folds only. Every row of the table is scored,
on its whole text.

Defined cases: a null or empty text has all features zero and gets a score like
any other; a null ``doc_id`` is scored with ``held_out`` false; repeated rows are
scored each; without any usable label the score is 0.5 times the fixed-lexicon
signal, so that nothing without an insult is predicted toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.staging import doc_fold, free_name, smallest_hashes

#: Bound on the labelled rows that the model is fitted on.
TRAIN_ROWS = 16_000
#: Bound on the learned lexicon.
LEXICON_SIZE = 2_000
FOLDS = 3

# Common English insults.
SEED_LEXICON = frozenset(
    "ass asshole bastard bitch clown creep crap cretin damn dimwit disgusting dumb dumbass fool filth filthy "
    "freak fuck fucking garbage hate idiot idiotic imbecile jerk kill lame loser losers lunatic maggot moron "
    "moronic nasty pathetic pig rat retard scum shit shut sick stupid suck sucks trash ugly useless vermin "
    "vile worthless wretch".split()
)
# Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself youre u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)
# Characters that stand for letters in obfuscated words.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

EDGE = ".,;:!?\"'()[]{}<>|#*%&$@-_~`´’‘“”…«»¿¡/\\="
NON_WORD = re.compile(r"[^\w]|_")
RUNS = re.compile(r"(.)\1{2,}")
PUNCT_RUN = re.compile(r"[!?]{2,}")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
UPPER_WORD = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
OBFUSCATED = re.compile(r"[^\W\d_][0-9@$*#!%&]+[^\W\d_]")

FEATURES = (
    "seed_hits", "seed_density", "learned_hits", "learned_density", "learned_weight", "learned_weight_density",
    "learned_max", "learned_distinct", "near_second_person", "second_person_rate", "capital_rate",
    "capital_word_rate", "exclaim_rate", "punct_run_rate", "symbol_rate", "obfuscated_rate",
    "deobfuscated_hits", "log_words",
)


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(EDGE) for x in text.lower().split()) if w]


def plain_form(word: str) -> str:
    """A word with look-alike characters, inner punctuation and letter runs undone."""
    return RUNS.sub(r"\1", NON_WORD.sub("", word.translate(LEET)))


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.lower().split()
    n = max(len(raw), 1)
    hits, seed, weight, top, hidden, odd = [], 0, 0.0, 0.0, 0, 0
    found = set()
    for i, token in enumerate(raw):
        w = token.strip(EDGE)
        known, learned = w in SEED_LEXICON, lexicon.get(w)
        if not known and learned is None:
            if w.isalpha() or not w:
                continue
            if OBFUSCATED.search(w):
                odd += 1
                w = plain_form(w)
                known, learned = w in SEED_LEXICON, lexicon.get(w)
                if not known and learned is None:
                    continue
                hidden += 1
            else:
                continue
        hits.append(i)
        seed += known
        if learned is not None:
            weight += learned
            top = max(top, learned)
            found.add(w)
    learned_hits = len(hits) if lexicon else 0
    second = [i for i, t in enumerate(raw) if t.strip(EDGE) in SECOND_PERSON] if hits else []
    near = 0
    if second:
        at = np.searchsorted(second, hits)
        for i, k in zip(hits, at, strict=True):
            near += any(abs(second[j] - i) <= 5 for j in (k - 1, k) if 0 <= j < len(second))
    size = len(text)
    return [
        seed, 100 * seed / n, learned_hits, 100 * learned_hits / n, weight, 100 * weight / n, top, len(found), near,
        100 * len(second) / n, 100 * len(UPPER.findall(text)) / size, 100 * len(UPPER_WORD.findall(text)) / n,
        100 * text.count("!") / n, 100 * len(PUNCT_RUN.findall(text)) / n,
        100 * sum(map(text.count, "#*%&$@|")) / size, 100 * odd / n, hidden, float(np.log1p(n)),
    ]


# -- trees -------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Boosted:
    """Trees of fixed depth: per tree and inner node a feature and a cut, per leaf a value."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - (len(v) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48) -> Boosted:
    """Newton boosting on the logistic loss, over quantile-binned features."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    # zero is the common value of rates: keep it apart from the smallest positive ones
    cuts = [np.unique(np.append(c, 0.0)) for c in cuts]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    width_bins = max(len(c) for c in cuts) + 1
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(prior / (1 - prior)))
    margin = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    fs, cs, vs = [], [], []
    for _ in range(rounds):
        p = _sigmoid(margin)
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        f, c = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(count)
            at_bin = np.full(count, width_bins)
            for j in range(width):
                slot = local * width_bins + binned[:, j]
                gs = np.bincount(slot, g, count * width_bins).reshape(count, -1).cumsum(1)
                hs = np.bincount(slot, h, count * width_bins).reshape(count, -1).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(hs < 0.5) | (ht - hs < 0.5)] = 0
                gain = gain[:, : len(cuts[j])]
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                better = top > best + 1e-9
                best[better], at_bin[better], f[first : first + count][better] = top[better], k[better], j
            for q in range(count):
                if at_bin[q] < width_bins:
                    c[first + q] = cuts[f[first + q]][at_bin[q]]
            node = 2 * node + 1 + (x[np.arange(n), f[node]] > c[node])
        slot = node - inner
        value = rate * np.bincount(slot, g, leaves) / (np.bincount(slot, h, leaves) + 1)
        margin += value[slot]
        fs.append(f), cs.append(c), vs.append(value)
    return Boosted(base, np.array(fs), np.array(cs), np.array(vs))


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots (mean margin, smoothed rate) of the blocks."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []
    for m, t in zip(margin[order], y[order], strict=True):
        blocks.append([t, 1.0, m])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            t2, w2, m2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t2, blocks[-1][1] + w2, blocks[-1][2] + m2]
    x = np.array([m / w for _, w, m in blocks])
    p = np.array([(t + 0.02) / (w + 0.04) for t, w, _ in blocks])
    return x, np.maximum.accumulate(np.clip(p, 0.0005, 0.9995))


# -- model -------------------------------------------------------------------


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Boosted | None
    knots: tuple[np.ndarray, np.ndarray] | None

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts], float).reshape(len(texts), len(FEATURES))
        if self.trees is None:
            return np.clip(0.45 + 0.1 * (x[:, 0] > 0), 0, 1)
        m = self.trees.margin(x)
        # a small share of the margin itself keeps the order inside an isotonic block
        flat = np.interp(m, *self.knots)
        out = 0.999 * flat + 0.001 * _sigmoid(m)
        return np.where((flat >= 0.5) == (out >= 0.5), out, flat)


def training_rows(docs: DataFrame, labels: DataFrame, target: str, held_out, rows: int) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents outside the held-out fold.

    The ids with the smallest hashes are taken, so reruns agree. The sample is
    bounded by ``rows``, which is what allows it to be broadcast.
    """
    ids = (
        labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("y"))
    )
    ids = smallest_hashes(ids, F.xxhash64("doc_id"), rows)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, np.ndarray] = {}
        cols = [batch.column(i).to_pylist() for i in range(3)]
        for text, y, fold in zip(*cols, strict=True):
            for w in set(words_of(text or "")):
                if len(w) <= 40:
                    counts.setdefault(w, np.zeros(2 * FOLDS, np.int64))[2 * fold + y] += 1
        table = np.array(list(counts.values()), np.int64).reshape(len(counts), 2 * FOLDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), *[pa.array(table[:, k]) for k in range(2 * FOLDS)]],
            names=["word", *[f"c{k}" for k in range(2 * FOLDS)]],
        )


def _lexicon(counts: list, use: list[int], docs: np.ndarray) -> dict[str, float]:
    """Words with a high smoothed log odds of the label, by the folds in ``use``."""
    pos_docs, neg_docs = docs[use, 1].sum(), docs[use, 0].sum()
    scored = []
    for word, row in counts:
        pos, neg = sum(row[2 * f + 1] for f in use), sum(row[2 * f] for f in use)
        odds = np.log((pos + 0.1) / (pos_docs + 1)) - np.log((neg + 0.5) / (neg_docs + 1))
        if pos >= 3 and odds > 1.5:
            scored.append((odds * np.sqrt(pos), word, float(odds)))
    scored.sort(key=lambda s: (-s[0], s[1]))
    return {w: o for _, w, o in scored[:LEXICON_SIZE]}


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", rows: int = TRAIN_ROWS, held_out=None) -> Model:
    """Fit lexicon, trees and calibration on at most ``rows`` labelled rows."""
    held_out = doc_fold(F.col("doc_id"), 5) == 0 if held_out is None else held_out
    sample = training_rows(docs, labels, target, held_out, rows).select(
        "text", "y", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold")
    )
    schema = T.StructType(
        [T.StructField("word", T.StringType())] + [T.StructField(f"c{k}", T.LongType()) for k in range(2 * FOLDS)]
    )
    per_fold = [F.sum(f"c{k}").alias(f"c{k}") for k in range(2 * FOLDS)]
    positive = sum((F.col(f"c{2 * f + 1}") for f in range(FOLDS)), F.lit(0))
    everything = sum((F.col(f"c{k}") for k in range(2 * FOLDS)), F.lit(0))
    words = (
        sample.mapInArrow(_count_words, schema)
        .groupBy("word")
        .agg(*per_fold)
        .where((positive >= 3) & (positive * 4 >= everything))
        .orderBy(positive.desc(), "word")
        .limit(8 * LEXICON_SIZE)
        .collect()
    )
    counts = [(r[0], tuple(r)[1:]) for r in words]
    n_docs = np.zeros((FOLDS, 2))
    for r in sample.groupBy("fold", "y").count().collect():
        n_docs[r["fold"], r["y"]] = r["count"]
    if n_docs.sum(0).min() < 5:
        return Model({}, None, None)
    every = list(range(FOLDS))
    lexicons = [_lexicon(counts, [g for g in every if g != f], n_docs) for f in every]
    lexicon = _lexicon(counts, every, n_docs)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, y, fold = (batch.column(i).to_pylist() for i in range(3))
            x = [features(t, lexicons[f]) for t, f in zip(text, fold, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.int32()), pa.array(fold, pa.int32())],
                names=["x", "y", "fold"],
            )

    got = sample.mapInArrow(featurise, "x array<double>, y int, fold int").toArrow().to_pydict()  # bounded by rows
    x, y, fold = np.array(got["x"]), np.array(got["y"], float), np.array(got["fold"])
    order = np.lexsort((*x.T, y, fold))  # task order must not change the fit
    x, y, fold = x[order], y[order], fold[order]
    margin = np.zeros(len(y))
    for f in every:
        if (fold == f).any():
            margin[fold == f] = boost(x[fold != f], y[fold != f]).margin(x[fold == f])
    return Model(lexicon, boost(x, y), isotonic(margin, y))


def append_scores(docs: DataFrame, model, column: str) -> DataFrame:
    """All columns of ``docs`` and the model's score of each whole text as ``column``."""
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.concatenate(
                [np.zeros(0)]
                + [model.score(batch.column(at).slice(i, 512).to_pylist()) for i in range(0, batch.num_rows, 512)]
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, column]
            )

    return docs.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = append_scores(slim, fit(slim, labels, rows=rows), "score")
    return scored.select(
        "doc_id",
        F.coalesce(doc_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows that the model rejects."""
    model = fit(docs, labels, rows=rows)
    score = free_name(docs, "_toxic_score")
    return append_scores(docs, model, score).where(F.col(score) < 0.5).drop(score)
