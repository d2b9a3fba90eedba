"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A text's terms are hashed words, shapes (three classes of characters in a row) and
how often its words and lines repeat. A truncated singular value decomposition of
the weighted terms of labelled texts gives the latent space. The labelled vectors,
at most ``TRAIN_ROWS`` of ``RANK`` numbers, are broadcast; every document is
compared with all of them in blocks, and its nearest labelled texts vote with
their similarity.

Defined cases: a null or empty text has no direction and gets the share of label 1
among the labelled rows; a null doc_id is scored with ``held_out`` false; repeated
rows are scored each; without labels every score is 0.5.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.staging import doc_fold
from bazaar.llm.toxicity import append_scores, training_rows

#: Bound on the labelled rows: they are fitted on, broadcast and compared with.
TRAIN_ROWS = 4_096
RANK = 48
NEIGHBOURS = 25
#: Votes weigh similarity to this power: near neighbours count for more.
POWER = 8
WORD_TERMS = 1_024
CLASSES = 16
REPEAT_TERMS = 12
TERMS = WORD_TERMS + CLASSES**3 + 2 * REPEAT_TERMS
BLOCK = 256


def _classes() -> np.ndarray:
    table = np.full(256, 15, np.uint16)
    groups = [b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\v\f\r", b"\n",
              b".,;:", b"!", b"?", b"'\"`", b"#*$%&@", b"|", b"<>{}[]\\^~", b"()-_/=+"]
    for k, chars in enumerate(groups):
        table[list(chars)] = k
    table[128:] = 14  # part of a character beyond ASCII
    return table


CLASS_OF = _classes()


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and counts of a whole text."""
    data = (text or "").encode()
    if not data:
        return np.zeros(0, np.int64), np.zeros(0)
    counts = np.zeros(TERMS)
    kinds = CLASS_OF[np.frombuffer(data, np.uint8)]
    if len(kinds) > 2:
        shape = (kinds[:-2] << 8) | (kinds[1:-1] << 4) | kinds[2:]
        counts[WORD_TERMS : WORD_TERMS + CLASSES**3] = np.bincount(shape, minlength=CLASSES**3)
    words = Counter(data.lower().split())
    times = np.fromiter(words.values(), np.int64, len(words))
    slots = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % WORD_TERMS
    counts[:WORD_TERMS] = np.bincount(slots, times, WORD_TERMS)
    at = WORD_TERMS + CLASSES**3
    for values in (times, np.fromiter(Counter(data.split(b"\n")).values(), np.int64)):
        if len(values):
            level = np.minimum(np.log2(values).astype(np.int64), REPEAT_TERMS - 1)
            counts[at : at + REPEAT_TERMS] = np.bincount(level, values, REPEAT_TERMS)
        at += REPEAT_TERMS
    found = np.flatnonzero(counts)
    return found, counts[found]


def weigh(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vector of damped shares of a text's terms: its direction does not depend on its length."""
    row = np.zeros(TERMS, np.float32)
    if len(found):
        row[found] = np.sqrt(counts / counts.sum()) * idf[found]
        row /= max(float(np.linalg.norm(row)), 1e-9)
    return row


def truncated_svd(a: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the largest ``rank`` singular values, by randomised subspace iteration."""
    rng = np.random.default_rng(0)
    q = np.linalg.qr(a @ rng.standard_normal((a.shape[1], rank + 12)).astype(a.dtype))[0]
    for _ in range(4):
        q = np.linalg.qr(a @ (a.T @ q))[0]
    return np.linalg.svd(q.T @ a, full_matrices=False)[2][:rank].T


@dataclass
class Voters:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def embed(self, rows: np.ndarray) -> np.ndarray:
        latent = rows @ self.basis
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def vote(self, latent: np.ndarray) -> np.ndarray:
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return np.full(len(latent), 0.5)
        similar = latent @ self.vectors.T
        near = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(similar, near, 1), 0).astype(np.float64) ** POWER
        votes = (weight * self.labels[near]).sum(1) + 1e-3 * self.prior
        return votes / (weight.sum(1) + 1e-3)

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for s in range(0, len(texts), BLOCK):
            rows = np.stack([weigh(*terms(t), self.idf) for t in texts[s : s + BLOCK]])
            out[s : s + BLOCK] = self.vote(self.embed(rows))
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = TRAIN_ROWS, held_out=None) -> Voters:
    held_out = doc_fold(F.col("doc_id"), 3) == 1 if held_out is None else held_out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [terms(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f for f, _ in got], pa.list_(pa.int32())),
                    pa.array([c for _, c in got], pa.list_(pa.float32())),
                    batch.column("y"),
                ],
                names=["doc_id", "found", "counts", "y"],
            )

    sample = training_rows(docs, labels, target, held_out, rows)
    got = sample.mapInArrow(run, "doc_id long, found array<int>, counts array<float>, y int").toArrow().to_pydict()
    order = np.argsort(got["doc_id"], kind="stable")
    n = len(order)
    if not n:
        empty = np.zeros((0, RANK), np.float32)
        return Voters(np.ones(TERMS, np.float32), np.zeros((TERMS, RANK), np.float32), empty, np.zeros(0))
    seen = np.zeros(TERMS)
    for f in got["found"]:
        seen[f] += 1
    idf = np.log((1 + n) / (1 + seen)).astype(np.float32) + np.float32(1)
    a = np.stack([weigh(np.array(got["found"][i], np.int64), np.array(got["counts"][i]), idf) for i in order])
    basis = truncated_svd(a, min(RANK, n))
    voters = Voters(idf, basis.astype(np.float32), np.zeros((0, RANK), np.float32), np.array(got["y"], float)[order])
    voters.vectors = voters.embed(a).astype(np.float32)
    return voters


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = append_scores(slim, fit(slim, labels, rows=rows), "score")
    return scored.select(
        "doc_id",
        F.coalesce(doc_fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
