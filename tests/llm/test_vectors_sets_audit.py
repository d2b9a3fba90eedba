"""Whitening, the filter audit and the Jaccard join against plain Python."""

import random
from collections import Counter, defaultdict
from itertools import permutations

import brute
import numpy as np
import pytest

from bazaar.llm import filter_audit, signature_trees, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def whitened_plainly(rows):
    """vec_id -> (deviation, whitened up to sign by component), and eigenvalues over the trace."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    lengths = Counter(len(v) for _, v in kept)
    d = max(lengths, key=lambda k: (lengths[k], k))
    x = {k: tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v) for k, (_, v) in enumerate(kept) if len(v) == d}
    fit = sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:16], v[:, ::-1][:, :16]
    found = [
        (kept[k][0], sum((n * a - s) ** 2 for a, s in zip(xs, sums, strict=True)), (np.array(xs) - mean) @ v / np.sqrt(e))
        for k, xs in x.items()
    ]
    return n, e / (centred**2).sum() * n, found


def compare(frame):
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    n, share, want = whitened_plainly(rows)
    got = defaultdict(list)
    for r in whitening.whiten(frame).collect():
        got[r.vec_id].append(r)
    assert sorted(got) == sorted({i for i, _, _ in want})
    by_id = defaultdict(list)
    for i, dev, white in want:
        by_id[i].append((dev, white))
    signs = None
    for i, rows in got.items():
        copies = by_id[i]
        assert len(rows) == len(copies) * len(share)
        if len(copies) > 1:
            continue
        rows.sort(key=lambda r: r.component)
        assert {r.n for r in rows} == {n} and {r.deviation for r in rows} == {copies[0][0]}
        assert np.allclose([r.explained for r in rows], share, rtol=1e-9)
        assert max(r.identity_error for r in rows) < 1e-9
        white = np.array([r.whitened for r in rows])
        signs = np.sign(white * copies[0][1]) if signs is None else signs
        assert np.allclose(white * signs, copies[0][1], atol=1e-8)


def test_whitening_of_a_table(spark):
    compare(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))


def test_whitening_of_many_dimensions(spark):
    """More dimensions than the block, so that there is a spectrum to damp."""
    rng = np.random.default_rng(5)
    spread = np.linspace(3, 0.5, 90)
    rows = [(i, (rng.standard_normal(90) * spread).tolist(), 0) for i in range(700)]
    compare(spark.createDataFrame(rows, VECTORS))


def test_whitening_defined_cases(spark):
    rng = np.random.default_rng(6)
    fine = [(i, rng.standard_normal(5).tolist(), 0) for i in range(40)]
    odd = [(90, None, 1), (91, [1.0, None, 2.0, 3.0, 4.0], 1), (92, [float("nan")] * 5, 1), (93, [float("inf")] + [0.0] * 4, 1),
           (94, [1.0, 2.0], 1), (95, [], 1), (0, fine[0][1], 7), (96, fine[1][1], 7)]
    frame = spark.createDataFrame(fine + odd, VECTORS).selectExpr("*", "'x' AS x", "'y' AS n", "0 AS component")
    compare(frame)
    empty = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and empty.columns == [f.split()[0] for f in whitening.SCHEMA.split(", ")]
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], VECTORS)).collect() == []
    # a constant dimension has no variance: one component less
    flat = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 5)], 0) for i in range(35)], VECTORS)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1, 2}


def test_filter_of_the_spectrum():
    """Eigenvalues inside the interval are damped, those above it are not."""
    v = np.diag([10.0, 3.0, 2.0, 1.5, 1.0])
    y = whitening.chebyshev_filter(lambda q: v @ q, np.ones((5, 1)), 12, 1.0, 2.0, 10.0)[:, 0]
    assert abs(y[0] - 1) < 1e-9 and np.abs(y[2:]).max() < y[1] / 1e3


def audited_plainly(docs, labels):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = defaultdict(list)
    for i, text, lang in docs:
        text, w = text or "", brute.words(text)
        capitals = sum("A" <= c <= "Z" for c in text)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * capitals > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": i is not None and text in least and least[text] < i,
        }
        parts[lang or ""].append((i, {f for f, x in fails.items() if x}))
    rows = {}
    for part, held in parts.items():
        removed = Counter()
        for order in permutations("ABCDE"):
            for s, f in enumerate(order):
                before, name = set(order[:s]), "".join(order)
                here = [i for i, x in held if f in x and not x & before]
                removed[f] += len(here)
                rows[part, name, s + 1] = (
                    sum(not x & (before | {f}) for _, x in held), len(here), sum(f in x and bool(x & before) for _, x in held),
                    sum(x == {f} for _, x in held), sum(i in good for i in here), sum(i in toxic for i in here),
                )
        for part_, name, s in list(rows):
            if part_ == part:
                rows[part, name, s] += (removed[name[s - 1]],)
    return rows


def audit_rows(frame):
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in frame.collect()}


@pytest.mark.parametrize("which", ["messy", "small_docs"])
def test_audit(request, which, small_labels):
    docs = request.getfixturevalue(which)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in small_labels.select("doc_id", "quality", "toxic").collect()]
    assert audit_rows(filter_audit.audit(docs, small_labels)) == audited_plainly(rows, labels)


def test_audit_cases(spark, nothing, small_labels, monkeypatch):
    assert filter_audit.audit(nothing, small_labels).collect() == []
    monkeypatch.setattr(filter_audit, "BUCKET_BYTES", 1_000)
    long = " ".join(f"w{i % 301}" for i in range(900))
    rows = [(5, long, "a"), (7, long, "a"), (7, long, "a"), (None, long, None), (9, "\x1cA\u00a0B C" * 300, "b"), (10, "x" * 9_000, "")]
    docs = spark.createDataFrame([(i, t, p, None, 0) for i, t, p in rows], brute.DOCS)
    marks = [(5, 1, None), (5, 0, 1), (7, None, None), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert audit_rows(filter_audit.audit(docs, labels)) == audited_plainly(rows, marks)


def joined_plainly(rows):
    sets = []
    for i, text in rows:
        w = brute.words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    held = defaultdict(list)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (_, s) in enumerate(sets):
        shared = Counter(j for g in s for j in held[g])
        for j, o in shared.items():
            if 100 * o >= 80 * (len(s) + len(sets[j][1]) - o):
                parent[max(root(k), root(j))] = min(root(k), root(j))
        for g in s:
            held[g].append(k)
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets)]


def check_join(frame, **given):
    got = [tuple(r) for r in signature_trees.jaccard_components(frame, **given).collect()]
    want = joined_plainly([tuple(r) for r in frame.select("doc_id", "text").collect()])
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


@pytest.mark.parametrize("which", ["messy", "small_docs", "nothing"])
def test_jaccard_join(request, which):
    check_join(request.getfixturevalue(which))


def family(rng, words, n, edits, first):
    base = rng.choices(words, k=n)
    for k in range(edits[0]):
        copy = list(base)
        for _ in range(rng.randrange(edits[1])):
            copy[rng.randrange(n)] = rng.choice(words)
        yield first + k, " ".join(copy)


def test_jaccard_join_with_frequent_passages(spark, monkeypatch):
    """Frequent shingles, roots of many sets that are cut into chunks, templates near the threshold."""
    monkeypatch.setattr(signature_trees, "CHUNK", 16)
    rng = random.Random(8)
    words = [f"w{k}" for k in range(3_000)]
    rows = list(family(rng, words, 120, (90, 7), 0)) + list(family(rng, words, 60, (60, 8), 1_000))
    passage = rng.choices(words, k=80)
    for k in range(150):  # a shared passage is 60 to 90 % of the text
        rows.append((2_000 + k, " ".join(passage + rng.choices(words, k=rng.randrange(8, 40)))))
    for k in range(60):
        rows.append((3_000 + k, " ".join(rng.choices(words[:9], k=rng.randrange(1, 9)))))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], brute.DOCS)
    got = check_join(docs, frequent=8)
    assert 40 < len({c for _, _, c in got}) < len(rows) - 50


def test_traversal_finds_every_pair_that_links():
    """Bounds of nodes never rule out a pair that links, in one tree and between two."""
    rng = np.random.default_rng(3)
    universe = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    sets = []
    for _ in range(30):
        base = rng.choice(universe, rng.integers(4, 90), replace=False)
        for _ in range(rng.integers(1, 8)):
            sets.append(np.unique(np.concatenate((base[rng.random(len(base)) > 0.08], rng.choice(universe, 2)))))
    n = np.array([len(s) for s in sets])
    bits = np.stack([signature_trees.bitmap(s) for s in sets])
    leaves = lambda k: signature_trees.Nodes.of_sets(bits[k], n[k], n[k], np.arange(len(n))[k])
    linked = {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
        if 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (n[i] + n[j] - o)
    }
    order = np.argsort(n, kind="stable")
    found = {tuple(sorted((int(order[i]), int(order[j])))) for x, y in signature_trees.traverse(leaves(order)) for i, j in zip(x, y, strict=True)}
    assert linked <= found and len(found) < len(sets) ** 2 / 4
    left, right = order[: len(order) // 3], order[len(order) // 3 :]
    pairs = {
        tuple(sorted((int(left[i]), int(right[j]))))
        for x, y in signature_trees.traverse(leaves(left), leaves(right)) for i, j in zip(x, y, strict=True)
    }
    inside = set(left.tolist())
    assert {p for p in linked if (p[0] in inside) != (p[1] in inside)} <= pairs


def test_components_at_a_root_meet_its_least_before_all_pairs(spark, monkeypatch):
    """Near copies that no min-hash has linked: as many pairs as sets, not as pairs of them."""
    from bazaar.llm import signature_trees as trees

    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    copies = [(k, " ".join([*words[:290], f"end{k}"])) for k in range(30)]
    docs = spark.createDataFrame([*copies, (90, " ".join(words[::-1]))], "doc_id long, text string")
    pairs, verified = {}, trees.Join.verified

    def counted(self, found, label):
        pairs[label] = found.count()
        return verified(self, found, label)

    monkeypatch.setattr(trees.Join, "verified", counted)
    monkeypatch.setattr(trees.Join, "near_copies", lambda self: self.nodes.selectExpr("id AS a", "id AS b").where("false"))
    got = {r.doc_id: r.component_id for r in trees.jaccard_components(docs).collect()}
    assert got == {k: 0 for k in range(30)} | {90: 90}
    assert 0 < sum(pairs.values()) <= 60


def test_a_pair_is_not_put_out_at_every_root_that_it_has(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    passage = [word() for _ in range(400)]
    rows = [(i, " ".join(passage + [word() for _ in range(55)])) for i in range(30)]
    found, trees = [], signature_trees.small_trees

    def counted(frame):
        pairs = trees(frame)
        found.extend((min(r.a, r.b), max(r.a, r.b)) for r in pairs.collect())
        return pairs

    monkeypatch.setattr(signature_trees, "small_trees", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # 396 of 506 shingles are common to two of them: every pair is looked at, none links
    assert {(r.doc_id, r.component_id) for r in signature_trees.jaccard_components(docs).collect()} == {(i, i) for i in range(30)}
    assert len(set(found)) == 30 * 29 // 2
    assert len(found) <= 2 * len(set(found))
