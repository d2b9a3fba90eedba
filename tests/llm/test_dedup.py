"""Exact, near, line and repeated-string removal against plain Python."""

import random

import brute
import numpy as np
import pytest

from bazaar.llm import columnwise, components, exact_dedup, fuzzy_lines, repeats, simhash
from bazaar.llm.staging import Scratch


def pairs_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def key(row):
    return tuple((x is None, "" if x is None else x) for x in row)


@pytest.mark.parametrize("which", ["messy", "small_docs", "nothing"])
def test_exact_groups(request, which):
    docs = request.getfixturevalue(which)
    got = pairs_of(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(got, key=key) == sorted(brute.exact_groups(pairs_of(docs, "doc_id", "text")), key=key)


def test_exact_survivors_keep_whole_rows(messy):
    kept = exact_dedup.drop_exact_copies(messy)
    assert kept.columns == messy.columns
    rows = pairs_of(kept, "doc_id", "text")
    expected = {s: k for _, k, _, _, s in brute.exact_groups(pairs_of(messy, "doc_id", "text"))}
    assert sorted((r[0] for r in rows), key=lambda x: (x is None, x or 0)) == sorted(
        expected.values(), key=lambda x: (x is None, x or 0)
    )
    assert all(r["size"] == "x" and r["_row"] == "x" for r in kept.collect())


def test_index_persists_and_grows(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index", buckets=4)
    first = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "a\tb"), (5, "d"), (6, "d")], "doc_id long, text string")
    assert sorted(r.doc_id for r in exact_dedup.drop_exact_copies(first, index, "a").collect()) == [1, 3]
    again = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index", buckets=4)
    assert [r.doc_id for r in exact_dedup.drop_exact_copies(second, again, "b").collect()] == [5]
    rows = sorted((r.keep_id, r.n_rows) for r in again.read().collect())
    assert rows == [(1, 2), (3, 1), (5, 2)]
    plan = again.unseen(exact_dedup.groups_of(exact_dedup.digests(second)))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_a_repeated_batch_loses_nothing(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index", buckets=4)
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "b"), (5, "c"), (6, None), (7, "c"), (8, "d")], "doc_id long, text string")

    def kept(rows, batch):
        return sorted(r.doc_id for r in exact_dedup.drop_exact_copies(rows, index, batch).collect())

    assert kept(first, "a") == [1, 2] == kept(first, "a")
    # a lost job that had appended a part of its batch, or all of it
    index.append(exact_dedup.groups_of(exact_dedup.digests(second.where("doc_id = 5"))), "b")
    assert kept(second, "b") == [5, 6, 8] == kept(second, "b")
    assert kept(second, "c") == [] and kept(first, "a") == [1, 2]
    held = [r.digest for r in index.read().collect()]
    assert len(held) == len(set(held)) == 5
    groups = exact_dedup.exact_groups(second, index, "b")
    assert sorted(pairs_of(groups, "doc_id", "keep_id")) == [(4, 2), (5, 5), (6, 6), (7, 5), (8, 8)]
    with pytest.raises(ValueError, match="name"):
        exact_dedup.drop_exact_copies(first, index)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 2000 + i) for i in range(50)]
    links += [(rng.randrange(5000, 5300), rng.randrange(5000, 5300)) for _ in range(200)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = dict(pairs_of(components.connected_components(frame, Scratch(spark, "test")), "node", "component"))
    linked = {(min(p), max(p)) for p in links}
    nodes = {x for p in links for x in p if p[0] != p[1]}
    assert got == brute.components(nodes, lambda a, b: (a, b) in linked)


def test_components_of_nothing(spark):
    frame = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(frame, Scratch(spark, "test")).count() == 0


@pytest.mark.parametrize("text", ["", "one", "one two", "One TWO three", "a b c d e f g a b c", "é È x y z", "x " * 700])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode(), 3) % 2**64 == brute.fingerprint(text)


@pytest.mark.parametrize("which", ["messy", "small_docs", "nothing"])
def test_simhash_components(request, which):
    docs = request.getfixturevalue(which)
    got = pairs_of(simhash.simhash_components(docs), "doc_id", "fingerprint", "component_id")
    assert sorted(got, key=key) == sorted(brute.simhash_groups(pairs_of(docs, "doc_id", "text")), key=key)


@pytest.mark.parametrize("seed", range(3))
def test_near_links_join_all_pairs_within_distance(spark, seed):
    rng = random.Random(seed)
    prints = set()
    for _ in range(25):  # dense balls, chains and loners
        centre = rng.getrandbits(64)
        prints.add(centre)
        for _ in range(rng.choice([0, 1, 3, 25])):
            near = centre
            for b in rng.sample(range(64), rng.randint(1, 4)):
                near ^= 1 << b
            prints.add(near)
            centre = near if rng.random() < 0.3 else centre
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    scratch = Scratch(spark, "test")
    links = simhash.near_links(nodes, 3, scratch).collect()
    groups = brute.components(signed, lambda a, b: ((a ^ b) % 2**64).bit_count() <= 3)
    got = {n: n for n in signed}
    frame = spark.createDataFrame(links or [(0, 0)], "a long, b long")
    got.update(pairs_of(components.connected_components(frame, scratch), "node", "component"))
    assert {n: got[n] for n in signed} == groups


def test_thresholds_sum_to_what_the_pigeonhole_needs():
    cost = np.random.default_rng(0).random((50, 3, 5))
    picked = simhash.allocate(cost)
    assert ((picked + 1).sum(1) == 4).all() and picked.min() >= -1
    best = min(
        sum(cost[0, i, t] for i, t in enumerate(ts)) for ts in np.ndindex(5, 5, 5) if sum(ts) == 4
    )
    assert np.isclose(sum(cost[0, i, picked[0, i] + 1] for i in range(3)), best)


def test_near_survivors(messy):
    groups = brute.simhash_groups(pairs_of(messy, "doc_id", "text"))
    kept = simhash.drop_near_copies(messy)
    assert kept.columns == messy.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect())
    assert ids == sorted({c for _, _, c in groups if c is not None})


def test_columnwise_against_brute_force():
    rng = random.Random(1)
    for _ in range(25):
        window = rng.choice([16, 32, 48])
        base = bytes(rng.choices(b"ab", k=300))
        texts = [bytes(rng.choices(b"ab", k=40))]
        for _ in range(rng.randint(1, 10)):
            a = rng.randint(0, 200)
            texts.append(bytes(rng.choices(b"abc", k=rng.randint(0, 40))) + base[a : a + rng.randint(0, 90)])
        lengths = np.array([len(t) for t in texts])
        got = columnwise.repeated_windows(b"".join(texts), np.cumsum(lengths) - lengths, lengths, window)
        seen = {}
        for t in texts:
            for i in range(len(t) - window + 1):
                seen[t[i : i + window]] = seen.get(t[i : i + window], 0) + 1
        for t, marks in zip(texts, got, strict=True):
            assert marks.tolist() == [seen[t[i : i + window]] > 1 for i in range(len(t) - window + 1)]


def test_columnwise_rounds_of_wide_symbols(monkeypatch):
    """A window of 400 bytes is 10 symbols; a piece of 672 bytes takes 16 rounds over all suffixes, not 42."""
    rng = random.Random(11)
    window = 400
    base = bytes(rng.choices(b"abcd", k=900))
    texts = [base[:672], base[100:772], bytes(rng.choices(b"ab", k=500)), (b"xyz" * 300)[:672], base[50:449], b""]
    rounds = []
    insert = columnwise.Collection.insert
    monkeypatch.setattr(columnwise.Collection, "insert", lambda self, *a: (rounds.append(1), insert(self, *a)))
    lengths = np.array([len(t) for t in texts])
    got = columnwise.repeated_windows(b"".join(texts), np.cumsum(lengths) - lengths, lengths, window)
    assert len(rounds) == 672 // 40
    seen = {}
    for t in texts:
        for i in range(len(t) - window + 1):
            seen[t[i : i + window]] = seen.get(t[i : i + window], 0) + 1
    for t, marks in zip(texts, got, strict=True):
        assert marks.tolist() == [seen[t[i : i + window]] > 1 for i in range(len(t) - window + 1)]


def test_range_minima():
    rng = np.random.default_rng(4)
    for n in (1, 7, 8, 9, 64, 1_000):
        values = rng.integers(0, 255, n).astype(np.uint8)
        first = rng.integers(0, n, 500)
        end = first + 1 + (rng.random(500) * (n - first)).astype(np.int64)
        got = columnwise.Minima(values).of(first, end)
        assert got.tolist() == [int(values[a:b].min()) for a, b in zip(first, end, strict=True)]


def repeated(docs):
    frame = repeats.remove_repeats(docs)
    assert frame.where("lost_bytes != (n_removed > 0)").count() == 0
    got = pairs_of(frame, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    rows = pairs_of(docs, "doc_id", "text")
    want = brute.repeats([(t or "").encode() for _, t in rows], repeats.WINDOW)
    assert sorted(got, key=key) == sorted(((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=key)


def test_repeats_messy(messy):
    repeated(messy.where("doc_id IS NULL OR doc_id NOT IN (6, 7, 8)"))


def test_repeats_long_texts(spark, monkeypatch):
    """Texts beyond one batch are cut into parts that lose no window."""
    monkeypatch.setattr(repeats, "BATCH_BYTES", 3_000)
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefgh ", k=1_500))
    texts = ["".join(rng.choices("abcdefgh ", k=n)) + passage + "".join(rng.choices("xyz ", k=5_000)) for n in (10, 2_400, 7_000)]
    parts = list(repeats._parts([texts[2].encode()]))
    assert len(parts) > 1
    starts = sorted({shift + s for p, shift, _ in parts for s in range(len(p[0]) - repeats.WINDOW + 1)})
    assert starts == list(range(len(texts[2]) - repeats.WINDOW + 1))
    repeated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_repeats_small_table(small_docs):
    repeated(small_docs)


def test_repeats_hot_hashes_window_by_window(spark, monkeypatch):
    """A passage shared by more different surroundings than a block takes."""
    monkeypatch.setattr(repeats, "GROUP", 3)
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choices("abcdefghij klmnop", k=n))
    passage = noise(700)
    rows = [(i, noise(300 + 7 * i) + passage + noise(350)) for i in range(12)]
    rows += [(20, rows[0][1]), (21, noise(500)), (22, "ab" * 900)]
    repeated(spark.createDataFrame(rows, "doc_id long, text string"))


def test_repeats_empty(nothing):
    assert repeats.remove_repeats(nothing).count() == 0


def test_fuzzy_lines_groups(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 10))) for _ in range(400)]
    line = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base = [line(rng.randint(12, 90)) for _ in range(25)]
    rows = []
    for i in range(150):
        b = rng.randrange(25)
        w = base[b].split()
        kind = rng.random()
        if kind < 0.3:
            text = " " + base[b].upper().replace(" ", "  ", 2) + "\t"  # equal once normalised
        elif kind < 0.9:
            for _ in range(rng.choice([1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(["a", "changed", "is", vocabulary[0]])
            text = " ".join(w)
        else:
            text = line(20)
        rows.append((i, f"{text}\nshort one\n{line(15)}"))
    got = {r.doc_id: r for r in fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.fuzzy_removed(rows)
    assert {i: r.removed for i, r in got.items()} == want
    assert all(r.n_removed == len(r.removed) for r in got.values())
    norms = {" ".join(t.split("\n")[0].lower().split()) for _, t in rows}
    assert sum(map(len, want.values())) > 150 - len(norms) + 10  # near lines too, not just equal ones


def test_fuzzy_lines_of_a_table(small_docs):
    got = {r.doc_id: r.removed for r in fuzzy_lines.dedup_lines(small_docs).collect()}
    assert got == brute.fuzzy_removed(pairs_of(small_docs, "doc_id", "text"))


def test_fuzzy_lines_native_and_messy(messy, nothing):
    out = fuzzy_lines.dedup_lines(messy)
    assert out.count() == messy.select("doc_id").distinct().count()
    for frame in (fuzzy_lines.lines_of(messy), fuzzy_lines.fuzzy_line_decisions(messy)):
        assert not any(x in frame._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))
    assert fuzzy_lines.dedup_lines(nothing).count() == 0


def test_lines_are_taken_out(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "a"), (3, None)], "doc_id long, text string")
    removed = spark.createDataFrame([(1, [1]), (2, [])], "doc_id long, removed array<int>")
    got = dict(pairs_of(fuzzy_lines.without_lines(docs, removed), "doc_id", "text"))
    assert got == {1: "a\nc", 2: "a", 3: None}
