"""Classifiers, rules and HTML extraction."""

import brute
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from bazaar.llm import compression, html_blocks, html_labeller, neighbours, toxicity
from bazaar.llm.staging import doc_fold, smallest_hashes

TRAIN_DIR = "/root/testdata/sf0.1"


def auc(score, y):
    score, y = np.asarray(score), np.asarray(y)
    _, inverse, counts = np.unique(score, return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    rank = (ends - (counts - 1) / 2)[inverse]
    p = y.sum()
    return (rank[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


@pytest.mark.parametrize(
    ("scores", "target", "least"),
    [(neighbours.quality_scores, "quality", 0.97), (toxicity.toxicity_scores, "toxic", 0.95)],
)
def test_held_out_accuracy(spark, scores, target, least):
    docs = spark.read.parquet(f"{TRAIN_DIR}/documents.parquet").where("doc_id < 5000")
    labels = spark.read.parquet(f"{TRAIN_DIR}/labels.parquet").where("doc_id < 5000")
    rows = scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    y = [r[target] for r in rows]
    assert auc([r.score for r in rows], y) > least
    assert np.mean([r.predicted == r[target] for r in rows]) > 0.95
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize(("module", "scores", "mod", "out"), [
    (neighbours, neighbours.quality_scores, 3, 1), (toxicity, toxicity.toxicity_scores, 5, 0)
])
def test_held_out_labels_are_never_used(small_docs, small_labels, module, scores, mod, out):
    fold = doc_fold(F.col("doc_id"), mod)
    flipped = small_labels.select(
        "doc_id",
        *[F.when(fold == out, 1 - F.col(c)).otherwise(F.col(c)).alias(c) for c in ("quality", "toxic")],
    )
    a = {r.doc_id: r.score for r in scores(small_docs, small_labels).collect()}
    b = {r.doc_id: r.score for r in scores(small_docs, flipped).collect()}
    assert a == b
    held = {r.doc_id for r in scores(small_docs, small_labels).where("held_out").collect()}
    import zlib

    assert held == {r.doc_id for r in small_docs.collect() if zlib.crc32(str(r.doc_id).encode()) % mod == out}


@pytest.mark.parametrize("scores", [neighbours.quality_scores, toxicity.toxicity_scores])
def test_scores_of_messy_rows(messy, nothing, small_docs, small_labels, scores):
    both = messy.select("doc_id", "text").unionByName(
        small_docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    )
    labels = small_labels.select((F.col("doc_id") + 1000).alias("doc_id"), "quality", "toxic")
    rows = scores(both, labels).collect()
    assert len(rows) == both.count()
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert scores(messy, labels).count() == messy.count()  # no labelled text at all
    assert scores(messy, small_labels.limit(0)).count() == messy.count()
    assert scores(nothing, small_labels).count() == 0


def test_insults_are_found_without_training(messy, small_labels):
    kept = toxicity.drop_toxic(messy, small_labels.limit(0))
    assert kept.columns == messy.columns
    ids = {r.doc_id for r in kept.collect()}
    assert -5 not in ids and {1, 2, 9, 10, 13} <= ids


def test_disguised_insults():
    plain = dict(zip(toxicity.FEATURES, toxicity.features("you are an id1ot and a m0ron", {}), strict=True))
    assert plain["deobfuscated_hits"] == 2 and plain["near_second_person"] >= 1
    clean = dict(zip(toxicity.FEATURES, toxicity.features("version 1.2 of the b2b plan", {}), strict=True))
    assert clean["seed_hits"] == 0 and clean["deobfuscated_hits"] == 0


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.random((2_000, 5))
    y = ((x[:, 0] > 0.6) & (x[:, 3] < 0.5)).astype(float)
    model = toxicity.boost(x, y, rounds=40)
    assert auc(model.margin(x), y) > 0.99
    knots, rates = toxicity.isotonic(model.margin(x), y)
    assert (np.diff(rates) >= 0).all() and (np.diff(knots) > 0).all()


def test_bounded_samples_agree(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"))
    one = [r.doc_id for r in smallest_hashes(keys, F.xxhash64("doc_id"), 500).collect()]
    two = [r.doc_id for r in smallest_hashes(keys.repartition(7), F.xxhash64("doc_id"), 500).collect()]
    every = keys.orderBy(F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 63) - 1))).limit(500).collect()
    assert len(one) == 500 and set(one) == set(two) == {r.doc_id for r in every}


@pytest.mark.parametrize("which", ["messy", "small_docs", "nothing"])
def test_base_counts(request, which):
    docs = request.getfixturevalue(which)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = compression.compression_rules(docs).select("doc_id", *cols, "kept", "ratio").collect()
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    got = sorted(((r.doc_id, *[r[c] for c in cols]) for r in rows), key=order)
    assert got == sorted(((i, *brute.base_counts(t)) for i, t in texts), key=order)
    assert not any(r.kept and r.base_failed for r in rows)
    sizes = {i: (t or "").encode() for i, t in texts}
    for r in rows:
        data = sizes[r.doc_id]
        if data and r.doc_id is not None:
            whole = len(data) / len(zstandard.ZstdCompressor(level=compression.LEVEL).compress(data))
            assert r.ratio == pytest.approx(whole)


def plain_limits(texts):
    """Centre and spread of the corpus by lists and sorting: (class -> low, high) as a function, and the chunk band."""
    z = zstandard.ZstdCompressor(level=compression.LEVEL)
    passing = {t for t in texts if not brute.base_counts(t)[-1]}
    points = {(len(t.encode()), compression.ratio(t.encode(), z)): t for t in passing}

    def quartile(values, share):
        return sorted(values)[max(0, int(np.ceil(share * len(values))) - 1)]

    by_class = {}
    for n, r in points:
        by_class.setdefault(int(np.floor(np.log2(n) * 4)), []).append(r)
    classes = [(c, len(v), *[quartile(v, q) for q in (0.25, 0.5, 0.75)]) for c, v in by_class.items()]
    curves = compression.band_curves(classes)
    chunks = [r for t in points.values() for r in compression.chunk_ratios(t.encode(), z)]

    def band(n):
        low, high = next((lo, hi) for below, lo, hi in compression.BANDS if n < below)
        if curves:
            centre, spread, first, last = curves
            at = min(max(np.log2(max(n, 1)) * 4 - 0.5, first), last)
            middle = np.polyval(centre, at)
            wide = 3.0 * max(np.polyval(spread, at), 0.02 * middle)
            low, high = max(low, middle - wide), min(high, middle + wide)
        return low, high

    low, high = compression.CHUNK_BAND
    if chunks:
        q1, q2, q3 = (quartile(chunks, q) for q in (0.25, 0.5, 0.75))
        wide = 3.0 * max((q3 - q1) / 2 / 0.6745, 0.02 * q2)
        low, high = max(low, q2 - wide), min(high, q2 + wide)
    return band, (low, high)


@pytest.mark.parametrize("which", ["messy", "small_docs", "nothing"])
def test_verdict_against_a_plain_version(request, which):
    docs = request.getfixturevalue(which)
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    band, (chunk_low, chunk_high) = plain_limits([t for _, t in texts])
    z = zstandard.ZstdCompressor(level=compression.LEVEL)
    want = []
    for i, t in texts:
        data = t.encode()
        out = [not chunk_low <= r <= chunk_high for r in compression.chunk_ratios(data, z)]
        low, high = band(len(data))
        good = bool(data) and low <= compression.ratio(data, z) <= high and sum(out) <= 0.25 * len(out)
        want.append((i, good and not brute.base_counts(t)[-1]))
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = [(r.doc_id, r.kept) for r in compression.compression_rules(docs).select("doc_id", "kept").collect()]
    assert sorted(got, key=order) == sorted(want, key=order)


def test_bands_tell_poor_text_from_good(spark):
    labels = spark.read.parquet(f"{TRAIN_DIR}/labels.parquet").where("quality IS NOT NULL")
    judged = compression.compression_rules(spark.read.parquet(f"{TRAIN_DIR}/documents.parquet")).where("NOT base_failed")
    by_ratio, by_chunks = "ratio NOT BETWEEN low AND high", f"chunks_out > {compression.CHUNKS_OUT}"
    rows = (
        judged.join(labels, "doc_id")
        .groupBy("quality")
        .agg(F.count_if(~F.col("kept")).alias("out"), F.count_if(F.expr(by_ratio)).alias("ratio"),
             F.count_if(F.expr(by_chunks)).alias("chunks"), F.count("*").alias("n"))
        .collect()
    )
    poor, good = ({r.quality: r for r in rows}[q] for q in (0, 1))
    assert poor.ratio > 0 and poor.chunks > 0
    assert poor.out / poor.n > 0.5 and good.out / good.n < 0.02


def test_bands_reject_repetitive_and_incompressible_text(spark):
    rng = np.random.default_rng(0)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ+/"))
    words = ["".join(rng.choice(letters[:26], rng.integers(2, 9))) for _ in range(3_000)]
    often = 1 / (np.arange(3_000) + 20)

    def prose(n):
        return " ".join(words[i] for i in rng.choice(3_000, n, p=often / often.sum()))

    noise = " ".join("".join(rng.choice(letters, 60)) for _ in range(150))
    half = prose(1_500) + " " + " ".join("".join(rng.choice(letters, 60)) for _ in range(100))
    spam = " ".join(f"buy now {i % 7} cheap {i % 11}" for i in range(1_500))
    rows = [(i, prose(int(n))) for i, n in enumerate(rng.integers(60, 4_000, 300))]
    rows += [(1000, noise), (1001, half), (1002, spam)]
    rows += [(2000 + i, rows[5][1]) for i in range(200)]  # copies move no limit
    got = {r.doc_id: r for r in compression.compression_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i].kept for i in range(300)) >= 290
    assert not any(got[i].kept for i in (1000, 1001, 1002))
    assert got[1000].ratio < got[1000].low and got[1001].chunks_out > compression.CHUNKS_OUT


HTML = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>x</p>";</script></head>
<body><nav><ul><li><a href=/a>Home</a><li>News</ul></nav><!-- <p>no</p> -->
<article><h1>Head &amp; more</h1><p>One <b>bold</b><br>two&nbsp;&lt;x&gt;<p>Three
  four</p><div>loose<p>inner</p>tail</div></article><p class='comment "q"'>c</p></body>"""


def test_blocks():
    blocks = html_blocks.blocks_of(HTML)
    assert [b.text for b in blocks] == [
        "Home", "News", "Head & more", "One bold two <x>", "Three four", "loose", "inner", "tail", "c",
    ]
    assert blocks[0].linked == 1 and blocks[1].linked == 0
    assert blocks[-1].path[-1] == ("p", ("comment", "q"))
    assert [t for t, _ in blocks[3].path] == ["html", "body", "article", "p"]


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<script>never closed <p>x", "</p></div>", "&#0;", "<a href='x>y</a>z", "<!--"])
def test_broken_pages(page):
    for b in html_blocks.blocks_of(page):
        assert b.text.strip()


def test_extraction_of_all_pages(spark):
    import re
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_labeller.extract(pages).collect()}
    wrong = 0
    for p in pages.collect():
        inside = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        wrong += got[p.page_id].text != "\n".join(x for x in parts if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text)
    assert wrong == 0


def paragraphs(rng, texts, n):
    return [texts[int(k)] for k in rng.integers(0, len(texts), n)]


#: Layouts that training does not make: (name, form of the page, form of an article block). TITLE is the heading.
STRANGE = (
    ("sidebar on the body", "<body class='has-sidebar no-footer'><nav><a href=x>Home</a></nav><article><h1>TITLE</h1>BLOCKS</article></body>", "<p>T</p>"),
    ("share on the article", "<body><article class='article-share-wrap'><h1>TITLE</h1>BLOCKS</article><footer>© 2021</footer></body>", "<p>T</p>"),
    ("logged in", "<body class='logged-in-search has-comments'><div class='main-nav-wrap'><h1>TITLE</h1>BLOCKS</div></body>", "<p>T</p>"),
    ("whole-page form", "<body><form id=aspnetForm><ul><li><a href=x>Home</a></li><li><a href=x>News</a></li></ul>"
     "<div id=ctl00><h1>TITLE</h1>BLOCKS</div></form></body>", "<p>T</p>"),
    ("opaque", "<body><div class=q1><a href=/>Home</a> <a href=/n>News</a></div><div class=q2><div class=q7><h1>TITLE</h1>BLOCKS</div></div>"
     "<div class=q9><a href=x>Privacy policy</a></div></body>", "<div class=q3><p>T</p></div>"),
    ("table layout", "<body><table><tr><td><a href=x>Home</a><br><a href=x>About us</a></td><td><h1>TITLE</h1>BLOCKS</td></tr></table></body>", "<p>T</p>"),
    ("sections", "<body><header><a href=x>Log in</a></header><main id=root><section class=hero><h1>TITLE</h1></section>BLOCKS</main></body>",
     "<section class=row><div><p>T</p></div></section>"),
)


def test_layouts_that_training_cannot_make(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_labeller.fit(pages)
    rng = np.random.default_rng(99)
    texts = [f"Sentence {i} says this and that about the {'old ' * (i % 7)}harbour, and then it ends." for i in range(300)]
    right = total = 0
    missed = {}
    for name, form, block in STRANGE:
        made, truths = [], []
        for _ in range(30):
            inside = paragraphs(rng, texts, int(rng.integers(3, 15)))
            page = form.replace("TITLE", "Harbour reopened").replace("BLOCKS", "".join(block.replace("T", t) for t in inside))
            made.append(html_blocks.blocks_of(page))
            truths.append(np.array([b.text in inside or b.text == "Harbour reopened" for b in made[-1]]))
        for truth, chosen in zip(truths, model.label(made), strict=True):
            right, total = right + int((truth == chosen).sum()), total + len(truth)
            missed[name] = missed.get(name, 0) + int((truth != chosen).sum())
    assert right / total > 0.97, missed


def test_names_of_a_frame_are_not_read(spark):
    model = html_labeller.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    text = "".join(f"<p>Paragraph {i} tells what happened next, at some length.</p>" for i in range(6))
    want = ["Title", *[f"Paragraph {i} tells what happened next, at some length." for i in range(6)]]
    for names in ("", "has-sidebar", "no-footer", "logged-in-search", "has-comments", "has-sidebar no-footer"):
        for mark in ("", " class='article-share-wrap'"):
            blocks = html_blocks.blocks_of(
                f"<body class='{names}'><nav><a href=x>Home</a></nav><article{mark}><h1>Title</h1>{text}</article>"
                "<div class=comments><p>So true, thanks for this.</p></div></body>"
            )
            assert html_labeller.main_text(blocks, model.label([blocks])[0]).split("\n") == want


def test_quotes_and_unclosed_elements():
    def texts(html):
        return [b.text for b in html_blocks.blocks_of(html)]

    assert texts("<p title=Bob's>First</p><p>Second</p><p>We don't stop.</p>") == ["First", "Second", "We don't stop."]
    assert texts('<div class="a"">Lost text.</div><p class="b">End') == ["Lost text.", "End"]
    for tag in ("noscript", "svg", "canvas", "object", "audio", "video", "iframe"):
        assert texts(f"<p>a</p><{tag}><p>b</p><{tag}><p>c") == ["a", "b", "c"]
        assert texts(f"<p>a</p><{tag}>gone</{tag}><p>c") == ["a", "c"]
    assert texts("<p>a</p><script>if (a < b) <p>x") == ["a"]
    assert texts("<a title='x > y' href=z>link</a> on") == ["link on"]
    assert html_blocks.blocks_of("<p data-id=nav title='class=menu' CLASS = 'lead'>t")[0].path == (("p", ("lead",)),)
    assert texts("<svg>" * 20_000 + "<p>end") == ["end"]


def test_network_against_a_step_by_step_version():
    rng = np.random.default_rng(5)
    hidden = html_labeller.HIDDEN
    w = {f"{a}{k}": rng.normal(0, 0.4, (n, 4 * hidden)) for k in (0, 1) for a, n in (("w", html_labeller.DIM), ("u", hidden))}
    w |= {f"b{k}": rng.normal(0, 0.4, 4 * hidden) for k in (0, 1)} | {"v": rng.normal(0, 1, 2 * hidden), "c": np.array(0.1)}
    model = html_labeller.Labeller(w)
    sequences = [rng.normal(0, 1, (n, html_labeller.DIM)) for n in (1, 5, 9)]
    x = np.zeros((9, 3, html_labeller.DIM))
    for j, q in enumerate(sequences):
        x[: len(q), j] = q
    scores, _ = model.logits(model.sums(x), np.array([1, 5, 9]))

    def run(q, k):
        h, c, out = [0.0] * hidden, [0.0] * hidden, []
        for row in q:
            a = [float(row @ w[f"w{k}"][:, m] + np.dot(h, w[f"u{k}"][:, m]) + w[f"b{k}"][m]) for m in range(4 * hidden)]
            gate = [1 / (1 + np.exp(-v)) for v in a[: 3 * hidden]]
            c = [gate[hidden + m] * c[m] + gate[m] * np.tanh(a[3 * hidden + m]) for m in range(hidden)]
            h = [gate[2 * hidden + m] * np.tanh(c[m]) for m in range(hidden)]
            out.append(h)
        return np.array(out)

    for j, q in enumerate(sequences):
        both = np.concatenate([run(q, 0), run(q[::-1], 1)[::-1]], 1)
        assert np.allclose(scores[: len(q), j], both @ w["v"] + w["c"], atol=1e-9)


def test_gradient_of_the_network():
    """Loss falls to near zero on a few pages, which it cannot with wrong gradients."""
    rng = np.random.default_rng(0)
    texts = ["alpha beta gamma.", "delta epsilon, zeta.", "one two three four five."]
    pages = [html_blocks.blocks_of(html_labeller.made_page(texts, rng)) for _ in range(60)]
    model = html_labeller.train(pages, [np.array([b.mark for b in p]) for p in pages])
    wrong = sum(int((y != np.array([b.mark for b in p])).sum()) for p, y in zip(pages, model.label(pages), strict=True))
    assert wrong <= 0.02 * sum(map(len, pages))


def test_long_pages_are_labelled_whole(spark):
    body = "<article>" + "".join(f"<p>Paragraph {i} of a very long page.</p>" for i in range(5_000)) + "</article>"
    pages = spark.createDataFrame(
        [(1, "u", f"<nav><a href=x>Menu</a></nav>{body}<footer>f</footer>"), (2, None, None), (2, None, None), (None, "u", "")],
        "page_id long, url string, html string",
    ).selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS k")
    rows = html_labeller.extract(pages).collect()
    texts = {r.page_id: r.text for r in rows}
    assert len(rows) == 4 and texts[2] == "" and texts[None] == ""
    assert html_labeller.extract(pages.limit(0)).count() == 0
    blocks = html_blocks.blocks_of(pages.where("page_id = 1").first().html)
    model = html_labeller.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    whole, parts = model.label([blocks])[0], model.label([blocks], room=1_000)[0]
    assert (whole == parts).all() and whole[1:-1].all() and not whole[0] and not whole[-1]


def test_toxicity_stage_with_a_clashing_name(small_docs, small_labels):
    plain = toxicity.drop_toxic(small_docs, small_labels)
    clash = toxicity.drop_toxic(small_docs.withColumn("_Toxic_Score", F.lit("x")), small_labels)
    assert clash.columns == [*small_docs.columns, "_Toxic_Score"]
    assert clash.where("`_Toxic_Score` = 'x'").count() == plain.count()
