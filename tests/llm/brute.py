"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import xxhash

BLANK = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; documents may have columns of these names.
CLASHING = ["size", "source_size", "copies", "digest", "fp", "component", "h", "score", "row", "_row", "norm", "at", "m", "n", "t1"]


def messy_rows() -> list[tuple]:
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
    passage = "the same passage is found in several of these documents and is longer than a window " * 8
    return [
        (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa.", "en", "s1", 10),
        (2, "Alpha beta  gamma\tdelta epsilon zeta eta theta iota kappa.", "en", "s1", 10),
        (2, "Alpha beta  gamma\tdelta epsilon zeta eta theta iota kappa.", "en", "s1", 10),
        (3, None, None, None, None),
        (4, "", "en", "s2", 0),
        (5, " \t\n\x0b ", "en", "s2", 5),
        (None, "no identifier here, but words enough to count", "en", None, 3),
        (None, None, None, None, None),
        (6, long_text, "en", "s3", 1),
        (7, long_text + " tail", "en", "s3", 1),
        (8, "x" * 70_000, "de", "s3", 1),
        (9, "start nine " + passage + " end nine", "de", "ß", 1),
        (10, "begin ten " + passage + " close ten", "de", "s1", 1),
        (11, "aaaa" * 400, "fr", "s1", 1),
        (12, "Ünïcode wörds, 漢字 and \U0001f600 emoji <|endoftext|> & more\nsecond line\nsecond line\n", "fr", "Z", 1),
        (-5, "You are an idiot and a moron, you stupid clown! You pathetic worthless loser.", "en", "s1", 1),
        (13, "one two", "en", "s1", 1),
        (14, "one two", "en", "s1", 1),
    ]


def words(text):
    return WORD.findall(text or "")


def components(nodes, near) -> dict:
    """node -> smallest node reachable."""
    nodes = sorted(nodes)
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if near(a, b):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def fingerprint(text, k=3) -> int:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows, distance=3) -> list[tuple]:
    """(doc_id, fingerprint hex, component_id) of (doc_id, text) rows."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    group = components({p for _, p in prints}, lambda a, b: (a ^ b).bit_count() <= distance)
    least = defaultdict(list)
    for i, p in prints:
        if i is not None:
            least[group[p]].append(i)
    return [(i, f"{p:016x}", min(least[group[p]], default=None)) for i, p in prints]


def exact_groups(rows) -> list[tuple]:
    shas = [(i, hashlib.sha256(BLANK.sub(" ", t or "").encode()).hexdigest()) for i, t in rows]
    groups = defaultdict(list)
    for i, s in shas:
        groups[s].append(i)
    keep = {s: min((i for i in g if i is not None), default=None) for s, g in groups.items()}
    return [(i, keep[s], len(groups[s]), i == keep[s], s) for i, s in shas]


def mix(rows, limit=3) -> list[tuple]:
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source) rows."""
    docs = [(i, len(words(t)), s, int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16)) for i, t, s in rows]
    size = Counter()
    for _, n, s, _ in docs:
        size[s] += n
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(size.values()), set()
    while True:
        left = total - sum(limit * size[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        target = {s: Fraction(limit * size[s]) if s in capped else Fraction(left * weight[s], share) for s in order}
        above = {s for s in order if s not in capped and target[s] > limit * size[s]}
        if not above:
            break
        capped |= above
    out = {}
    for s in order:
        times = min(int(target[s] / size[s]), limit) if size[s] else 0
        rest = target[s] - times * size[s]
        cells = Counter()
        for _, n, t, h in docs:
            if t == s and n:
                cells[h] += n
        taken, cut = 0, 0
        for h in sorted(cells):
            if rest <= 0 or taken >= rest:
                break
            if taken + cells[h] < rest or taken + cells[h] - rest <= rest - taken:
                cut = h + 1
            taken += cells[h]
        out[s] = (times, cut)
    return [(i, n, size[s], float(target[s]), n * (out[s][0] + (h < out[s][1]))) for i, n, s, h in docs]


def repeats(texts: list[bytes], window: int) -> list[tuple]:
    """(bytes, removed, spans, sha256 of the rest) of each text."""
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def base_counts(text) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    marked = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 50 or 100 * len(marked) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(marked), failed


def edit_similarity(a: list[str], b: list[str]) -> float:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


def line_fingerprint(words) -> int | None:
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words if len(w) > 3]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else None


def fuzzy_removed(rows, similarity=0.8) -> dict:
    """doc_id -> numbers of removed lines, of (doc_id, text) rows with distinct ids; edit similarity alone decides."""
    lines = {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            norm = " ".join(line.lower().split())
            if norm:
                lines[(i, k)] = norm
    held = {norm: (norm.split(), frozenset(norm.split())) for norm in lines.values()}

    def linked(a, b):
        (a, sa), (b, sb) = held[a], held[b]
        edits = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
        # every word of one line that the other lacks is an edit
        if abs(len(a) - len(b)) > edits or len(sa & sb) < max(len(sa), len(sb)) - edits:
            return False
        return edit_similarity(a, b) >= similarity - 1e-9

    group = components(held, linked)
    first = {}
    for place, norm in sorted(lines.items()):
        first.setdefault(group[norm], place)
    out = {i: [] for i, _ in rows}
    for (i, k), norm in sorted(lines.items()):
        if first[group[norm]] != (i, k):
            out[i].append(k)
    return out
