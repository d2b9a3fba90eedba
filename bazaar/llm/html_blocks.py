"""Leaf blocks of an HTML page: runs of text between block-level boundaries, with their tag path."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# A quote opens a value only after "="; one that nothing closes is part of an unquoted value.
VALUE = r"=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>]*+)"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?>[^>=]+|{VALUE})*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
READ = frozenset(("class", "id", "role", "data-y"))
NAME = re.compile(r"[a-z]+|[0-9]+")

# Element kinds of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rb rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style title textarea iframe noscript noembed template svg xmp object canvas audio video".split())
#: Elements of those that run to the end of the page if nothing closes them; the others are then passed over.
TO_THE_END = frozenset("script style title textarea".split())
#: Start tags that end an open element of the same kind, and where the search for it stops.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}


@dataclass
class Block:
    """Text of one leaf, its open elements as (tag, attribute words), share of linked characters, and a mark."""

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: float
    mark: bool


def _element(tag: str, attributes: str) -> tuple[str, tuple[str, ...], bool]:
    words, mark = [], False
    if attributes and "=" in attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            value, name = a or b or c, name.lower()
            if name == "data-y":
                mark = True
            elif name in READ:
                words += NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower())
    return tag, tuple(words), mark


def blocks_of(html: str | None) -> list[Block]:
    """The page's leaf blocks in page order; character references decoded, white space made single, never empty."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []
    parts: list[str] = []
    linked = 0
    in_link = False
    known: dict[tuple[str, str], tuple[str, tuple[str, ...], bool]] = {}
    endless: set[str] = set()
    html = html or ""

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            path = tuple((t, w) for t, w, _ in stack)
            out.append(Block(text, path, min(1.0, linked / len(text)), any(m for _, _, m in stack)))
        parts.clear()
        linked = 0

    at = 0
    while at < len(html):
        found = TOKEN.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text:
            parts.append(text)
            linked += len(text) if in_link else 0
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not found[1]
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in UNREAD:
            if not found[1] and not found[3].rstrip().endswith("/"):
                end = None
                if tag not in endless:
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                if end:
                    at = end.end()
                elif tag in TO_THE_END:
                    at = len(html)
                else:
                    endless.add(tag)
            flush()
            continue
        flush()
        if tag in VOID:
            continue
        if found[1]:
            if any(t == tag for t, _, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        kinds, stops = ENDS.get(tag, ((), ()))
        for i in range(len(stack) - 1, -1, -1):
            if not kinds or stack[i][0] in stops:
                break
            if stack[i][0] in kinds:
                del stack[i:]
                break
        if not found[3].endswith("/"):
            key = (tag, found[3])
            stack.append(known.setdefault(key, _element(*key)) if key not in known else known[key])
    flush()
    return out
