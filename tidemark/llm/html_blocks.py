"""HTML pages as sequences of text blocks with the path of tags above each."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape
from zlib import crc32

PATH_SLOTS = 1024

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # Of these elements only an svg can end where it begins; a slash at the end of an unquoted value is part of the value.
    r"""|<(?P<closed>svg)(?=[\s/])(?:\s++|/(?!>)|[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+/>"""
    r"|<(?P<raw>script|style|template|noscript|svg|iframe)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*+>?"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TRUTH = re.compile(r'data-truth="([01])"')
_PARTS = re.compile(r"[^a-z0-9]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub"
    " sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY_NEXT = frozenset("p li dt dd tr td th option".split())


def slot(token: str) -> int:
    return crc32(token.encode()) % PATH_SLOTS


@dataclass(slots=True)
class Block:
    text: str
    slots: list[int]
    linked: int  # characters inside links
    truth: int  # only of training pages: whether the innermost marked element is main text


def blocks(html: str) -> list[Block]:
    """The page's non-empty blocks in order: references decoded, white space as single spaces.

    A block ends where an element that is not inline begins or ends, and at line breaks.
    """
    found: list[Block] = []
    stack: list[tuple[str, list[int], int | None]] = []
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            slots = [s for _, own, _ in stack for s in own]
            closest = [tag for tag, _, _ in stack if tag not in INLINE][-2:]
            slots += [slot(f"{'@' * (len(closest) - i)}{tag}") for i, tag in enumerate(closest)]
            truth = next((t for _, _, t in reversed(stack) if t is not None), 0)
            found.append(Block(text, slots, min(linked, len(text)), truth))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            plain = unescape(text) if "&" in text else text
            pieces.append(plain)
            if any(tag == "a" for tag, _, _ in stack):
                linked += len(plain.strip())

    place = 0
    for m in _MARKUP.finditer(html):
        add(html[place : m.start()])
        place = m.end()
        if m["raw"] or m["closed"]:
            flush()
            continue
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if tag not in INLINE:
            flush()
        if m["end"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if at is not None:
                del stack[at:]
        elif tag not in VOID:
            if tag not in INLINE:
                # An open paragraph or item ends where the next begins, even under open inline elements.
                at = len(stack) - 1
                while at >= 0 and stack[at][0] in INLINE:
                    at -= 1
                if at >= 0 and (stack[at][0] == "p" or stack[at][0] == tag and tag in _CLOSED_BY_NEXT):
                    del stack[at:]
            stack.append(_entry(tag, m["more"]))
    add(html[place:])
    flush()
    return found


def _entry(tag: str, attributes: str) -> tuple[str, list[int], int | None]:
    slots = [slot(tag)]
    if not attributes.strip():
        return tag, slots, None
    for names in _NAMES.findall(attributes):
        for name in "".join(names).lower().split():
            slots += [slot("." + part) for part in {name, *_PARTS.split(name)} if part]
    truth = _TRUTH.search(attributes)
    return tag, slots, int(truth[1]) if truth else None
