"""Leaf blocks of an HTML page: runs of inline text between block tags, with their ancestors."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Element names of HTML by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript iframe object svg math canvas head title textarea select".split())
RAW = frozenset("script style textarea title iframe noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img br input button".split()
)
#: What a start tag closes when it is open, up to the nearest of the bounds.
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))")
_SPACE = re.compile(r"\s+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]  # from the outermost to the block's own element
    path: tuple[int, ...]  # a number for each of these elements, its own on the page
    named: tuple[tuple[str, ...], ...]  # words of class, id and role of each of them
    linked: int  # characters inside links
    label: str | None  # the value of the label attribute nearest to the block, on labelled pages


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)}


def leaf_blocks(page: str | None, label_attribute: str = "data-label") -> list[Block]:
    """The page's blocks in order, without those in scripts, styles, head and hidden form parts.

    Character references are decoded and white space runs become one space. Tags that are left
    open are closed where HTML closes them: a paragraph by any block tag, list items and table
    cells by their like, everything else by an ancestor's end tag or the end of the page.
    """
    page = page or ""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], str | None, int]] = []
    text: list[str] = []
    linked = opened_so_far = 0

    def flush() -> None:
        nonlocal linked
        joined = _SPACE.sub(" ", "".join(text)).strip()
        if joined:
            outer = [entry for entry in stack if entry[0] not in INLINE]
            label = next((e[2] for e in reversed(stack) if e[2] is not None), None)
            tags, named, _, path = zip(*outer, strict=True) if outer else ((), (), (), ())
            blocks.append(Block(joined, tags, path, named, linked, label))
        text.clear()
        linked = 0

    def pop_to(at: int) -> None:
        if any(e[0] not in INLINE for e in stack[at:]):
            flush()
        del stack[at:]

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not any(e[0] in UNSEEN for e in stack):
            plain = html.unescape(raw)
            text.append(plain)
            if any(e[0] == "a" for e in stack):
                linked += len(plain.strip())

    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        if not token:
            add(page[at:])
            break
        add(page[at : token.start()])
        at = token.end()
        if not token["name"]:
            continue
        name = token["name"].lower()
        if token["close"]:
            place = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if place is not None:
                pop_to(place)
            continue
        if name not in INLINE:
            flush()
            opened = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p"), None)
            if opened is not None:
                pop_to(opened)
            closes, bounds = CLOSES.get(name, (frozenset(), frozenset()))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in bounds:
                    break
                if stack[k][0] in closes:
                    pop_to(k)
            if name == "body":
                stack[:] = [e for e in stack if e[0] not in UNSEEN]
        if name == "br":
            text.append(" ")
        if name in VOID or token["rest"].endswith("/") and name in UNSEEN:
            continue
        if name in RAW:
            end = re.compile(f"</{name}\\b[^>]*(?:>|\\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        found = _attributes(token["rest"]) if token["rest"].strip() else {}
        words = _HUMP.sub(" ", " ".join(found.get(k, "") for k in ("class", "id", "role"))) if found else ""
        opened_so_far += 1
        stack.append((name, tuple(re.findall(r"[a-z]+", words.lower())), found.get(label_attribute), opened_so_far))
    flush()
    return blocks
