"""Leaf blocks of an HTML page: runs of text between block-level tags, with their ancestors.

Not a full parser: what it has to get right is which text belongs together and which open elements it stands in, also
where end tags are missing or the page breaks off.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Elements that begin a new block, that have no content, and whose content is no text of the page.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select summary table tbody td"
    " tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template title textarea iframe noscript svg object".split())
CLOSED_BY_SIBLING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
CLOSES_P = BLOCK - {"button", "label", "option", "select", "legend", "summary"}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # open elements: tag, words of class, id and role
    linked: float  # share of the characters inside links


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    values = " ".join(filter(None, (v for m in _NAMES.finditer(attributes) for v in m.groups())))
    return tuple(_WORD.findall(values.lower()))


def blocks(html: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    chars = linked = links = 0

    def flush() -> None:
        nonlocal chars, linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, tuple(stack), linked / max(1, chars)))
            pieces.clear()
            chars = linked = 0

    def text(raw: str) -> None:
        nonlocal chars, linked
        if raw:
            pieces.append(unescape(raw) if "&" in raw else raw)
            n = len(raw)
            chars += n
            if links:
                linked += n

    def close(name: str, within: tuple[str, ...] = ()) -> None:
        """Close the innermost open element of that name and all inside it, unless one of `within` is in between."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                flush()
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    at, end = 0, len(html)
    while at < end:
        begin = html.find("<", at)
        if begin < 0:
            text(html[at:])
            break
        text(html[at:begin])
        tag = _TAG.match(html, begin)
        if tag is None:
            follows = html[begin + 1 : begin + 2]
            if html.startswith("<!--", begin):
                stop = html.find("-->", begin + 4)
                at = end if stop < 0 else stop + 3
            elif follows.isalpha() or follows in "/!?" and follows:
                stop = html.find(">", begin)
                at = end if stop < 0 else stop + 1
            else:
                text("<")
                at = begin + 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if tag[1]:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCK:
                flush()
                close(name)
            continue
        if name == "br":
            pieces.append("\n")
        elif name in RAW:
            stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = end if stop is None else stop.end()
        elif name == "a":
            links += 1
        elif name in BLOCK:
            flush()
            if name in CLOSED_BY_SIBLING:
                close(name, CLOSED_BY_SIBLING[name])
            if name in CLOSES_P:
                close("p", ("button", "td", "th", "caption"))
            links = 0 if name not in ("li", "div", "h1", "h2", "h3", "h4", "p") else links
            if name not in VOID:
                stack.append((name, _names(tag[3])))
    flush()
    return out
