"""Leaf blocks of a page: its text cut at block tags, with the open elements round each piece. Tolerant of broken markup."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']++|"[^"<]*"|'[^'<]*')*+)>|<[!?/a-zA-Z][^<>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[a-z]+")

#: Elements whose text is no text of the page, elements that end a block, elements without an end tag, and what an opening tag closes.
RAW = frozenset("script style title textarea noscript template iframe svg select option".split())
BLOCK = frozenset("address article aside blockquote body br button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_NEXT_BLOCK = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})\b", re.I)
_OPTION_END = re.compile(rf"</?(?:option|optgroup|select|datalist|{'|'.join(sorted(BLOCK))})\b", re.I)
_SCOPE = frozenset("ul ol dl table body article section div main aside nav footer header form".split())
_OPENERS = BLOCK - {"p", "br", "hr", "label", "button", "li", "td", "th", "tr", "dt", "dd", "html", "head", "body"}


@dataclass(frozen=True)
class Block:
    text: str
    path: tuple[str, ...]
    marks: frozenset[str]
    linked: int


def leaf_blocks(page: str | None) -> list[Block]:
    """The blocks with text, in page order. path: open elements from the outside in; marks: words of their class, id and role; linked: characters within links.

    The text of RAW elements is skipped up to their end tag. A self-closed svg has no text. An option ends at the next
    option or at the end of its list. A RAW element whose end tag is missing ends at the next tag of a block, so that
    the rest of the page stays.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    parts: list[str] = []
    linked, links, at, n = 0, 0, 0, len(page)
    endless: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append(Block(text, tuple(t for t, _ in stack), frozenset().union(*(m for _, m in stack)) if stack else frozenset(), linked))
            linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text)

    def drop_to(depth: int) -> None:
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[depth:])
        del stack[depth:]

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            take(page[at:])
            break
        if m.start() > at:
            take(page[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name in BLOCK:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    drop_to(i)
                    break
                if name not in BLOCK and stack[i][0] in BLOCK:
                    break
            continue
        if name in RAW:
            flush() if name not in {"select", "option", "svg"} else None
            if name == "svg" and m[3].endswith("/"):
                continue
            if name == "option":
                end = _OPTION_END.search(page, at)
                at = end.start() if end else n
                continue
            end = None if name in endless else _END[name].search(page, at)
            if end is None:
                endless.add(name)
                end = _NEXT_BLOCK.search(page, at)
                at = end.start() if end else n
            else:
                at = end.end()
            continue
        if name in BLOCK:
            flush()
            closed = CLOSES.get(name) or ({"p"} if name in _OPENERS else None)
            if closed:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in closed:
                        drop_to(i)
                        break
                    if stack[i][0] in _SCOPE:
                        break
        if name not in VOID and not m[3].endswith("/"):
            marks = frozenset(w for a in _ATTRIBUTE.findall(m[3]) for w in _TOKEN.findall("".join(a).lower())) if m[3] else frozenset()
            stack.append((name, marks))
            links += name == "a"
    flush()
    return out
