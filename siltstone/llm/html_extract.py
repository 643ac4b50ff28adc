"""Main text of pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi.

Each block has features of its ancestors' tags, of the words in their class, id and role, and of its text.
The field has two labels, text of the article or not, and is fitted by maximum likelihood on labelled pages.
Where no labelled pages are given, a seeded generator writes them: articles in many wrappers among menus,
headers, footers, sidebars, notices, adverts, forms and comments.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded
from siltstone.llm.html_blocks import Block, leaf_blocks

#: Pages that the generator writes for fitting, passes over them, step size, weight of the L2 penalty.
TRAIN_PAGES, EPOCHS, RATE, L2, SEED = 320, 80, 0.2, 1e-3, 11
BATCH_ROWS = 256

#: Words of class, id and role by what they tell (fixed values).
MARKS = {
    "ad": "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion adbox adslot",
    "comment": "comment comments commentlist reply replies respond discussion disqus thread reader feedback",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs skip sitemap topbar links",
    "side": "sidebar side aside widget rail complementary related recommended popular trending more",
    "notice": "cookie cookies consent gdpr notice alert popup modal newsletter subscribe subscription signup paywall overlay toast message privacy",
    "form": "form search login contact",
    "head": "header masthead head logo branding site",
    "foot": "footer foot copyright legal colophon contentinfo bottom",
    "meta": "byline author date share social tags meta",
    "body": "article content post entry main story body text page blog",
}
_KIND = {w: k for k, words in MARKS.items() for w in words.split()}
_ASIDE = frozenset(("nav", "aside", "header", "footer", "form"))


def features(block: Block) -> list[str]:
    text, path = block.text, block.path
    own = next((t for t in reversed(path) if t not in ("b", "i", "a", "span", "em", "strong", "font", "u", "small", "code")), "")
    kinds = {_KIND[m] for m in block.marks if m in _KIND}
    within = "article" in path or "main" in path or "body" in kinds
    spoilt = bool(kinds - {"body", "meta"}) or not _ASIDE.isdisjoint(path)
    density = block.linked / len(text)
    n = len(text)
    return [
        "1", f"own:{own}", *{f"in:{t}" for t in path}, *{f"mark:{k}" for k in kinds}, f"within:{within}:{spoilt}",
        f"links:{0 if density < 0.05 else 1 if density < 0.5 else 2}", f"size:{0 if n < 20 else 1 if n < 60 else 2 if n < 200 else 3}",
        "stop" if text[-1] in ".!?:;…\"'”)" else "nostop", *(["copyright"] if "©" in text else []),
    ]


@dataclass(frozen=True)
class Field:
    """Weights of each feature for the two labels, of transitions and of the first label."""

    index: dict[str, int]
    state: np.ndarray
    step: np.ndarray
    first: np.ndarray

    def labels(self, blocks: list[Block]) -> list[int]:
        """Viterbi: the most likely labels of a page's blocks."""
        if not blocks:
            return []
        gap = self.state[:, 1] - self.state[:, 0]
        emit = [float(sum(gap[self.index[f]] for f in features(b) if f in self.index)) for b in blocks]
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = float(self.first[0]), float(self.first[1]) + emit[0]
        back = []
        for e in emit[1:]:
            to0, to1 = (0, a + s00) if a + s00 >= b + s10 else (1, b + s10), (0, a + s01) if a + s01 > b + s11 else (1, b + s11)
            back.append((to0[0], to1[0]))
            a, b = to0[1], to1[1] + e
        y = [int(b > a)]
        for p in reversed(back):
            y.append(p[y[-1]])
        return y[::-1]

    def main_text(self, page: str | None) -> str:
        blocks = leaf_blocks(page)
        return " ".join(b.text for b, y in zip(blocks, self.labels(blocks)) if y)


def fit(pages: Iterable[tuple[list[Block], list[int]]]) -> Field:
    """Maximum likelihood with an L2 penalty; forward and backward passes run over all pages at once."""
    pages = [(b, y) for b, y in pages if b]
    names = sorted({f for b, _ in pages for x in b for f in features(x)})
    index = {f: i for i, f in enumerate(names)}
    longest, n = max(len(b) for b, _ in pages), len(pages)
    x = np.zeros((n, longest, len(names)), np.float32)
    y = np.zeros((n, longest), int)
    size = np.array([len(b) for b, _ in pages])
    for p, (b, labels) in enumerate(pages):
        y[p, : len(b)] = labels
        for t, block in enumerate(b):
            x[p, t, [index[f] for f in features(block)]] = 1
    live = np.arange(longest)[None, :] < size[:, None]
    gold = np.eye(2)[y] * live[..., None]
    pair_gold = np.einsum("pti,ptj->ij", gold[:, :-1], gold[:, 1:])
    w = [np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    flat = x[live]
    for step in range(1, EPOCHS + 1):
        emit = np.zeros((n, longest, 2))
        emit[live] = flat @ w[0].astype(np.float32)
        f = np.zeros((n, longest, 2))
        f[:, 0] = emit[:, 0] + w[2]
        for t in range(1, longest):
            f[:, t] = np.logaddexp.reduce(f[:, t - 1, :, None] + w[1], axis=1) + emit[:, t]
        g = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            inner = np.logaddexp.reduce(w[1][None] + (emit[:, t + 1] + g[:, t + 1])[:, None, :], axis=2)
            g[:, t] = np.where(live[:, t + 1, None], inner, 0)
        total = np.logaddexp.reduce(f[np.arange(n), size - 1], axis=1)
        node = np.exp(f + g - total[:, None, None]) * live[..., None]
        both = f[:, :-1, :, None] + w[1] + (emit[:, 1:] + g[:, 1:])[:, :, None, :] - total[:, None, None, None]
        pair = (np.exp(np.minimum(both, 0)) * live[:, 1:, None, None]).sum(axis=(0, 1))
        grads = [flat.T @ (node - gold)[live].astype(np.float32) / n + L2 * w[0], (pair - pair_gold) / n + L2 * w[1], (node[:, 0] - gold[:, 0]).mean(0) + L2 * w[2]]
        for a, grad, m_, v_ in zip(w, grads, m, v):
            m_ += 0.1 * (grad - m_)
            v_ += 0.01 * (grad * grad - v_)
            a -= RATE * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.99**step)) + 1e-8)
    return Field(index, w[0], w[1], w[2])


_TEXT_MARK = "⁣"  # stands in generated pages for "this block is text"; removed before fitting


def _page(r: random.Random) -> str:
    """A generated page. Blocks of the article begin with _TEXT_MARK."""
    word = lambda: "".join(r.choice(("ba", "ne", "ti", "or", "lu", "sha", "en", "qui", "der", "ra")) for _ in range(r.randint(1, 3)))
    phrase = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    sentence = lambda: phrase(3, 18).capitalize() + r.choice("....!?")
    prose = lambda a, b: " ".join(sentence() for _ in range(r.randint(a, b)))
    maybe = lambda p, f: f() if r.random() < p else ""
    mark = lambda kind: r.choice(MARKS[kind].split())

    def named(tag: str, kind: str, inner: str) -> str:
        how = r.choice(("class", "id", "class", "role"))
        value = r.choice((mark(kind), f"{mark(kind)}-{word()}", f"{word()} {mark(kind)}"))
        return f'<{tag} {how}="{value}">{inner}</{tag}>'

    links = lambda a, b: "<ul>" + "".join(f'<li><a href="/{word()}">{phrase(1, 4)}</a></li>' for _ in range(r.randint(a, b))) + "</ul>"
    line = lambda: r.choice((prose(1, 2), phrase(2, 9), f"<p>{prose(1, 3)}</p>", f'<a href="/">{phrase(1, 5)}</a>', f"<h3>{phrase(2, 5)}</h3><p>{prose(1, 3)}</p>"))
    menu = lambda: r.choice((lambda: f"<nav>{links(2, 9)}</nav>", lambda: named(r.choice(("div", "ul")), "menu", links(2, 9)), lambda: "<nav>" + " | ".join(f'<a href="/">{word()}</a>' for _ in range(5)) + "</nav>"))()
    advert = lambda: named(r.choice(("div", "aside", "section", "p")), "ad", line())
    notice = lambda: named(r.choice(("div", "section", "p")), "notice", line() + maybe(0.5, lambda: f"<button>{word()}</button>"))
    header = lambda: r.choice((lambda: f"<header>{line()}{maybe(0.5, menu)}</header>", lambda: named("div", "head", f"<h2>{phrase(1, 4)}</h2>{maybe(0.5, line)}")))()
    side = lambda: r.choice((lambda: f"<aside>{line()}{maybe(0.6, lambda: links(2, 6))}</aside>", lambda: named(r.choice(("div", "section", "aside")), "side", line() + maybe(0.6, lambda: links(2, 6)))))()
    form = lambda: f'<form action="/">{maybe(0.7, lambda: f"<label>{phrase(1, 4)}</label>")}<input>{maybe(0.5, line)}<button>{word()}</button></form>'
    foot = lambda: r.choice((lambda: f"<footer>&copy; {phrase(1, 3)} &middot; {prose(1, 1)}{maybe(0.3, lambda: links(2, 5))}</footer>", lambda: f"<footer><p>{line()}</p></footer>", lambda: named("div", "foot", f"&copy; {phrase(2, 6)}")))()

    def comments() -> str:
        one = lambda: r.choice((f"<p>{prose(1, 4)}</p>", f"<li><b>{word()}</b> {prose(1, 3)}</li>", f"<div>{prose(1, 4)}</div>", f"<article><p>{prose(1, 3)}</p></article>"))
        return named(r.choice(("div", "section", "ol", "ul", "aside")), "comment", maybe(0.6, lambda: f"<h2>{phrase(1, 3)}</h2>") + "".join(one() for _ in range(r.randint(1, 6))))

    def paragraph() -> str:
        t = _TEXT_MARK
        kind = r.random()
        if kind < 0.72:
            return f"<p>{r.choice(('', '', '<b>'))}{t}{r.choice((prose(1, 7), prose(1, 1), phrase(1, 3) + '.'))}{maybe(0.1, lambda: f'<br>{t}{prose(1, 2)}')}" + r.choice(("</p>", "</p>", "", "<br>"))
        if kind < 0.8:
            return f"<p>{t}{prose(1, 2)} <a href='/x'>{phrase(1, 3)}</a> {prose(1, 2)}</p>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{t}{r.choice((phrase(2, 9), prose(1, 2)))}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
        if kind < 0.92:
            return f"<h{(k := r.choice('234'))}>{t}{phrase(1, 6)}</h{k}>"
        if kind < 0.96:
            return f"<blockquote>{t}{prose(1, 2)}</blockquote>"
        return f"<table><tr><td>{t}{phrase(1, 3)}</td><td>{t}{phrase(1, 3)}</td></tr></table>"

    inner = maybe(0.85, lambda: f"<h1>{_TEXT_MARK}{r.choice((phrase(2, 9), sentence()))}</h1>")
    for _ in range(r.choice((1, 2, 3, 5, 9, 15))):
        inner += maybe(0.08, lambda: r.choice((advert, side, notice, form))()) + paragraph()
    inner += maybe(0.12, comments)
    wrap = r.random()
    body = f"<article>{inner}</article>" if wrap < 0.5 else f"<main>{inner}</main>" if wrap < 0.62 else f"<main><article>{inner}</article></main>" if wrap < 0.75 else named(r.choice(("div", "section")), "body", inner)
    before = "".join(f() for f in r.sample((header, menu, advert, notice, side, form), r.randint(0, 5)))
    after = "".join(f() for f in r.sample((comments, side, advert, menu, form, notice), r.randint(0, 5))) + maybe(0.8, foot)
    return f"<!DOCTYPE html><html><head><title>{phrase(2, 6)}</title></head><body>{before}{body}{after}</body></html>"


def generated_pages(n: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[str, list[Block], list[int]]]:
    """(page, blocks, labels), alike in every process."""
    r, out = random.Random(seed), []
    for _ in range(n):
        marked = _page(r)
        blocks = leaf_blocks(marked)
        labels = [int(_TEXT_MARK in b.text) for b in blocks]
        page = marked.replace(_TEXT_MARK, "")
        out.append((page, leaf_blocks(page), labels))
    return out


@cache
def default_field() -> Field:
    return fit((b, y) for _, b, y in generated_pages())


def extract_pages(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url and text of each row of pages: the main text, empty if there is none.

    A null or empty html gives empty text. Each row is read by itself, so repeated rows and ids, null ids and
    empty tables need no rule; only page_id, url and html are read. The whole html counts, however long.
    """
    model = field or default_field()
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 2, BATCH_ROWS):
            texts = [model.main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def pages_report(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, the code points of text."""
    return extract_pages(pages).withColumn("n_chars", F.char_length("text").cast("long"))
