"""Main text of web pages: flat text blocks, judged by a decision tree on shallow features.

A page is cut into blocks at block-level tags. Each block has its word count, its link
density, those of its neighbours, and marks of what it stands in. A decision tree, grown
from a small labelled table of blocks, tells article blocks from the rest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import give_back, id_schema, record_batch, typed

#: Elements whose text is never text of the page.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "head", "textarea", "select", "title")
#: Those of them whose content is no markup, so that it goes on to the end of the page where they are never closed.
RAW_TO_END = frozenset(("script", "style", "iframe", "textarea", "title"))
#: Elements that end a block.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that hold what is around an article.
AROUND = frozenset("nav footer aside form menu dialog button label fieldset".split())
#: Words in a class, id or role that mark what is around an article.
HINTS = frozenset("ad ads advert advertisement adverts breadcrumb breadcrumbs comment comments cookie cookies consent disqus login menu nav navbar navigation newsletter notice notices pagination pager popup promo promoted recommended related reply replies share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
#: Those of them that, as a part of a longer name (notice-board, social-history), may name a subject as well as a notice.
VAGUE_HINTS = frozenset("ad ads notice notices popup promo promoted related reply replies share sharing social widget".split())
#: Elements around an article that an article does not stand in: where one begins, they were left open.
LEFT_OPEN = frozenset("nav menu button label".split())
#: What a line of rights says.
RIGHTS = re.compile(r"©|\(c\) *\d{4}|\bcopyright\b|all rights reserved|alle rechte vorbehalten|tous droits réservés|todos (?:los derechos|os direitos) reservados", re.I)
#: Words that mark what is around an article only outside of it; an article has headers and footers of its own.
OUTER_HINTS = frozenset("header footer banner masthead".split())
#: Words in a class, id or role that mark an article.
INNER_HINTS = frozenset("article articlebody entry post story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_token = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>", re.S)
_hint = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_space = re.compile(r"\s+")


@dataclass(slots=True)
class Block:
    text: str
    words: int
    linked: int
    in_article: bool
    marked: bool
    heading: bool
    listed: bool
    hinted: bool = False
    rights: bool = False


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order. Broken markup is read as it comes: a tag is no more than a mark in the flat text."""
    out: list[Block] = []
    open_: list[tuple[str, int]] = []  # element and what it brings: 1 article, 2 around, 4 list, 8 heading, 16 link, 32 perhaps around
    held = [0] * 6
    parts: list[str] = []
    links = 0

    def bring(flags: int, by: int) -> None:
        for k in range(6):
            if flags >> k & 1:
                held[k] += by

    def close() -> None:
        nonlocal links
        text = _space.sub(" ", "".join(parts)).strip()
        if text:
            out.append(Block(text, text.count(" ") + 1, min(links, text.count(" ") + 1), held[0] > 0, held[1] > 0, held[3] > 0, held[2] > 0, held[5] > 0, RIGHTS.search(text) is not None))
        parts.clear()
        links = 0

    def add(piece: str) -> None:
        nonlocal links
        if piece:
            piece = html.unescape(piece)
            parts.append(piece)
            if held[4]:
                links += len(piece.split())

    at, end = 0, len(page)
    while at < end:
        m = _token.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in RAW and not closing:
            if not m[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                if name not in RAW_TO_END and name != "head":
                    # left open, it ends with what it stands in: then its content is read as it comes
                    parent = next((n for n, _ in reversed(open_) if n in BLOCK), None)
                    if stop is None or parent is not None and re.compile(rf"</{parent}\b", re.I).search(page, at, stop.start()):
                        continue
                if name == "head" and stop is None:
                    stop = re.compile(r"<body\b", re.I).search(page, at)
                    at = stop.start() if stop else at
                else:
                    at = stop.end() if stop else end
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            close()
        if closing:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    # an element closes what is open in it, but inline ones that were never closed stay flat
                    for _, flags in open_[k:]:
                        bring(flags, -1)
                    del open_[k:]
                    break
            continue
        if name in VOID or m[3].endswith("/"):
            continue
        if name in ("p", "li") and open_ and open_[-1][0] == name:
            bring(open_.pop()[1], -1)
        around = name in AROUND or name == "header" and not held[0]
        article, vague = name == "article", False
        if article and held[1]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] in LEFT_OPEN and not re.compile(rf"</{open_[k][0]}\b", re.I).search(page, at):
                    bring(open_.pop(k)[1], -1)
        if m[3] and ("class" in m[3] or "id" in m[3] or "role" in m[3] or "itemprop" in m[3]) and name not in ("html", "body"):
            names = [[w for w in re.split(r"[^a-z]+", x) if w] for g in _hint.findall(m[3]) for x in "".join(g).lower().split()]
            named = {w for x in names for w in x}
            article = article or bool(named & INNER_HINTS)
            # a name of one word, or with two that hint, or with one that is not vague, says it; another only may
            said = [x for x in names if (hints := [w for w in x if w in HINTS]) and (len(x) == 1 or len(hints) > 1 or hints[0] not in VAGUE_HINTS)]
            around = around or bool(said) or bool(named & OUTER_HINTS) and not held[0] and not article
            vague = not around and bool(named & VAGUE_HINTS)
        flags = (1 if article and not around else 0) | (2 if around else 0) | (4 if name == "li" else 0) | (8 if name in HEADINGS else 0) | (16 if name == "a" else 0) | (32 if vague else 0)
        open_.append((name, flags))
        bring(flags, 1)
    close()
    return out


FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "in_article", "elsewhere", "marked", "heading", "listed", "hinted", "rights")


def features(found: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` for each block of a page. ``elsewhere``: the page has an article, and the block isn't in it. No neighbour: 0 words."""
    n = len(found)
    x = np.zeros((n, len(FEATURES)), np.float32)
    has = any(b.in_article for b in found)
    for k, b in enumerate(found):
        x[k, 0], x[k, 1] = b.words, b.linked / b.words
        x[k, 6:] = b.in_article, has and not b.in_article, b.marked, b.heading, b.listed, b.hinted, b.rights
    if n > 1:
        x[1:, 2:4] = x[:-1, 0:2]
        x[:-1, 4:6] = x[1:, 0:2]
    return x


#: The labelled table, a page a line, read by eye. A block is the marks of what it stands in (A article, m around an
#: article, h heading, l list, v perhaps around one, r a line of rights), its words, / and those of them in links, and + for article text or - for the rest. Neighbours are those of the line.
LABELLED = """
ml1/1- ml2/2- ml1/1- m9- Ah6+ A30+ A1+ A55+ A12+ m7-
ml1/1- ml1/1- ml2/2- m6- Ah1+ A7+ A120+ A4+ A2+ A60+ m6-
m12- Ah9+ A80/6+ A25+ Am14- A40+ A3/3+ A33+ Aml4/4- Aml6/6-
Ah5+ Al12+ Al5/5+ Al7/7+ A28+ m14- m40-
A3+
A14+
A1/1+ A1+
Ah1+ A3/3+ A20+ A2+ A4/4+ A30+
m2/2- A2+ A6/6+ A1+ A9/9+ m1-
A4/4+ A3+ A5/5+ A3+ A7/7+
h8- 20- A70+ A9+ 12- 5/5-
3/3- 30- Ah4+ A90+ A11+ 60- 25/2-
Ah7+ A45+ Am30- A200+ A5/5+ A2+ mh2- m50- m18- m75-
A8/8+ A9/9+ A10/10+ A22+
m25- Ah3+ A15+ A6+ m11-
l40- l28- A35+ A16+ l9-
4+
12+
60+
220+
h5+ 30+
h9+ 45+ 8+
h3+ 6+ 5+
h6+ 80+ 12+ 4+ 30+
33+ 41+ 26+
30+ 1+ 40+
h4+ 50+ 2+ 60+
22+ 2+
50+ 5+ 2/2- 1/1-
40+ 2+ 2/2- 1/1-
26+ 33+ 3+ 1/1- 1/1- 2/2-
8/8- 3- 6/6- 2- 9/9- 1- 4/4- 70+ 35+ 1+ 7/7- 3/3-
l5/5- 1- l12/12- 2- l7/7- h3+ 45+ 6+ 20+ 3+ l4/4- l8/8-
18/18- 2- 22/22- 4- 30/30- 50+ 9+ 14+ 2+ 16/16- 3/3-
2+ 60+ 1/1- 3/3-
4+ 25+ 7+ 3+ 2/2- 5/5- 2- 6/6-
h3+ 30+ 4+ 1/1- 2/2-
h1+ 9+ 70+ 1+ 12+
l1/1- 3- l2/2- 60+ 3+ 25+
1/1- 3- 2/2- 40+ 3+ 50+ 2/2- 2- 1/1-
16+ 140+ 110/4+ 15+
7+ 9+ 11+
l1/1- l2/2- h6+ 50+ 12+ 90+
l1/1- l2/2- l1/1- 40+ 22+
l2/2- l3/3- 70+ 9+
1/1- 2/2- 1/1- 3/3- h7+ 60+ 35+ 1/1- 2/2-
2/2- 1/1- 2/2- 5/5- 80+ 6+ 44+ 3/3- 1/1- 2/2-
1/1- 1/1- 2/2- 2/2- 3/3- 1/1-
l2/2- l2/2- l1/1- l4/4-
h2- l5/5- l6/6- l7/7- h5+ 66+ 30+
5/4- 4/4- 120+ 90+ 8/6- 6/6-
3/3- 2- 4/4- 55+ 38+ 2/2- 3- 1/1-
12/10- 9/9- 50+ 60/5+ 20/2+
1/1- 1- 2/2- 1- 1/1- h4+ 75+ 18+
l1/1- l1/1- 250+ 14+ l2/2- l2/2-
h6+ 40+ l9+ l12+ l8/1+ 30+
h5+ 25+ l4+ l3+ l6+
18+ l15/3+ l22/2+ 70+
m30- m10/4- 50+ 13+ m8-
m3- m120- h4+ 35+ m60- m45-
ml1/1- ml2/2- 26+ 38+ m9-
ml3/3- 14+ m7-
m5- h8+ 20+ m40- m22-
m2/2- 5+ 60+
60+ 9/9- 7/7- 11/11-
48+ 13+ h2- l6/6- l8/8- l7/7-
85+ 20+ 3/3- 2/2- 4/3-
30+ 50/20+ 30+
40+ 20/20+ 35+
h4+ 60+ 45/18+ 70+ 2/2-
55+ 25/25+ 40+ 1/1- 3/3-
30+ 32/14+ 28+ 26/26+ 50+
12/5- 2- 9/9- 44+ 36+
40+ 40+ r7-
h5+ 55+ 61+ r4- 2/2-
70+ 33+ r12/3- 1/1-
28+ r9- 3/3- 2/2-
A40+ A30+ Ar7+ r6-
A25+ Ar3+ A50+
A60+ Ar3+ Ar9+ mr5-
Ah3+ A50+ Ar60+ A20+
h6+ r70+ 45+
r90+ r6-
Ah4+ A30+ Av45+ A28+
Av70+ A12+ Av38/4+
A35+ Av6- A40+ Av3/3-
A60+ A22+ Av9/8- Av12/12- Av2-
Ah2+ Av28+ Av33+ m6-
v40+ 35+ v5- 60+
50+ v3/3- v8/8- v4- 45+
h3+ 44+ v7- v2/2-
A30+ Av20/20- Av24/24- m5-
"""


def labelled(table: str = LABELLED) -> np.ndarray:
    """Rows of the labelled table: ``FEATURES``, then 1 for article text."""
    out = []
    for line in table.split("\n"):
        cells = [re.fullmatch(r"([Amhlvr]*)(\d+)(?:/(\d+))?([+-])", c) for c in line.split()]
        if cells:
            page = [Block("", int(c[2]), int(c[3] or 0), "A" in c[1], "m" in c[1], "h" in c[1], "l" in c[1], "v" in c[1], "r" in c[1]) for c in cells]
            out.append(np.column_stack([features(page), [c[4] == "+" for c in cells]]))
    return np.concatenate(out)


class Tree:
    """A binary decision tree by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 10):
        self.feature = self.cut = None
        self.value = bool(y.mean() >= 0.5)
        if depth == 0 or len(set(y.tolist())) < 2:
            return
        best = (len(y) * 2 * y.mean() * (1 - y.mean()) - 1e-9, None, None)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                cost = sum(2 * p.sum() * (1 - p.mean()) for p in (y[left], y[~left]))
                if cost < best[0] - 1e-9:
                    best = (cost, f, float(cut))
        if best[1] is None:
            return
        self.feature, self.cut = best[1:]
        left = x[:, self.feature] <= self.cut
        self.low, self.high = Tree(x[left], y[left], depth - 1), Tree(x[~left], y[~left], depth - 1)

    def __str__(self) -> str:
        if self.feature is None:
            return "text" if self.value else "rest"
        inner = lambda t: str(t).replace("\n", "\n  ")
        return f"{FEATURES[self.feature]} <= {self.cut:g}\n  {inner(self.low)}\nelse\n  {inner(self.high)}"

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature is None:
            return np.full(len(x), self.value)
        out = np.empty(len(x), bool)
        left = x[:, self.feature] <= self.cut
        out[left], out[~left] = self.low.predict(x[left]), self.high.predict(x[~left])
        return out


def grow(table: str = LABELLED) -> Tree:
    rows = labelled(table)
    return Tree(rows[:, :-1], rows[:, -1])


TEXTS = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def main_texts(pages: list[str | None], tree: Tree) -> list[str]:
    found = [blocks(p or "") for p in pages]
    sizes = [len(b) for b in found]
    if not sum(sizes):
        return [""] * len(pages)
    chosen = tree.predict(np.concatenate([features(b) for b in found if b]))
    out, k = [], 0
    for b, n in zip(found, sizes, strict=True):
        out.append("\n".join(x.text for x, good in zip(b, chosen[k : k + n], strict=True) if good))
        k += n
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page: id, url, text, n_chars.

    Character references are decoded; white space in a block is one space; blocks are joined by
    line feeds. Null, empty and text-free pages have the empty text. Nothing is cut off, whatever
    its length; repeated pages give a row each; other columns are left aside.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        tree = grow()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = main_texts(part.column(2).to_pylist(), tree)
                yield record_batch(typed(TEXTS, batch), [part.column(0), part.column(1), texts, [len(t) for t in texts]])
            give_back()

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, id_schema(pages, id_col, "url string, text string, n_chars long")).withColumnRenamed("id", id_col)
