"""HTML extraction: flat text blocks classified by a decision tree.

A page is read once, tag by tag, into flat blocks of text: a block ends at
every tag that is not inline. Each block has its word count and link density
(the share of its words inside links), the same of the block before and the
block after, and four marks of its place: inside an element that is
boilerplate by its tag, inside one that is by the words of its class, id or
role, outside the article (0 inside an article, 0.25 inside main only, 1
outside, 0.5 if the page has none), and inside a heading. A
decision tree, trained on the small labelled table ``LABELLED``, keeps or
drops the block. Kept blocks are joined in page order.

An element whose names mark boilerplate may wrap the whole page (``has-sidebar``,
``page-with-comments``). The mark is void if the article inside holds most of
the page's words, or if the name is a compound and the element holds most of
the words that no plain mark (``sidebar``, ``comments``) is on. An article
inside an aside, nav, footer, dialog or menu, or inside boilerplate by name, is
none. A form is boilerplate like an element with a compound name; one that
holds ``FORM_WORDS`` words or more and most of the page's words is a wrapper.
Articles without h1 or main are teasers if the text outside of them has over
twice their words; then the page has no article, and they are left out.

Defined results: null or empty html has empty text. Character references are
decoded, white space inside a block becomes one space, blocks are trimmed.
Scripts, styles, templates, comments, hidden elements and the head are no
text. Unclosed elements end with what contains them, an opening article or
main ends unclosed boilerplate and unclosed hidden elements around it, and an unclosed comment, tag or
script runs to the end of the page. Null ids and repeated rows are rows like
any other, other columns are not read, an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SILENT = frozenset("script style noscript template head title svg math iframe object select option button textarea canvas audio video".split())
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
BOILER_TAGS = frozenset("nav footer aside dialog menu header".split())
#: Words from which a form that holds most of a page's words is its wrapper.
FORM_WORDS = 50
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of a class, id or role that mark boilerplate.
BOILER_NAMES = frozenset("""ad ads advert adverts advertisement advertising alert alertdialog banner breadcrumb breadcrumbs comment comments complementary consent
contentinfo cookie cookies dialog discussion disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification
overlay pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored
subscribe subscription teaser teasers toolbar topbar widget widgets""".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[A-Za-z][^>]*(?:>|\Z)|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|aria-label|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "boiler_tag", "boiler_name", "outside", "heading")
#: The labelled table: FEATURES of a block, then 1 for text and 0 for boilerplate.
LABELLED = """
62 0.00 48 0.00 55 0.00 0 0 0 0 1
35 0.05 60 0.00 41 0.02 0 0 0 0 1
18 0.00 35 0.00 44 0.00 0 0 0 0 1
9 0.00 52 0.00 30 0.00 0 0 0 0 1
3 0.00 40 0.00 25 0.00 0 0 0 0 1
1 0.00 22 0.00 31 0.00 0 0 0 0 1
1 0.00 2 0.00 3 0.00 0 0 0 0 1
2 0.00 1 0.00 1 0.00 0 0 0 0 1
12 0.00 12 0.00 120 0.00 0 0 0 1 1
7 0.00 0 0.00 64 0.00 0 0 0 1 1
2 0.00 80 0.00 45 0.00 0 0 0 1 1
4 0.00 1 1.00 38 0.00 0 0 0 1 1
240 0.01 12 0.00 0 0.00 0 0 0 0 1
25 0.32 44 0.00 51 0.04 0 0 0 0 1
14 0.50 33 0.00 29 0.00 0 0 0 0 1
20 0.45 0 0.00 80 0.00 0 0 0 0 1
5 0.20 40 0.00 4 0.25 0 0 0 0 1
6 0.00 9 0.00 8 0.00 0 0 0 0 1
30 0.00 1 1.00 1 1.00 0 0 0 0 1
45 0.00 2 1.00 20 0.00 0 0 0 0 1
1 0.00 30 0.00 14 0.00 0 0 0 0 1
3 0.00 2 1.00 2 1.00 0 0 0 0 1
12 0.00 1 1.00 1 1.00 0 0 0 0 1
2 0.00 1 1.00 0 0.00 0 0 0 0 1
8 0.00 60 0.00 0 0.00 0 0 0 0 1
1 1.00 1 1.00 1 1.00 1 0 0 0 0
1 1.00 0 0.00 1 1.00 1 0 1 0 0
2 1.00 2 1.00 12 0.00 1 0 1 0 0
12 0.00 1 1.00 10 0.00 0 1 1 0 0
18 0.00 1 1.00 60 0.00 0 1 0 0 0
40 0.00 50 0.00 55 0.00 0 1 0 0 0
25 0.10 60 0.00 22 0.00 0 1 1 0 0
5 0.00 90 0.00 60 0.00 0 1 0 0 0
3 0.33 40 0.00 0 0.00 0 1 0 1 0
15 0.00 45 0.00 0 0.00 1 0 1 0 0
64 0.00 30 0.00 5 0.00 1 0 1 0 0
20 0.00 35 0.00 0 0.00 1 0 0 0 0
2 0.00 3 0.00 25 0.00 1 0 1 1 0
55 0.00 20 0.00 40 0.00 1 0 0 0 0
1 0.00 4 0.00 1 0.00 1 0 0 0 0
30 0.00 1 0.00 28 0.00 1 1 1 0 0
1 1.00 2 1.00 1 1.00 0 0 0 0 1
1 1.00 2 1.00 1 1.00 0 0 0.25 0 0
1 1.00 2 1.00 1 1.00 0 0 0.5 0 0
3 1.00 2 1.00 4 1.00 0 0 0 0 1
3 1.00 2 1.00 4 1.00 0 0 0.25 0 0
3 1.00 2 1.00 4 1.00 0 0 0.5 0 0
2 1.00 30 0.00 3 1.00 0 0 0 0 1
2 1.00 30 0.00 3 1.00 0 0 0.25 0 0
2 1.00 30 0.00 3 1.00 0 0 0.5 0 0
4 1.00 5 1.00 50 0.00 0 0 0 0 1
4 1.00 5 1.00 50 0.00 0 0 0.25 0 0
4 1.00 5 1.00 50 0.00 0 0 0.5 0 0
6 0.83 4 1.00 5 1.00 0 0 0 0 1
6 0.83 4 1.00 5 1.00 0 0 0.25 0 0
6 0.83 4 1.00 5 1.00 0 0 0.5 0 0
8 0.75 6 0.80 7 0.90 0 0 0 0 1
8 0.75 6 0.80 7 0.90 0 0 0.25 0 0
8 0.75 6 0.80 7 0.90 0 0 0.5 0 0
10 0.90 40 0.00 12 0.90 0 0 0 0 1
10 0.90 40 0.00 12 0.90 0 0 0.25 0 0
10 0.90 40 0.00 12 0.90 0 0 0.5 0 0
5 0.00 1 1.00 1 1.00 0 0 1 0 0
9 0.00 0 0.00 8 0.00 0 0 1 0 0
22 0.00 80 0.00 0 0.00 0 0 1 0 0
70 0.00 60 0.00 40 0.00 0 0 1 0 0
3 0.00 2 1.00 10 0.00 0 0 1 1 0
2 1.00 3 0.00 2 1.00 0 0 1 0 0
2 0.00 1 1.00 1 1.00 0 0 0.5 0 0
4 0.00 2 1.00 0 0.00 0 0 0.5 0 0
3 0.00 0 0.00 1 1.00 0 0 0.5 0 0
5 0.00 1 1.00 2 1.00 0 0 0.5 0 0
2 1.00 2 1.00 2 1.00 0 0 0.5 0 0
40 0.00 30 0.00 1 1.00 0 0 0.25 0 1
7 0.00 0 0.00 40 0.00 0 0 0.25 1 1
3 0.00 2 1.00 2 0.00 0 0 0.25 0 1
45 0.00 2 1.00 50 0.00 0 0 0.5 0 1
30 0.00 40 0.00 1 1.00 0 0 0.5 0 1
6 0.00 1 1.00 40 0.00 0 0 0.5 1 1
4 0.00 50 0.00 30 0.00 0 0 0.5 0 1
12 0.10 60 0.00 0 0.00 0 0 0.5 0 1
2 0.00 40 0.00 35 0.00 0 0 0.5 0 1
9 0.00 0 0.00 70 0.00 0 0 0.5 0 1
60 0.05 0 0.00 0 0.00 0 0 0.5 0 1
1 0.00 0 0.00 0 0.00 0 0 0.5 0 1
60 0.00 60 0.00 0 0.00 1 0 0 0 0
24 0.00 0 0.00 60 0.00 1 0 0 0 0
4 0.00 2 1.00 30 0.00 1 0 0 1 0
60 0.00 60 0.00 0 0.00 1 0 0.25 0 0
24 0.00 0 0.00 60 0.00 1 0 0.25 0 0
4 0.00 2 1.00 30 0.00 1 0 0.25 1 0
60 0.00 60 0.00 0 0.00 1 0 0.5 0 0
24 0.00 0 0.00 60 0.00 1 0 0.5 0 0
4 0.00 2 1.00 30 0.00 1 0 0.5 1 0
60 0.00 60 0.00 0 0.00 0 1 0 0 0
24 0.00 0 0.00 60 0.00 0 1 0 0 0
4 0.00 2 1.00 30 0.00 0 1 0 1 0
60 0.00 60 0.00 0 0.00 0 1 0.25 0 0
24 0.00 0 0.00 60 0.00 0 1 0.25 0 0
4 0.00 2 1.00 30 0.00 0 1 0.25 1 0
60 0.00 60 0.00 0 0.00 0 1 0.5 0 0
24 0.00 0 0.00 60 0.00 0 1 0.5 0 0
4 0.00 2 1.00 30 0.00 0 1 0.5 1 0
"""


class Tree:
    """A binary decision tree grown by Gini impurity."""

    def __init__(self, depth: int = 10):
        self.depth = depth
        self.feature, self.limit, self.child, self.value = [], [], [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Tree":
        self._grow(x, y, self.depth)
        self.feature, self.limit, self.child, self.value = (np.array(v) for v in (self.feature, self.limit, self.child, self.value))
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        node = len(self.feature)
        self.feature.append(-1)
        self.limit.append(0.0)
        self.child.append([node, node])
        self.value.append(y.mean() if len(y) else 0.0)
        best = (1e-9, -1, 0.0)
        impurity = lambda v: len(v) * v.mean() * (1 - v.mean()) if len(v) else 0.0
        for f in range(x.shape[1]):
            at = np.unique(x[:, f])
            for limit in (at[1:] + at[:-1]) / 2:
                left = x[:, f] < limit
                gain = impurity(y) - impurity(y[left]) - impurity(y[~left])
                if gain > best[0] + 1e-12:
                    best = (gain, f, limit)
        if depth and best[1] >= 0:
            left = x[:, best[1]] < best[2]
            self.feature[node], self.limit[node] = best[1], best[2]
            self.child[node] = [self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1)]
        return node

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            f = self.feature[node]
            right = x[np.arange(len(x)), np.maximum(f, 0)] >= self.limit[node]
            node = self.child[node, right.astype(np.int64)]
        return self.value[node] >= 0.5


def trained(table: str = LABELLED) -> Tree:
    rows = np.array([[float(v) for v in line.split()] for line in table.strip().splitlines()])
    return Tree().fit(rows[:, :-1], rows[:, -1])


def _marks(tag: str, attributes: str) -> tuple[int, bool]:
    """Whether an element is boilerplate by its names (2: by a whole name, 1:
    by a part of a compound, 0: not), and whether hidden."""
    named, hidden = 0, False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = tag not in ("html", "body")
        elif key in ("class", "id", "role", "aria-label") and tag not in ("html", "body", "article", "main"):
            if any(p.lower() in BOILER_NAMES for p in NAME_PART.findall(value)):
                whole = any(p.lower() in BOILER_NAMES for p in value.split())
                named = max(named, 2 if whole else 1)
    return named, hidden


def _place(words: list[int], inside: list[tuple[int, int]], names: list[tuple[int, int]], articles: list[tuple[int, int]], first_heading: int | None,
           forms: set[int]) -> tuple[list[bool], list[bool], bool]:
    """For each block whether it is boilerplate by name and whether inside an
    article, and whether there is an article. ``inside`` is the nearest named
    element and article of each block (-1: none), ``names`` the mark of each
    named element and the one around it, ``articles`` the named element and
    the article around each article, ``first_heading`` the block of the first
    h1, ``forms`` the named elements that are forms. What is around has the smaller number, so one pass each way is enough."""
    whole = []
    for mark, up in names:
        whole.append(mark == 2 or up >= 0 and whole[up])
    held, by_article, plain = [0] * len(names), [0] * len(articles), 0
    for n, (name, article) in zip(words, inside):
        if article >= 0:
            by_article[article] += n
        if name < 0 or not whole[name]:
            plain += n
            if name >= 0:
                held[name] += n
    for i in range(len(names) - 1, -1, -1):
        if names[i][1] >= 0:
            held[names[i][1]] += held[i]
    for i in range(len(articles) - 1, -1, -1):
        if articles[i][1] >= 0:
            by_article[articles[i][1]] += by_article[i]
    main = by_article.index(max(by_article)) if any(by_article) else None
    around = []
    at = articles[main][0] if main is not None else inside[first_heading][0] if first_heading is not None else -1
    while at >= 0:
        around.append(at)
        at = names[at][1]
    if main is None and first_heading is None:
        around = range(len(names))
    most = main is not None and 2 * by_article[main] > sum(words)
    void = {i for i in around if i not in forms and (most or names[i][0] == 1 and 2 * held[i] > plain)}
    void |= {i for i in forms if most and i in around or held[i] >= FORM_WORDS and 2 * held[i] > plain}
    marked: list[bool] = []
    for i, (_, up) in enumerate(names):
        marked.append(i not in void or up >= 0 and marked[up])
    valid = [name < 0 or not marked[name] for name, _ in articles]
    some = any(valid)
    for i, (_, up) in enumerate(articles):
        valid[i] = valid[i] or up >= 0 and valid[up]
    return [name >= 0 and marked[name] for name, _ in inside], [article >= 0 and valid[article] for _, article in inside], some


def blocks(page: str) -> tuple[list[str], np.ndarray]:
    """Texts of the blocks of a page and their features."""
    texts, rows = [], []
    parts: list[str] = []
    # open elements: tag, boilerplate by tag, by name, silent, article
    stack: list[tuple[str, bool, int, bool, bool]] = []
    names: list[tuple[int, int]] = []
    articles: list[tuple[int, int]] = []
    above, within = [-1], [-1]  # open elements with names of boilerplate, open articles
    inside: list[tuple[int, int]] = []
    first_heading = None
    ends: dict[str, tuple[list[int], np.ndarray, np.ndarray]] = {}
    forms: set[int] = set()
    mains: set[int] = set()
    sure = False  # an article with an h1, or a main
    opened: Counter[str] = Counter()
    linked, inside_link = 0, 0
    tag_count = silent_count = heading_count = 0

    def close_block():
        nonlocal linked, first_heading
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                n = text.count(" ") + 1
                texts.append(text)
                if first_heading is None and opened["h1"] and not tag_count:
                    first_heading = len(rows)
                rows.append((n, min(linked / n, 1.0), tag_count > 0, 0, 0, heading_count > 0))
                inside.append((above[-1], within[-1]))
        linked = 0

    def pop():
        nonlocal tag_count, silent_count, heading_count, inside_link
        tag, by_tag, by_name, silent, article = stack.pop()
        opened[tag] -= 1
        tag_count -= by_tag
        silent_count -= silent
        if by_name:
            above.pop()
        if article:
            within.pop()
        heading_count -= tag in HEADINGS
        inside_link -= tag == "a"

    def marked_around(pos: int) -> Iterator[tuple[int, bool]]:
        """Open elements that are boilerplate by tag or silent, from the inner
        to the outer, and whether each is closed after ``pos``."""
        open_of: Counter[str] = Counter()
        for i in range(len(stack) - 1, -1, -1):
            tag, by_tag, _, silent, _ = stack[i]
            open_of[tag] += 1
            if by_tag or silent:
                if tag not in ends:
                    found = [(m.start(), -1 if m.group(1) else 1) for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])", page, re.I)]
                    depth = np.cumsum([0, *(step for _, step in found)])
                    # the least depth at or after each tag
                    ends[tag] = [at for at, _ in found], depth, np.minimum.accumulate(depth[::-1])[::-1]
                starts, depth, least = ends[tag]
                at = bisect_left(starts, pos)
                yield i, bool(least[at] <= depth[at] - open_of[tag])

    pos, n = 0, len(page)
    while pos < n:
        m = TOKEN.match(page, pos)
        pos = m.end()
        tag = m.group(2)
        if tag is None:
            piece = m.group()
            if piece[0] == "<" and len(piece) > 1:
                continue
            if not silent_count:
                piece = html.unescape(piece)
                parts.append(piece)
                if inside_link:
                    linked += len(piece.split())
            continue
        tag = tag.lower()
        if m.group(1):
            if tag not in INLINE:
                close_block()
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag == "p":
                close_block()
            continue
        if tag not in INLINE:
            close_block()
        if tag in VOID:
            continue
        if m.group(3).endswith("/") and tag in ("svg", "math", "path", "script"):
            continue
        if tag in ("p", "li", "option", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] in (tag, "p"):
            pop()
        if tag == "body":
            while stack and stack[-1][0] in ("head", "title", "style", "script"):
                pop()
        article = tag in ARTICLE
        if article and tag_count + silent_count:
            around = list(marked_around(pos))
            # a header may wrap the article that it opens; what else is closed has no article
            article = not any(closed and stack[i][0] != "header" for i, closed in around)
            if article:
                while len(stack) > around[-1][0]:
                    pop()
        named, hidden = _marks(tag, m.group(3)) if m.group(3) else (0, False)
        by_tag = tag in BOILER_TAGS and not (tag == "header" and len(within) > 1)
        silent = tag in SILENT or hidden
        if tag == "form" and named < 2:
            forms.add(len(names))
            named = 1
        stack.append((tag, by_tag, named, silent, article))
        opened[tag] += 1
        tag_count += by_tag
        silent_count += silent
        if named:
            above.append(len(names))
            names.append((named, above[-2]))
        sure |= tag == "main" and article or tag == "h1" and within[-1] >= 0
        if article:
            if tag == "main":
                mains.add(len(articles))
            within.append(len(articles))
            articles.append((above[-1], within[-2]))
        heading_count += tag in HEADINGS
        inside_link += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = end.end() if end else n
            pop()
    close_block()
    if not rows:
        return texts, np.zeros((0, len(FEATURES)))
    r = np.array(rows, float)
    near = np.zeros((len(r), 4))
    near[1:, :2] = r[:-1, :2]
    near[:-1, 2:] = r[1:, :2]
    words = [0 if row[2] else row[0] for row in rows]
    by_tag = r[:, 2] > 0
    r[:, 3], r[:, 4], has_article = _place(words, inside, names, articles, first_heading, forms)
    within_article = r[:, 4] > 0
    outside = np.where(within_article, 0, 1) if has_article else np.full(len(r), 0.5)
    if has_article and not sure:
        prose = (r[:, 0] >= 20) & (3 * r[:, 1] < 1) & ~by_tag & (r[:, 3] == 0)
        if r[prose & ~within_article, 0].sum() > 2 * r[within_article & ~by_tag, 0].sum():
            outside = np.where(within_article, 1, 0.5)
    outside = np.where((outside == 0) & np.array([article in mains for _, article in inside]), 0.25, outside)
    return texts, np.column_stack([r[:, :2], near, r[:, 2:4], outside, r[:, 5]])


def extract_text(page: str | None, tree: Tree) -> str:
    texts, x = blocks(page or "")
    return " ".join(t for t, keep in zip(texts, tree(x)) if keep) if texts else ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree = trained()
    for batch in batches:
        texts = [extract_text(x.as_py(), tree) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
