r"""Main text of web pages (1): flat text blocks, classified by a decision tree.

A page is read once, from tag to tag, into flat blocks: the texts between block-level tags. Each
block has numbers only: its words, its link density, the same of the blocks before and after it,
and marks of the place it stands in, taken from the open elements' names and their class, id and
role words. The tree is grown (Gini impurity, one threshold at a time) on a small labelled table of
such numbers: the blocks of the pages that ``labelled_pages`` draws by rule, with the labels that it gives them.

Class words are read as wholes: of ``comment-list`` the last word that isn't a mere box decides, ``has-sidebar`` speaks of
another element. The page's article is the article or main element with the most words (comments aside); what
surrounds it says nothing about what is in it, and neither do, on a page without an article, class words of an element that
holds over two thirds of the page's words. A short block that the tree drops follows its neighbours if both are kept, nothing marks its place, and
they share an element. Reading takes time in proportion to the page, also with thousands of open elements.

Every page is handled alone in one narrow pass over the whole html; nothing is shuffled.
"""

from __future__ import annotations

import functools
import html as html_lib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_slices, pack

# Names of the markup language, by what they do to a text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
SILENT = frozenset("script style noscript template svg math iframe object audio video canvas textarea title head select button".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog search".split())
# Words in class, id and role that tell a place.
PLACES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs",
    "frame": "header footer masthead topbar bottombar copyright banner contentinfo site-footer site-header",
    "side": "sidebar aside side widget related recommended complementary teaser tags share social sharing",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay subscribe newsletter signup paywall promo",
    "advert": "ad ads advert advertisement adsense sponsor sponsored banner-ad promotion",
    "comment": "comment comments disqus reply replies respond discussion",
    "form": "form search login",
}
PLACE_OF = {word: place for place, words in PLACES.items() for word in words.split()}
# Words of a compound that name a box and not what is in it, and words before the name of another element.
BOXES = frozenset(
    "area list wrap wrapper container box section block inner outer body content item unit slot panel row col column group "
    "holder thread links link top bottom left right main primary secondary".split()
)
ELSEWHERE = frozenset("has with no without is show hide".split())
# Elements that hold a block's words directly; the one around them is what neighbours share.
LINES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption".split())
BARRIERS = frozenset("ul ol dl table div article section".split())
IMPLIED = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
SPACES = re.compile(r"\s+")
WORDS = re.compile(r"[a-z0-9]+")


def place_words(attributes: str) -> set[str]:
    """The places that class, id and role name, with 'hidden' for what isn't shown."""
    found = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        name = name.lower()
        if name == "style":
            found |= {"hidden"} if HIDDEN.search(value) else set()
        elif name == "aria-hidden":
            found |= {"hidden"} if value == "true" else set()
        elif name != "hidden":
            found |= {place for token in value.split() if (place := place_of(token))}
    return found


def place_of(token: str) -> str | None:
    """The place that one class word, id or role names, read as a whole or by its head."""
    if token in PLACE_OF:
        return PLACE_OF[token]
    words = WORDS.findall(token)
    if not words or words[0] in ELSEWHERE:
        return None
    while len(words) > 1 and (words[-1] in BOXES or words[-1].isdigit()):
        words.pop()
    return PLACE_OF.get("-".join(words[-2:]), PLACE_OF.get(words[-1]))


FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "in_article", "in_outside", "in_menu", "in_frame", "in_side", "in_notice", "in_advert", "in_comment",
    "in_form", "page_has_article", "is_heading",
)


class Page:
    """The flat blocks of one page: ``texts``, and ``numbers`` with a row of ``FEATURES`` for each."""

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.rows: list[list[float]] = []
        self.labels: list[int | None] = []
        self.holders: list[int] = []  # the element that a block shares with its neighbours
        self.has_article = False
        self.read(source)

    def read(self, source: str) -> None:
        # Elements by number, parents before children; 0 stands for the page.
        names, marks, parents, words = [""], [set()], [0], [0]
        stack = [0]  # the open elements
        opened: dict[str, int] = {}  # how many of a name are open
        unclosed: set[str] = set()  # names without any end tag from here on
        blocks: list[tuple[int, int, float]] = []  # element, words, link density
        parts: list[str] = []
        linked = 0  # characters inside links
        at, end = 0, len(source)

        def flush() -> None:
            nonlocal linked
            text = SPACES.sub(" ", "".join(parts)).strip()
            parts.clear()
            if text:
                self.texts.append(text)
                blocks.append((stack[-1], len(text.split()), min(1.0, linked / len(text))))
                words[stack[-1]] += blocks[-1][1]
            linked = 0

        def close(depth: int) -> None:
            for element in stack[depth:]:
                opened[names[element]] -= 1
            del stack[depth:]

        while at < end:
            m = TOKEN.search(source, at)
            stop = m.start() if m else end
            if stop > at:
                piece = html_lib.unescape(source[at:stop])
                parts.append(piece)
                if opened.get("a"):
                    linked += len(SPACES.sub(" ", piece))
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if name in BLOCKS or name == "br":
                parts.append(" ") if name == "br" else flush()
            if m[1]:  # an end tag closes up to its start tag, if there is one
                if opened.get(name):
                    for depth in range(len(stack) - 1, 0, -1):
                        if names[stack[depth]] == name:
                            close(depth)
                            break
                        if name not in BLOCKS and names[stack[depth]] in BLOCKS:
                            break
                continue
            if name in SILENT and name not in ("head", "select"):  # everything up to the end tag is no text
                closing = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(source, at)
                if not closing:
                    unclosed.add(name)
                if not m[0].rstrip(">").endswith("/") or name in RAW:
                    at = closing.end() if closing else (end if name in RAW else at)
                continue
            if name in VOID or m[0].endswith("/>"):
                continue
            for closes in (("p",), IMPLIED.get(name, ())) if name in BLOCKS else ():
                if any(opened.get(c) for c in closes):
                    for depth in range(len(stack) - 1, 0, -1):
                        if names[stack[depth]] in closes:
                            close(depth)
                            break
                        if names[stack[depth]] in BARRIERS:
                            break
            own = place_words(m[3]) if m[3] else set()
            if m[3] and re.search(r"(?:^|\s)hidden(?:\s|=|$)", m[3]):
                own.add("hidden")
            if m[3] and "data-keep" in m[3]:
                own.add("keep")
            if m[3] and re.search(r"""role\s*=\s*["']?main""", m[3]):
                own.add("main")
            if name in ("html", "body"):
                own = set()
            if "hidden" in own:
                at = self.skip(source, name, at)
                continue
            parents.append(stack[-1])
            stack.append(len(names))
            names.append(name)
            marks.append(own)
            words.append(0)
            opened[name] = opened.get(name, 0) + 1
        flush()
        self.place(names, marks, parents, words, blocks)

    def place(self, names: list, marks: list, parents: list, words: list, blocks: list) -> None:
        """What the elements around each block say of it."""
        for element in range(len(names) - 1, 0, -1):  # words of an element and of all in it
            words[parents[element]] += words[element]
        commented = [False] * len(names)
        for element in range(1, len(names)):
            commented[element] = commented[parents[element]] or "comment" in marks[element]
        articles = [e for e in range(1, len(names)) if names[e] in ("article", "main") or "main" in marks[e]]
        candidates = [e for e in articles if not commented[e]] or articles
        principal = max(candidates, key=lambda e: (words[e], -e), default=0)
        self.has_article = bool(articles)
        # For every element: marks of places, names of outer places, and whether an article is around.
        found: list[tuple[frozenset, frozenset, bool]] = [(frozenset(), frozenset(), False)]
        for element in range(1, len(names)):
            around, outer, article = found[parents[element]]
            own, name = marks[element], names[element]
            if element == principal:
                around, outer = frozenset(), frozenset()
                own = own & {"keep", "main"}
            elif not principal and 3 * words[element] > 2 * words[0] and "comment" not in own:
                own, name = own & {"keep", "main"}, "" if name == "form" else name
            if article and (name == "header" or "frame" in own) and own <= {"frame", "keep"} and name != "footer":
                own, name = own - {"frame"}, ""  # the head of an article belongs to it
            article = article or element in (principal,) or names[element] in ("article", "main") or "main" in own
            found.append((around | own if own else around, outer | {name} if name in OUTSIDE else outer, article))
        shared = [0] * len(names)
        for element in range(1, len(names)):
            inline = names[element] in LINES or names[element] not in BLOCKS
            shared[element] = shared[parents[element]] if inline else element
        for element, n_words, density in blocks:
            around, outer, article = found[element]
            self.labels.append(1 if "keep" in around else 0)
            self.holders.append(shared[element])
            self.rows.append(
                [n_words, density, 0, 0, 0, 0]
                + [float(article), float(bool(outer))]
                + [float(p in around) for p in PLACES]
                + [float(self.has_article), float(bool(re.fullmatch("h[1-6]", names[element])))]
            )
        self.numbers = np.array(self.rows, dtype=float).reshape(-1, len(FEATURES))
        if len(self.rows):
            self.numbers[1:, 2:4] = self.numbers[:-1, 0:2]
            self.numbers[:-1, 4:6] = self.numbers[1:, 0:2]

    def kept(self, tree: "Tree") -> np.ndarray:
        """Which blocks are main text: what the tree says, and blocks without a mark between kept ones of the same element.

        In an article a kept one on either side is enough.
        """
        said = tree.predict(self.numbers) >= 0.5
        free = (self.numbers[:, FEATURES.index("in_outside") : FEATURES.index("page_has_article")].sum(axis=1) == 0) & (
            self.numbers[:, 1] < 0.5
        )
        at = 0
        while at < len(said):
            if said[at] or not free[at]:
                at += 1
                continue
            stop = at
            while stop < len(said) and not said[stop] and free[stop] and self.holders[stop] == self.holders[at]:
                stop += 1
            beside = [k for k in (at - 1, stop) if 0 <= k < len(said) and self.holders[k] == self.holders[at] and said[k]]
            said[at:stop] = len(beside) == 2 or bool(beside) and self.numbers[at, FEATURES.index("in_article")] > 0
            at = stop
        return said

    @staticmethod
    def skip(source: str, name: str, at: int) -> int:
        """The place after the element that begins before ``at``, its like inside included."""
        depth = 1
        for m in re.compile(rf"<(/?){re.escape(name)}\b[^>]*>", re.IGNORECASE).finditer(source, at):
            depth += -1 if m[1] else 1
            if not depth:
                return m.end()
        return len(source)


class Tree:
    """A binary decision tree on numbers, grown by Gini impurity until leaves are pure or small."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 24, least: int = 3):
        self.feature, self.limit, self.low, self.high, self.share = [], [], [], [], []
        self.grow(x, y, depth, least)
        self.arrays = [np.array(a) for a in (self.feature, self.limit, self.low, self.high, self.share)]

    def grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        node = len(self.feature)
        for values in (self.feature, self.low, self.high):
            values.append(-1)
        self.limit.append(0.0)
        self.share.append(float(y.mean()) if len(y) else 0.0)
        if depth == 0 or len(y) < 2 * least or y.min() == y.max():
            return node
        best = (0.25, -1, 0.0)
        impurity = len(y) * self.share[node] * (1 - self.share[node])
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            v, t = x[order, f], np.cumsum(y[order])
            cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
            if not len(cuts):
                continue
            n, ones = cuts, t[cuts - 1]
            rest, rest_ones = len(y) - n, t[-1] - ones
            gain = impurity - (ones * (1 - ones / n) + rest_ones * (1 - rest_ones / rest))
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-12:
                best = (gain[k], f, (v[cuts[k] - 1] + v[cuts[k]]) / 2)
        if best[1] < 0:
            return node
        self.feature[node], self.limit[node] = best[1], best[2]
        left = x[:, best[1]] <= best[2]
        self.low[node] = self.grow(x[left], y[left], depth - 1, least)
        self.high[node] = self.grow(x[~left], y[~left], depth - 1, least)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of label 1 in the leaf of each row."""
        feature, limit, low, high, share = self.arrays
        at = np.zeros(len(x), dtype=int)
        while True:
            open_ = feature[at] >= 0
            if not open_.any():
                return share[at]
            rows = np.flatnonzero(open_)
            node = at[rows]
            at[rows] = np.where(x[rows, feature[node]] <= limit[node], low[node], high[node])


def labelled_pages(n_pages: int = 300, seed: int = 7) -> list[str]:
    """Pages of the labelled table, a few thousand blocks; elements with data-keep hold main text.

    Drawn by rule, so that the table says the same of short and long texts wherever the place alone
    decides: with an article (or main) element, what stands in it and in no other place is main text.
    Without one, texts of some length and headings are, unless they stand in another place; lists of
    links and scraps are not.
    """
    draw = random.Random(seed)
    classes = ("ad", "sidebar", "cookie-notice", "comments", "newsletter", "menu", "footer", "search-form", "related")

    def words(low: int = 1, high: int = 120) -> str:
        return " ".join(["word"] * round(low * (high / low) ** draw.random()))

    def link(low: int = 1, high: int = 40) -> str:
        return f'<a href="/">{words(low, high)}</a>'

    def beside() -> str:
        fill = draw.choice([f"<p>{words()}</p>", words(), f"<p>{words()}</p><p>{words()}</p>", f"<p>{words()}</p><p>{link()}</p>", f"<h2>{words(1, 6)}</h2><p>{words()}</p>"])
        if draw.random() < 0.5:
            return f'<div class="{draw.choice(classes)}">{fill}</div>'
        tag = draw.choice(["nav", "aside", "footer", "form"])
        return f"<{tag}>{fill}</{tag}>"

    def main(low: int) -> str:
        kind = draw.random()
        if kind < 0.15:
            level = draw.randint(1, 4)
            return f"<h{level} data-keep>{words(1, 12)}</h{level}>"
        if kind < 0.3:
            return f"<p data-keep>{words(max(3, low), 60)} {link(1, 3)} {words(max(3, low), 60)}</p>"
        if kind < 0.4:
            return f"<ul>{''.join(f'<li data-keep>{words(low)}</li>' for _ in range(3))}</ul>"
        return f"<p data-keep>{words(low)}</p>"

    def scrap() -> str:
        return draw.choice([f"<div>{link()}</div>", f"<ul><li>{link()}</li><li>{link()}</li></ul>", f"<p>{words(1, 4)}</p>"])

    pages = []
    for k in range(n_pages):
        around = lambda n: [draw.choice([beside, scrap])() for _ in range(draw.randint(0, n))]
        if k % 3 < 2:
            inner = [main(1) for _ in range(draw.randint(1, 8))] + [beside() for _ in range(draw.randint(0, 6))]
            draw.shuffle(inner)
            tag = draw.choice(["article", "main"])
            strays = [f"<p>{words()}</p>" for _ in range(draw.randint(0, 2))]
            title = f"<header><h1 data-keep>{words(1, 12)}</h1></header>" if draw.random() < 0.3 else ""
            pages.append("".join([*around(4), *strays, f"<{tag}>{title}{''.join(inner)}</{tag}>", *around(4)]))
        else:
            inner = [main(10) for _ in range(draw.randint(1, 8))] + [beside() for _ in range(draw.randint(0, 4))]
            draw.shuffle(inner)
            pages.append("".join([*around(5), f"<div>{''.join(inner)}</div>", *around(5)]))
    return pages


@functools.cache
def classifier() -> Tree:
    """The tree, grown on the labelled table."""
    pages = [Page(p) for p in labelled_pages()]
    x = np.concatenate([p.numbers for p in pages])
    y = np.concatenate([np.array(p.labels, dtype=float) for p in pages])
    return Tree(x, y)


def main_text(source: str | None) -> str:
    """The main text of a page, its blocks joined by newlines."""
    if not source:
        return ""
    page = Page(source)
    if not page.texts:
        return ""
    kept = page.kept(classifier())
    return "\n".join(t for t, k in zip(page.texts, kept) if k)


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``__row`` (the columns of ``pages``) and ``main``, the main text of the whole html.

    NULL, empty and text-free pages give ''. Unclosed and cut markup is read as far as it goes; a very long page is
    read whole, in time proportional to its length. Rows are handled alone: repeated rows give repeated results, an
    empty table none. Columns of ``pages`` may have any names, those of the result included.
    """
    rows = pack(pages).selectExpr("__row", f"__row.`{html_col}` as __html")

    def run(batches):
        for batch, sources in byte_slices(batches, "__html"):
            texts = pa.array([main_text(s) for s in sources], type=pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("__row")), texts], names=["__row", "main"]
            )

    return rows.mapInArrow(run, rows.select("__row").schema.add("main", "string"))
