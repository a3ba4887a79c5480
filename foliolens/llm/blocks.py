"""Main text of web pages: flat text blocks, classified by a decision tree over their and their neighbours' word counts and link density."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliolens.llm.labelled import NAMED_PAGES, PLAIN_PAGES

# Elements by what they do to the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page, up to their end tag.
UNSEEN = frozenset("script style template svg math iframe object canvas audio video textarea select datalist title".split())
#: Those whose content is never markup: without an end tag they last to the end of the page.
RAW = frozenset("script style textarea".split())
#: Elements that end an open paragraph, list item or cell of their kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "option": {"option"}}
HOLDERS = frozenset("ul ol dl table tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE_ELEMENTS = frozenset("nav aside footer header form button menu dialog noscript fieldset".split())
MAIN_ELEMENTS = frozenset("article main".split())
#: First or last parts of class names, ids and roles that say what an element holds.
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner bottombar breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies copyright disqus donate feedback footer form gdpr header legal login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification notifications pager pagination paywall popup promo promoted promotion related "
    "replies reply respond search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe subscription teaser "
    "toolbar topbar trending widget widgets".split()
)
MAIN_NAMES = frozenset("article articlebody content entry entrybody main maincontent post postbody prose story storybody".split())
NEGATIONS = frozenset("has no non with without not is".split())

TOKEN = re.compile(r"<!--|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>")
#: Where a quote never closes: tags end at the next bracket.
PLAIN_TOKEN = re.compile(r"<!--|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)>|<[!?/][^>]*+>")
OPENING = re.compile("<[a-zA-Z!?/]")
NAMED = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PARTS = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

#: Of a block with its neighbours: words and share of linked words before, here and after, whether it is a heading, and its place:
#: 0 inside a part named as something else, 1 outside the named article, 2 on a page that names no article, 3 inside the article.
FEATURES = ["words_before", "links_before", "words", "links", "words_after", "links_after", "heading", "place"]
DEPTH = 8
SCHEMA = "page_id long, url string, text string, n_chars long"
ASIDE, MAIN, HIDDEN, FORM = 1, 2, 4, 8


def _roles(name: str, rest: str) -> int:
    """What an element says about its content: ASIDE, MAIN, both or nothing."""
    found = FORM if name == "form" else ASIDE if name in ASIDE_ELEMENTS else MAIN if name in MAIN_ELEMENTS else 0
    if not rest or rest.isspace() or name in ("html", "body"):
        return found
    for m in NAMED.finditer(rest):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "hidden" or kind == "aria-hidden" and value == "true" or kind == "style" and "display:none" in value.replace(" ", ""):
            found |= HIDDEN
        elif kind in ("class", "id", "role"):
            for word in value.split():
                parts = [p for p in PARTS.split(CAMEL.sub("-", word).lower()) if p]
                if not parts or parts[0] in NEGATIONS:
                    continue
                whole = "".join(parts)
                if parts[-1] == "header" and parts[0] in MAIN_NAMES:
                    found &= ~ASIDE  # the heading of an article
                elif {parts[0], parts[-1], whole} & ASIDE_NAMES:
                    found |= ASIDE
                elif parts[-1] in MAIN_NAMES or whole in MAIN_NAMES:  # not "content-area", which may hold more
                    found |= MAIN
    return found & ~MAIN if found & ASIDE else found


class Blocks:
    """Flat blocks of one page: text, words, linked words, roles and whether the block is a heading."""

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.rows: list[tuple[int, int, int, int]] = []
        self.open: list[tuple[str, int]] = []  # elements that hold blocks, with the roles around and of each
        self.pieces: list[str] = []
        self.linked = self.links = self.link_at = 0
        self.endless: set[str] = set()  # elements of UNSEEN without a further end tag
        self.read(page)
        self.flush()

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            self.pieces = []
            if text:
                roles = self.open[-1][1] if self.open else 0
                n = text.count(" ") + 1
                self.texts.append(text)
                self.rows.append((n, min(n, self.linked), roles, int(any(e[0] in HEADINGS for e in self.open[-2:]))))
        self.linked = 0

    def add(self, text: str) -> None:
        if text:
            text = html.unescape(text) if "&" in text else text
            self.pieces.append(text)
            if self.links:
                self.linked += len(text.split())

    def read(self, page: str) -> None:
        at, token, size = 0, TOKEN, len(page)
        while at < size:
            left = page.find("<", at)
            if left < 0:
                self.add(page[at:])
                return
            m = token.match(page, left)
            if m is None and OPENING.match(page, left):
                # A quote or the tag itself stays open up to the end of the page.
                token = PLAIN_TOKEN
                m = token.match(page, left)
                if m is None:
                    self.add(page[at:left])
                    return
            if m is None:
                self.add(page[at : left + 1])
                at = left + 1
                continue
            if left > at:
                self.add(page[at:left])
            at = m.end()
            if m[0] == "<!--":
                end = page.find("-->", left + 2)
                at = size if end < 0 else end + 3
            elif m["name"]:
                name = m["name"].lower()
                if m["close"]:
                    self.close(name)
                elif name in UNSEEN:
                    if name not in self.endless and not (m["rest"].endswith("/") and name not in RAW):
                        end = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(page, at)
                        if end:
                            at = end.end()
                        elif name in RAW:
                            return
                        else:
                            self.endless.add(name)
                else:
                    self.start(name, m["rest"])

    def start(self, name: str, rest: str) -> None:
        if name == "a":
            self.links, self.link_at = 1, len(self.open)
        elif name == "br":
            self.pieces.append(" ")
        if name in INLINE:
            # An inline element with a role, such as a hidden span, makes a block of its own.
            if not rest or name == "img" or name == "wbr" or not _roles(name, rest):
                return
        elif name in VOID:
            if name != "br":
                self.flush()
            return
        self.flush()
        ended = ENDS.get(name, ())
        while self.open and (self.open[-1][0] == "p" and name not in INLINE or self.open[-1][0] in ended):
            self.open.pop()
        if ended:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in ended:
                    del self.open[i:]
                    break
                if self.open[i][0] in HOLDERS and self.open[i][0] != name:
                    break
        around = self.open[-1][1] if self.open else 0
        if name in MAIN_ELEMENTS:
            around &= ~FORM  # some pages are one form
        inside = around & MAIN and not around & (ASIDE | FORM)
        own = _roles("div" if name == "header" and inside else name, rest)  # the heading of an article is part of it
        self.open.append((name, around | own))

    def close(self, name: str) -> None:
        if name == "a":
            self.links = 0
        if name == "br" or name in INLINE and not any(e[0] == name for e in self.open):
            self.pieces.append(" " if name == "br" else "")
            return
        self.flush()
        if name in HEADINGS and not any(e[0] == name for e in self.open):
            name = next((e[0] for e in reversed(self.open) if e[0] in HEADINGS), name)
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                del self.open[i:]
                if i < self.link_at:
                    self.links = 0
                return

    def features(self) -> np.ndarray:
        """A row of FEATURES per block; missing neighbours have no words and no links."""
        rows = np.array(self.rows, np.float64).reshape(-1, 4)
        words, links = rows[:, 0], rows[:, 1] / np.maximum(rows[:, 0], 1)
        roles = rows[:, 2].astype(np.int64)
        shift = lambda x: (np.append(0, x[:-1]), np.append(x[1:], 0))
        if not len(rows):
            return np.zeros((0, len(FEATURES)))
        (words_before, words_after), (links_before, links_after) = shift(words), shift(links)
        aside, main = roles & (ASIDE | HIDDEN | FORM) > 0, roles & MAIN > 0
        place = np.where(aside, 0, np.where(main, 3, 1 if (main & ~aside).any() else 2))
        return np.stack([words_before, links_before, words, links, words_after, links_after, rows[:, 3], place], axis=1)


FILL = re.compile(r"\{(\d+)\}")


#: Named pages are read with shorter and longer texts too.
SCALES = (0.2, 1, 5)


def labelled_pages() -> list[str]:
    fill = lambda page, scale: FILL.sub(lambda m: " ".join(["word"] * max(1, round(int(m[1]) * scale))), page)
    return [fill(p, s) for p in NAMED_PAGES for s in SCALES] + [fill(p, 1) for p in PLAIN_PAGES]


def labelled_blocks(pages: list[str]) -> list[tuple[list[float], float]]:
    """(features, label) of the blocks of labelled pages; a block that begins with + is main text, one with - is not."""
    rows = []
    for page in pages:
        found = Blocks(page)
        for text, row in zip(found.texts, found.features()):
            if text[0] not in "+-":
                raise ValueError(f"unlabelled block: {text[:60]}")
            rows.append((row.tolist(), float(text[0] == "+")))
    return rows


class Tree:
    """A decision tree in arrays: feature (-1: leaf), threshold, left and right child, and decision of each node."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.keep = [], [], [], [], []

    @classmethod
    def of(cls, model) -> Tree:
        tree = cls()

        def add(node) -> int:
            at = len(tree.feature)
            inner = node.numDescendants() > 0
            for column, value in (("feature", -1), ("threshold", 0.0), ("left", at), ("right", at), ("keep", node.prediction() > 0.5)):
                getattr(tree, column).append(value)
            if inner:
                tree.feature[at], tree.threshold[at] = node.split().featureIndex(), node.split().threshold()
                tree.left[at], tree.right[at] = add(node.leftChild()), add(node.rightChild())
            return at

        add(model._java_obj.rootNode())
        return tree

    def decide(self, rows: np.ndarray) -> np.ndarray:
        feature, threshold, left, right = (np.array(x) for x in (self.feature, self.threshold, self.left, self.right))
        at = np.zeros(len(rows), np.int64)
        for _ in range(DEPTH + 1):
            value = rows[np.arange(len(rows)), np.maximum(feature[at], 0)]
            at = np.where(feature[at] < 0, at, np.where(value <= threshold[at], left[at], right[at]))
        return np.array(self.keep)[at]


def fit(spark: SparkSession, pages: list[str] | None = None) -> Tree:
    """Train the tree on labelled pages: some hundreds of blocks, whatever the size of the corpus."""
    table = spark.createDataFrame(labelled_blocks(labelled_pages() if pages is None else pages), "features array<double>, label double").coalesce(1)
    learner = DecisionTreeClassifier(maxDepth=DEPTH, maxBins=64, minInfoGain=0.002, seed=1)
    return Tree.of(learner.fit(table.select("label", array_to_vector("features").alias("features"))))


def _main_text(tree: Tree):
    def run(batches):
        for batch in batches:
            ids, urls, pages = (batch.column(c) for c in ("page_id", "url", "html"))
            for first in range(0, batch.num_rows, 256):
                texts = []
                for page in pages.slice(first, 256):
                    found = Blocks(page.as_py() or "")
                    keep = tree.decide(found.features())
                    texts.append("\n".join(t for t, k in zip(found.texts, keep) if k))
                columns = [ids.slice(first, 256), urls.slice(first, 256), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return run


def extract_main_text(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of the article of each page.

    A page is cut into flat blocks at block-level tags; scripts, styles, comments and the like are no text.  Character references are decoded
    once, white space inside a block (`<br>` too) becomes one space.  A decision tree, trained on a small labelled table, keeps blocks by
    word count and link density of the block and its neighbours, and by what the elements around it are or are named.  Kept blocks are
    joined in page order by a line feed.

    Pages are read whole, one at a time, without a shuffle; broken markup (open tags and quotes, cut-off pages) never fails.  Null
    and empty pages, and pages without main text, give an empty text; repeated rows give equal rows; empty tables none; other columns are ignored.
    """
    tree = tree or fit(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(_main_text(tree), SCHEMA)
