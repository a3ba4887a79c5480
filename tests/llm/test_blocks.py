from __future__ import annotations

import html
import re

import numpy as np
import pytest

from foliolens.llm import blocks
from foliolens.llm.blocks import FEATURES, Blocks, Tree, extract_main_text, fit, labelled_blocks, labelled_pages
from foliolens.llm.labelled import NAMED_PAGES, PLAIN_PAGES
from foliolens.llm.queries import QUERIES
from tests.conftest import FOLDER

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def tree(spark) -> Tree:
    return fit(spark)


def texts(page, tree):
    found = Blocks(page)
    return [t for t, k in zip(found.texts, tree.decide(found.features())) if k]


def test_blocks_of_broken_markup():
    cases = {
        "a<b>b</b> c<br>d&amp;e&nbsp;&copy f": ["ab c d&e © f"],
        "<p>one<p>two</p>three<div>four": ["one", "two", "three", "four"],
        "<ul><li>a<li><ul><li>b</ul><li>c</ul>": ["a", "b", "c"],
        "x<script>if (a < b) '</p>'</script>y<style>p{}</style><!-- <p>no</p> -->z": ["xyz"],
        "a < b <3 &lt;p&gt; &am": ["a < b <3 <p> &am"],
        "<p title='a > b' x=\"<q>\">in</p>": ["in"],
        "<p>first</p><a href=\"x>second</a><p>third": ["first", "second", "third"],
        "<p>cut</p><a href='": ["cut"],
        "<p>x</p><!-- open": ["x"],
        "<p>x</p><script>open": ["x"],
        "<p>x</p><video>y": ["x", "y"],
        "<é>": ["<é>"],
        "": [], "  \n ": [], "<p></p>": [], "&#x41;&#0;&#xD800;&#8212;": ["A��—"],
        "<table><tr><td>a<td>b<tr><th>c</table>": ["a", "b", "c"],
        "<P CLASS=X>up</P>": ["up"], "</p>lone": ["lone"], "<!DOCTYPE html><?x y?>t": ["t"],
    }
    for page, want in cases.items():
        assert Blocks(page).texts == want, page


def test_links_and_neighbours():
    found = Blocks("<p>a b <a href=x>c d</a></p><div><a>e</a></div><h2>f</h2>").features()
    assert found[:, FEATURES.index("words")].tolist() == [4, 1, 1]
    assert found[:, FEATURES.index("links")].tolist() == [0.5, 1, 0]
    assert found[:, FEATURES.index("links_after")].tolist() == [1, 0, 0]
    assert found[:, FEATURES.index("words_before")].tolist() == [0, 4, 1]
    assert found[:, FEATURES.index("heading")].tolist() == [0, 0, 1]
    assert Blocks("").features().shape == (0, len(FEATURES))


@pytest.mark.parametrize(
    ("part", "place"),
    [
        ("<div class='site-footer'>t</div>", 0), ("<div id=commentList>t</div>", 0), ("<div role=navigation>t</div>", 0), ("<p hidden>t</p>", 0),
        ("<p style='display: none'>t</p>", 0), ("<form><p>t</p></form>", 0), ("<div class=has-sidebar>t</div>", 2), ("<div class=no-ads>t</div>", 2),
        ("<div class='entry-content'>t</div>", 3), ("<div class=article-body>t</div>", 3), ("<div class=content-ad>t</div>", 0),
        ("<div class=comments><article>t</article></div>", 0), ("<form><main>t</main></form>", 3), ("<article><header>t</header></article>", 3),
        ("<header>t</header>", 0), ("<article><header class=entry-header>t</header></article>", 3), ("<div class=shadow>t</div>", 2),
    ],
)
def test_places(part, place):
    assert Blocks(part).features()[0][FEATURES.index("place")] == place


def test_named_parts_decide_whatever_the_lengths(tree):
    random = np.random.default_rng(0)
    x = random.integers(0, 300, (20_000, len(FEATURES))).astype(float)
    for c in ("links_before", "links", "links_after"):
        x[:, FEATURES.index(c)] = random.random(len(x))
    x[:, FEATURES.index("heading")] = random.integers(0, 2, len(x))
    for place, keep in ((0, False), (1, False), (3, True)):
        x[:, FEATURES.index("place")] = place
        assert (tree.decide(x) == keep).all()


def test_pages_without_names_held_out(spark):
    """Trained without a third of the plain pages, the tree is right on most of their blocks."""
    wrong = total = 0
    for part in range(3):
        kept = [p for i, p in enumerate(labelled_pages()) if i < len(labelled_pages()) - len(PLAIN_PAGES)]
        fold = labelled_pages()[-len(PLAIN_PAGES) :]
        learned = fit(spark, [*kept, *(p for i, p in enumerate(fold) if i % 3 != part)])
        rows = labelled_blocks([p for i, p in enumerate(fold) if i % 3 == part])
        keep = learned.decide(np.array([r for r, _ in rows]))
        wrong += sum(bool(label) != k for (_, label), k in zip(rows, keep))
        total += len(rows)
    share = sum(label for _, label in labelled_blocks(labelled_pages()[-len(PLAIN_PAGES) :])) / total
    assert wrong / total < 0.15 < 1 - max(share, 1 - share)


def test_labelled_pages_are_learned(tree):
    rows = labelled_blocks(labelled_pages())
    assert len(rows) > 500 and len(NAMED_PAGES) > 15
    keep = tree.decide(np.array([r for r, _ in rows]))
    assert np.mean([bool(label) == k for (_, label), k in zip(rows, keep)]) > 0.99


def test_parts_that_are_no_article(tree):
    page = (
        "<html><head><title>T</title></head><body class=sidebar-left><div class='cookie-notice'><p>We use cookies and tell you so in many words, again and again.</p></div>"
        "<header><a href=/>Home</a></header><nav><ul><li><a>One</a></ul></nav><main><article><h1>The  title</h1><p>First &amp; second.<br>Third</p>"
        "<div class=ad><p>Buy this now, it is the best of all things that you can buy anywhere.</p></div><p>Last.</p>"
        "<form><label>Mail</label><input></form></article></main><aside><p>Read our other stories about other things that happened.</p></aside>"
        "<section id=comments><article><p>I liked the text very much, thank you for writing it.</p></article></section><footer>(c) 2020</footer>"
    )
    assert texts(page, tree) == ["The title", "First & second. Third", "Last."]


def test_whole_table_against_the_article_element(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op13_html_extraction"](spark, FOLDER).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        plain = (" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in plain if b) and r.n_chars == len(r.text)


def test_odd_rows(rows, tree):
    long = "<article>" + "<p>word</p>" * 200_000 + "</article>"
    made = [(1, "u", None), (2, None, ""), (3, "u", long), (None, "u", "<article>é</article>"), (4, "u", "<nav>x</nav>"), (4, "u", "<nav>x</nav>")]
    table = rows(SCHEMA + ", text string, n_chars int", [(*m, "clash", 1) for m in made])
    out = extract_main_text(table, tree)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((str(r.page_id), r.url, len(r.text), r.n_chars) for r in out.collect())
    assert got == sorted([("1", "u", 0, 0), ("2", None, 0, 0), ("3", "u", 999_999, 999_999), ("None", "u", 1, 1), ("4", "u", 0, 0), ("4", "u", 0, 0)])
    assert extract_main_text(table.limit(0), tree).collect() == []


def test_no_quadratic_time():
    for page in ('<a "' * 50_000, "<video>" * 50_000, '<a ">"' * 50_000 + '"', "<!" * 50_000, "<p><ul><li>" * 20_000):
        Blocks(page)
    with pytest.raises(ValueError):
        blocks.labelled_blocks(["<p>unmarked</p>"])
