from __future__ import annotations

import itertools
import random
import re
from html import unescape
from pathlib import Path

import pytest

from tierlake.llm.main_text import extract_main_text, main_text, minimum_cut
from tierlake.llm.registered import QUERIES

FOLDER = "/root/testdata/sf0.001"


def cut_cost(scores, edges, label):
    ends = sum(max(s, 0) if not kept else max(-s, 0) for s, kept in zip(scores, label))
    return ends + sum(weight for (a, b), weight in edges.items() if label[a] != label[b])


def test_cuts_are_the_cheapest_of_all_labellings():
    picks = random.Random(1)
    for _ in range(400):
        size = picks.randint(1, 8)
        scores, edges = [picks.randint(-6, 6) for _ in range(size)], {}
        for _ in range(picks.randint(0, 12) if size > 1 else 0):
            pair = tuple(sorted(picks.sample(range(size), 2)))
            edges[pair] = edges.get(pair, 0) + picks.randint(0, 5)
        every = itertools.product([False, True], repeat=size)
        wanted = min((cut_cost(scores, edges, label), sum(label)) for label in every)
        found = minimum_cut(scores, edges)
        assert (cut_cost(scores, edges, found), sum(found)) == wanted


STORY = "A long first paragraph, with several words in it. It goes on for a while, and then it ends."
PAGES = {
    STORY + " Second one.": "<nav><a href=x>Home</a></nav><article><p>{}</p><p>Second <b>one.</b></article><footer>&copy; me</footer>",
    STORY + " " + STORY: (
        "<header><h2>Site</h2></header><div id=content><p>{0}</p><div class='ad-box'>Buy it now, it is cheap.</div><p>{0}</p></div>"
        "<aside>Related things, many of them.</aside><form>Your name: <input></form>"
    ),
    "Title " + STORY: (
        "<div class=cookieNotice>We use cookies, please accept them all.</div><main><article><header><h1>Title</h1></header><p>{}</p>"
        "<section id=comments><article><p>{}</p></article></section></article></main><div class=sidebar><p>{}</p></div>"
    ),
    STORY + " a < b & c é": "<ul class=menu><li><a>One</a><li><a>Two</a></ul><article>{}<br>a &lt; b &amp; c &eacute;<script>'</p>'</script><!-- x -->",
    "just words": "just   words",
    "": "<nav>only <a href=y>links</a></nav>",
}


@pytest.mark.parametrize("wanted", PAGES)
def test_articles_come_without_their_surroundings(wanted):
    assert main_text(PAGES[wanted].replace("{0}", STORY).replace("{}", STORY)) == wanted


def test_broken_and_long_pages():
    assert main_text(None) == main_text("") == main_text("<") .replace("<", "") == ""
    for html in ("<p", "<div class='x", "</", "<!--", "<script>", "<a href=\"", "&#x", "<p>a</b></i></div>b"):
        main_text(html)
    deep = "<div>" * 20_000 + "<p>" + STORY + "</p>"
    assert main_text(deep) == STORY
    assert main_text("<article>" + "<p>word</p>" * 20_000 + "</article>") == " ".join(["word"] * 20_000)
    assert "a" in main_text("<p>a" + "<a b=\"" * 3_000)


def test_rows_of_any_kind(spark):
    schema = "page_id long, url string, html string, text string, row_id string, n_chars string"
    rows = [(1, "u", "<article><p>" + STORY, "x", "y", "z"), (None, None, None, "x", "y", "z"), (2, "v", "", None, None, None)]
    found = extract_main_text(spark.createDataFrame([*rows, rows[0]], schema))
    assert found.columns == ["row_id", "url", "text", "n_chars"]
    wanted = [(1, "u", STORY, len(STORY))] * 2 + [(2, "v", "", 0), (None, None, "", 0)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
    assert extract_main_text(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_query_equals_the_article_elements(spark):
    wanted = {}
    for row in spark.read.parquet(FOLDER + "/pages.parquet").collect():
        inside = re.search("<article>(.*)</article>", row["html"], re.DOTALL).group(1)
        plain = re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", " ", inside))
        wanted[row["page_id"]] = " ".join(unescape(plain).split())
    found = QUERIES["op12_html_extraction"](spark, FOLDER).collect()
    assert {r["page_id"]: r["text"] for r in found} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in found)
