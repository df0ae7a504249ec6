"""Main text of pages: the given tables against a plain reading of their articles, and pages of other shapes."""

import html
import re
import time

import pytest

from small_corpus import corpus, empty_folder, folder  # noqa: F401
from sparkrisk.llm import catalog
from sparkrisk.llm.main_text import extract, stretches

LONG = "This is a sentence of the article that goes on for a while, so that its line is long enough. "


def plain(page):
    article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
    return "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_given_pages(spark, size):
    path = f"/root/testdata/{size}"
    got = {r["page_id"]: r for r in catalog.QUERIES["op12_line_block_text"](spark, path).collect()}
    pages = spark.read.parquet(f"{path}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        r = got[p["page_id"]]
        assert r["text"] == plain(p["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == p["url"]


def test_awkward_rows(spark, folder):
    rows = catalog.QUERIES["op12_line_block_text"](spark, folder).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in rows) == [
        ("0", 0), ("1", 15), ("2", len(("one two three " * 40).strip()) + 3), ("3", 5), ("3", 5), ("None", 0)]


def test_points_of_surge_and_dive():
    assert stretches([0, 5, 0, 0, 0, 90, 3, 0, 0, 40, 0, 0, 0, 0, 95]) == [(5, 10), (14, 15)]
    assert stretches([4, 0, 2]) == [(0, 3)]
    assert stretches([0, 0]) == [] == stretches([])


def test_text_between_the_points_without_any_telling_names():
    menu = "<div>" + "".join(f"<div><a href=/{k}>Section {k}</a></div>" for k in range(8)) + "</div>"
    body = f"<div><h2>Title</h2><div>{LONG * 2}</div><div>Short.</div><div>{LONG}</div></div>"
    foot = "<div>" + "<div><a href=/x>About us</a></div>" * 5 + "<div>Imprint</div></div>"
    assert extract(f"<html><body>{menu}{body}{foot}</body></html>") == "\n\n".join(["Title", (LONG * 2).strip(), "Short.", LONG.strip()])


def test_links_between_two_parts_of_the_text_are_left_out():
    links = "<ul>" + "<li><a href=/r>Read this too</a></li>" * 6 + "</ul>"
    assert extract(f"<div><p>{LONG}</p><p>{LONG}</p>{links}<p>{LONG}</p></div>") == "\n\n".join([LONG.strip()] * 3)


@pytest.mark.parametrize("other", [
    "<nav><p>{}</p></nav>", "<header>{}</header>", "<footer><p>{}</p></footer>", "<aside><p>{}</p></aside>", "<form><p>{}</p><input></form>",
    '<div class="cookie-notice"><p>{}</p></div>', '<section id="comments"><article><p>{}</p></article></section>', "<script>var a = '<p>{}</p>';</script>",
    "<style>p {{ {} }}</style>", '<div class="sidebar widget"><p>{}</p></div>', '<div class="ad">{}</div>', "<!-- <p>{}</p> -->", "<noscript>{}</noscript>",
    '<div role="navigation">{}</div>', '<ul class="pageMenu"><li>{}</li></ul>', "<select><option>{}</option></select>", '<div hidden>{}</div>',
    "<title>{}</title>", "<template><p>{}</p></template>", '<div style="display: none">{}</div>', '<a href="x"></a><!-- > -->'])
@pytest.mark.parametrize("frame", ["{1}<article><h1>T</h1><p>{0}</p><p>End</p></article>{1}", "<div>{1}</div><div class=content><p>{0}</p>{1}<p>{0}</p></div>",
                                   "<main><p>{0}</p><p>{0}</p>{1}<p>x</p></main>"])
def test_what_is_not_the_article(other, frame):
    got = extract("<html><body>" + frame.format(LONG, other.format("Something else entirely, " * 3)) + "</body></html>")
    want = {"{1}<art": ["T", LONG.strip(), "End"], "<div>{1": [LONG.strip()] * 2, "<main><": [LONG.strip()] * 2 + ["x"]}[frame[:7]]
    assert got == "\n\n".join(want)


def test_names_around_an_article_do_not_hide_it():
    assert extract(f'<div class="page with-sidebar widget"><article class="has-banner"><p>{LONG}</p></article></div>') == LONG.strip()


def test_headings_of_an_article_header_stay():
    assert extract(f"<article><header><h1>T</h1><p>By somebody</p></header><p>{LONG}</p></article>") == f"T\n\n{LONG.strip()}"


def test_blocks_and_references():
    page = f"<p>A&amp;B&nbsp;c<b>d</b>e<br>f<br><br>g &lt;p&gt; &#x41;&eacute;\n\n h</p><p>{LONG}<table><tr><td>1<td>2</tr></table><ul><li>x<li>y</ul>"
    assert extract(page) == "\n\n".join(["A&B cde f", "g <p> Aé h", LONG.strip(), "1 2", "x", "y"])


def test_whole_texts_without_markup_stay():
    assert extract("a < b and c > d") == "a < b and c > d"
    assert extract("<article><p><a href=/x>Only a link</a></p></article>") == "Only a link"
    assert extract(None) == extract("") == extract("<p></p>") == ""
    assert extract("<article><p>cut <b of") == "cut <b of"


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "</div>" * 200_000 + "x", "<a " * 150_000, '<a b="' * 100_000, "<!--" * 100_000, "<select>" * 50_000,
                                  "<p>" * 200_000, "<li>a" * 100_000, "&amp" * 200_000])
def test_time_is_proportional_to_length(page):
    start = time.perf_counter()
    extract(page)
    assert time.perf_counter() - start < 10
