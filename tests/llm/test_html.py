"""HTML extraction: the whole table against a plain reading of its layout, other layouts by hand."""

from __future__ import annotations

import html as H
import re

import pytest

from tsuji.llm import html_text as ht
from tsuji.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [H.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(x for x in (" ".join(p.split()) for p in parts) if x)


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op6_html"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text)


@pytest.mark.parametrize("page, want", [
    ("", []), ("just  text &amp; more", ["just text & more"]), ("a < b <c", ["a < b"]),
    ("<body><header><h1>Site</h1></header><main><h1>T</h1><p>One<p>Two <i>x</i>y<br>z</main><footer>f</footer>", ["T", "One", "Two xy z"]),
    ("<div class='content'><p>A</p><div class='sidebar-left'><p>B</p></div><p>C</p></div>", ["A", "C"]),
    ("<article><header><h1>T</h1></header><p>A</p><aside>no</aside><section id=comments><article class=comment><p>no</p></article></section><p>B</article>",
     ["T", "A", "B"]),
    ("<nav><p>x</nav><p>y<script>if (a</p>) '<p>'</script>z", ["yz"]),
    ("<!-- <p>no</p> --><p hidden>no</p><p style='display: none'>no</p><p>&eacute;&nbsp; &#x41;&lt;b&gt;</p>", ["é A<b>"]),
    ("<ul><li>a<li>b <b>c</b></ul><form><p>no</p></form><table><tr><td>1<td>2<tr><td>3</table>", ["a", "b c", "1 2", "3"]),
    ("<div class=cookie-notice>no</div><p title='a>b'>ok</p><p title=\"x>open</p>", ["ok", "open"]),
    ("<ARTICLE><P>Up</P></ARTICLE><div>after</div>", ["Up"]),
    ("<article><h2 id=\"notice-periods\">Notice periods</h2><p>x</p><section id=\"related-work\"><p>Earlier work</p></section>"
     "<p>Let <math><mi>n</mi></math> be</p></article>", ["Notice periods", "x", "Earlier work", "Let n be"]),
    ("<article><p id=comments>a</p><p class='lead share-price'>b</p><div class='ad-box top'>no</div><div id=comments><p>no</p></div>"
     "<object>c</object><fieldset>d</fieldset><div class='banner-ads-2'>no</div><video>e</video></article>", ["a", "b", "c", "d", "e"]),
    ("<div class='content-with-sidebar'><p>A</p></div><div class=site-footer>no</div><div id=top-menu>no</div>", ["A"]),
    ("<p>tail <script>never closed", ["tail"]), ("<p>x</p></div></article><p>y", ["x", "y"]),
])
def test_layouts(page, want):
    assert ht.parse(page) == want


def test_template_is_removed_per_host_and_articles_keep_their_text(spark):
    rows = []
    for i in range(40):
        rows.append((i, f"https://a.example/{i}", f"<div>Welcome to our site</div><div><p>Story {i}</p><p>More {i}</p></div><p>All rights</p>"))
        rows.append((100 + i, f"https://b.example/{i}", f"<article><p>Same line</p><p>Story {i}</p><div>Follow us</div></article>"))
        rows.append((200 + i, f"https://c{i}.example/", "<div>Welcome to our site</div><p>Kept</p>"))
    got = {r.page_id: r.text for r in ht.page_report(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    for i in range(40):
        assert got[i] == f"Story {i}\nMore {i}"
        assert got[100 + i] == f"Same line\nStory {i}"
        assert got[200 + i] == "Welcome to our site\nKept"


def test_nulls_repeats_empty(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (None, "x", "<p>a"), (2, "http://h/", "")], "page_id long, url string, html string")
    got = sorted(map(tuple, ht.page_report(df).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (1, None, "", 0), (None, "x", "a", 1), (2, "http://h/", "", 0)], key=str)
    assert ht.page_report(df.limit(0)).collect() == []


def test_long_odd_pages_end_quickly():
    assert len(ht.parse("<p>x" * 50_000)) == 50_000
    assert ht.parse("<div>" * 20_000 + "x") == ["x"]
    found = []
    ht.parse("<div>" * 20_000 + "x", None, found)
    assert len(set(found)) == 20_000
    assert ht.parse("<" * 100_000)


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    return {r.page_id: r.text for r in ht.page_report(df).collect()}


def test_repeats_and_url_variants_of_a_page_are_one_page(spark):
    page = "<div><h2>Title</h2><p>One</p><ul><li>a</li></ul></div>"
    rows = [(i, f"https://a.example/x?page={i}" if i % 2 else "https://a.example/x", page) for i in range(30)]
    assert set(texts(spark, rows).values()) == {"Title\nOne\na"}


def test_recurring_blocks_of_article_and_main_stay(spark):
    block = ("<div><p>Box</p></div><section><h2>Sec</h2></section><ul><li>u</li></ul><ol><li>o</li></ol><table><tr><td>t</td></tr></table>"
             "<figure><figcaption>f</figcaption></figure><dl><dt>k</dt><dd>v</dd></dl>")
    rows = []
    for i in range(40):
        rows.append((i, f"https://a.example/{i}", f"<div>Menu</div><article><p>Story {i}</p>{block}</article>"))
        rows.append((100 + i, f"https://b.example/{i}", f"<div>Menu</div><main><p>Story {i}</p>{block}<div>loose</div></main>"))
    got = texts(spark, rows)
    kept = "Box\nSec\nu\no\nt\nf\nk\nv"
    for i in range(40):
        assert got[i] == f"Story {i}\n{kept}"
        assert got[100 + i] == f"Story {i}\n{kept}\nloose"


def test_a_template_of_a_small_part_of_a_host_is_removed(spark):
    rows = [(i, f"https://a.example/{i}", f"<div><p>Story {i}</p></div>" + ("<div>Shop banner</div>" if i < 20 else "")) for i in range(200)]
    got = texts(spark, rows)
    assert all(got[i] == f"Story {i}" for i in range(200))


def test_menus_notices_and_adverts_with_neutral_names_go_by_their_count(spark):
    """Nothing but recurrence tells these parts from the story; without the pass they would stay."""
    def page(i):
        return (f"<div class=x1><a href=/>Home</a> <a href=/n>News</a></div><div class=x2><ul><li>Politics<li>Sport</ul></div>"
                f"<div class=x3><h2>Story {i}</h2><p>Text {i}</p></div><div class=x4><p>We use small files</p><span>Accept</span></div>"
                f"<table class=x5><tr><td>Buy now</td></tr></table><div class=x6>Printed by Z</div>")

    rows = [(i, f"https://a.example/{i}", page(i)) for i in range(30)]
    got = texts(spark, rows)
    assert all(got[i] == f"Story {i}\nText {i}" for i in range(30))
    assert ht.parse(page(1)) != got[1].split("\n")
