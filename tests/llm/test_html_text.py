import html
import re
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featherloom.llm.html_text import (
    best_container, block_text, elements_on, extract_text, page_tree)
from featherloom.llm.queries import op1_html_extraction


def own(page):
    return block_text([best_container(page_tree(page))])


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("<", "<"), ("<p", ""), ("<script>x", ""), ("<!-- x", ""), ("</p></div>x", "x"),
    ("a<b>c</b>d", "acd"), ("<p>a<br>b<p>c", "a b c"), ("&amp;&nbsp;&eacute;&#x41;", "& éA"),
    ("<ul><li>a<li>b</ul>", "a b"), ("a < b", "a < b"), ("<p title='a>b'>c</p>", "c"),
    ("<body><article>x<script>var t='</p>'</script>y<!-- <p>no</p> --></article></body>", "x y"),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"), ("<P>A</P><STYLE>no</STYLE>", "A"),
    ("<article><h1>T</h1><p>long body</p><div class='comments'>no</div>"
     "<div id='related-posts'>no</div><form>no</form><p>end</p></article>", "T long body end"),
    ("<body><div class='cookie-notice'>we use cookies</div><div class='content'><p>one</p>"
     "<p>two</p></div><div class='sidebar'><p>much longer text than the article itself</p></div>"
     "</body>", "one two"),
])
def test_own_container(page, text):
    assert own(page) == text


@pytest.mark.parametrize("step", ["<div class='a'>", "<font>x</b>", "<div class='w-1/2'><p>"])
def test_deep_pages_take_memory_by_their_length(step):
    page = step * 50_000 + "<p>deep text at the end</p>"
    tracemalloc.start()
    try:
        text = own(page)
        assert tracemalloc.get_traced_memory()[1] < 200 << 20
    finally:
        tracemalloc.stop()
    assert text.endswith("deep text at the end")


def test_forms_and_headers_by_evidence():
    wrapped = ("<body><form id='aspnetForm' class='{0}'><input value='x'><nav>menu</nav>"
               "<div class='content'><h1>T</h1><p>" + "long article text " * 9 + "</p></div>"
               "<div class='sidebar'><p>beside</p></div></form><div>a foot</div></body>")
    for name in ("", "form", "page-form"):
        assert own(wrapped.format(name)) == "T " + " ".join(["long article text"] * 9)
    article = "<p>" + "the article itself " * 9 + "</p>"
    text = " ".join(["the article itself"] * 9)
    form = "<form><p>leave a comment, " + "write here " * 9 + "</p></form>"
    assert own(f"<body><article>{article}{form}</article></body>") == text
    assert own(f"<body><div class='content'>{article}</div>{form}</body>") == text
    assert own(f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1></header>"
               f"{article}</article></body>") == f"Title {text}"
    assert own(f"<body><article><header class='site-header'>x</header>{article}</article>"
               "</body>") == text


def test_classes_with_slashes_are_one_step():
    root = page_tree("<div class='w-1/2 b'><div><p>some text</p></div></div><div class='b'></div>")
    best = best_container(root)
    assert [block_text([e]) for e in elements_on(root, best.path())] == ["some text"]


def test_articles_of_the_table(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()
    got = {r.page_id: r for r in op1_html_extraction(spark, folder).collect()}
    assert len(got) == len(pages)
    for r in pages:
        body = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        text = re.sub(r"<(?!/?b>)[^>]*>", " ", body[1]) if body else ""
        want = " ".join(html.unescape(re.sub(r"</?b>", "", text)).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


def test_the_host_decides(spark):
    page = ("<body><div class='post7'><p>{0}</p></div><div class='box'><p>{1}</p></div></body>")
    rows = [(i, "http://h.org/" + str(i), page.format("long article text " * 5, "box"), "t")
            for i in range(5)]
    # on its own this page would choose the box; its host knows better
    rows += [(9, "http://h.org/9", page.format("short", "a much longer box " * 9), "t"),
             (10, None, None, "t"), (11, "x", "", "t"), (12, None, "<p>plain</p>", "t"),
             (9, "http://h.org/9", page.format("short", "a much longer box " * 9), "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, page_html string")
    out = extract_text(df, keep=("page_id", "page_html")).collect()
    texts = sorted((r.page_id, r.text) for r in out)
    assert texts[5:] == [(9, "short"), (9, "short"), (10, ""), (11, ""), (12, "plain")]
    assert {r.page_html for r in out} == {"t"}
    assert extract_text(df.limit(0)).count() == 0


def test_pages_of_one_host_spread_over_tasks(spark):
    rows = [(i, f"http://{'big.org' if i % 3 else f'h{i}.org'}/{i}", f"<p>text {i}</p>", "x", "y")
            for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, __hot string, "
                                     "`k0` string").repartition(8)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        out = extract_text(df, keep=("page_id", "url", "__hot", "k0")).withColumn(
            "task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert {(r.page_id, r.text, r["__hot"], r.k0) for r in out} == {
        (i, f"text {i}", "x", "y") for i in range(3000)}
    sizes = Counter(r.task for r in out if "big.org" in r.url)
    assert max(sizes.values()) < 0.5 * 2000


LONG = "a long sentence of the article, outside links " * 3
SHORT = "another sentence that is shorter"


@pytest.mark.parametrize("names", [
    "class='content with-sidebar'", "class='layout no-sidebar'", "class='page-container has-header'",
    "class='post legal'", "id='sidebar-layout'", "class='main-wrap search'"])
@pytest.mark.parametrize("inner", [
    "<article><h1>T</h1><p>{}</p></article>", "<h1>T</h1><p>{}</p>"])
def test_layout_names_do_not_cut_the_article(names, inner):
    page = (f"<body><div {names}>{inner.format(LONG)}<div class='sidebar'><p>{SHORT}</p></div></div>"
            "<div class='footer'><p>imprint</p></div></body>")
    assert own(page) == f"T {LONG.strip()}"


def test_names_that_still_cut():
    article = f"<div class='content'><p>{SHORT}</p></div>"
    for names in ("class='comments'", "id='related-posts'", "class='ad'"):
        other = f"<div {names}><article><h3>x</h3><p>{LONG}</p></article></div>"
        assert own(f"<body>{article}{other}</body>") == SHORT
    head = f"<article><div class='entry-header'><h1>T</h1></div><p>{SHORT}</p></article>"
    assert own(f"<body>{head}</body>") == f"T {SHORT}"


@pytest.mark.parametrize("outer", ["article", "main", "div"])
@pytest.mark.parametrize(("inner", "text"), [
    (f"<h1>T</h1><p class='lead'>lead</p><div class='body'><p>{LONG}</p></div>", f"T lead {LONG}"),
    (f"<div class='a'>{LONG}</div><div class='b'>{SHORT}</div>", f"{LONG} {SHORT}"),
    (f"<div class='a1'><p>{LONG}</p></div><div class='a2'>end</div>", f"{LONG} end")])
def test_nothing_beside_the_largest_part_is_lost(spark, outer, inner, text):
    page = (f"<body><{outer} class='x'>{inner}</{outer}>"
            "<div><a href='/'>many words of a list of links</a></div></body>")
    df = spark.createDataFrame([(i, "http://h.org/", page) for i in range(2)],
                               "page_id long, url string, html string")
    assert {r.text for r in extract_text(df).collect()} == {" ".join(text.split())}
