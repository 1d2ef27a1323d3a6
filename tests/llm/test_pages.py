"""Page extraction: parsing, alignment, pairing across ranges, whole tables."""

import random
from functools import lru_cache

import pytest

from valuetide.llm import pagediff, queries

from .conftest import SMALL


def text(html, shared=()):
    return pagediff.main_text(pagediff.page_lines(html), set(shared))


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a &amp; b&nbsp;c<br>d\n  e</p><p> </p><p>f", "a & b c d e\nf"),
        ('<article><h1>T</h1><p><b>one<br><p>two</article><footer>x</footer>', "T\none\ntwo"),
        ('<script>var t="</p>";</script><style>p{}</style><!-- <p>no</p> --><p>yes', "yes"),
        ('<nav><ul><li><a href="/a">A</a></li></ul></nav><main><div>m</div></main><aside>s</aside>', "m"),
        ('<div class="ad">buy</div><div id="content"><p>t</p></div><div class="post-comments"><p>c</p></div>', "t"),
        ('<article><header><h1>T</h1></header><p>b</p><aside>s</aside><section class="comments"><article><p>c</p></article></section></article>', "T\nb"),
        ('<body class="no-sidebar"><div role="navigation">n</div><form><p>f</p><input></form><p>x</p></body>', "x"),
        ("<article><p>cut off in the <b>mid", "cut off in the mid"),
        ("<p title='a > b'>q</p>", "q"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
    ],
)
def test_lines_of_a_page(html, want):
    assert text(html) == want


def test_shared_lines_go_where_no_article_is_marked():
    assert text("<div>Home</div><p>own</p><div>Bye</div>", {0, 2}) == "own"
    assert text("<div>Home</div><article><p>own</p></article>", {0, 1}) == "own"


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))

        @lru_cache(None)
        def best(i, j):
            if i == len(a) or j == len(b):
                return 0
            return max(best(i + 1, j), best(i, j + 1), (a[i] == b[j]) and 1 + best(i + 1, j + 1))

        places = pagediff.common_lines(a, b)
        assert len(places) == best(0, 0) and places == sorted(set(places))
        rest = iter(b)
        assert all(a[k] in rest for k in places)


def pages_of(spark, n):
    menu = [f"<div>menu {k}</div>" for k in range(6)]
    rows = []
    for k in range(n):
        host = "a.example" if k % 3 else "b.example"
        body = "".join(menu[:4] if host[0] == "a" else menu[2:]) + f"<p>text {k} one</p><p>text {k} two</p>"
        rows.append((k, f"https://www.{host}/en/{k * 37 % 1000}?q=1", body))
    rows += [(0, rows[0][1], rows[0][2]), (None, None, None), (500, "", ""), (501, "http://[bad", "<p>x"), (502, None, "<p>y")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_menus_without_marks_go_by_differencing(spark):
    got = pagediff.extract(pages_of(spark, 60)).collect()
    assert len(got) == 65
    for r in got:
        if r.page_id is not None and r.page_id < 60:
            assert r.text == f"text {r.page_id} one\ntext {r.page_id} two" and r.n_shared == 4
        assert r.n_chars == len(r.text)
    assert {r.page_id: r.text for r in got if r.page_id in (None, 500, 501, 502)} == {None: "", 500: "", 501: "x", 502: "y"}


def test_pairs_do_not_depend_on_ranges(spark):
    pages = pages_of(spark, 40)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found.append(sorted(map(tuple, pagediff.extract(pages).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] == found[1] == found[2]


def test_pages_table_gives_the_articles(spark):
    got = queries.queries()["op9_page_differencing"](spark, SMALL)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    assert got.count() == pages.count()
    # Every article is a heading and the lines of some document.
    lines = lambda text: tuple(y for x in text.split("\n") if (y := " ".join(x.split())))
    known = {lines(r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in got.collect():
        assert tuple(r.text.split("\n")[1:]) in known, r.page_id


def test_no_page_loses_a_line_of_its_article(spark):
    """The larger table, where chance makes equal sentences in neighbours."""
    folder = "/root/testdata/sf0.1"
    lines = lambda text: tuple(y for x in (text or "").split("\n") if (y := " ".join(x.split())))
    known = {lines(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()}
    got = queries.queries()["op9_page_differencing"](spark, folder).collect()
    assert len(got) == 2500 and all(tuple(r.text.split("\n")[1:]) in known for r in got)


def test_long_pages_and_clashing_columns(spark):
    body = "".join(f"<p>line {k}</p>" for k in range(30_000))
    pages = [f"<div>Top</div><p>own {k}</p>{body if k == 3 else ''}" for k in range(6)]
    rows = [(k, f"http://h.example/a/{k}", h) for k, h in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.selectExpr("*", "'own' AS text", "1 AS key", "'own' AS shared", "2 AS host", "3 AS n_shared", "4 AS lines")
    got = {r.page_id: r for r in pagediff.extract(df).collect()}
    assert [got[k].text for k in (0, 1, 2, 4, 5)] == [f"own {k}" for k in (0, 1, 2, 4, 5)]
    assert got[3].text.split("\n") == ["own 3", *(f"line {k}" for k in range(30_000))]


def test_equal_sentences_of_neighbours_stay(spark):
    page = "<div>Top</div><main><div>Home</div><h1>News</h1><p>one {k}</p><p>The end.</p></main>"
    got = by_page(spark, [page.format(k=k) for k in range(8)])
    assert got == {k: f"News\none {k}\nThe end." for k in range(8)}


def test_empty_pages_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert pagediff.extract(none).collect() == []


def by_page(spark, rows):
    df = spark.createDataFrame([(k, f"http://h.example/a/{k:03}", h) for k, h in enumerate(rows)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in pagediff.extract(df).collect()}


def test_shared_lines_inside_main_go_and_own_lines_outside_stay(spark):
    shared = "<div>Home</div><div>Terms apply</div>"
    page = "<div>Top</div><main>{s}<article><p>teaser {k}</p></article>{s}</main><div><p>body {k}</p></div>"
    got = by_page(spark, [page.format(s=shared, k=k) for k in range(12)])
    assert got == {k: f"teaser {k}\nbody {k}" for k in range(12)}


def test_copies_of_an_article_do_not_delete_each_other(spark):
    page = "<div>Top</div><main><div>Home</div><p>one {k}</p><p>two {k}</p></main>"
    names = [0, 1, 1, 1, 1, 2]
    got = by_page(spark, [page.format(k=k) for k in names])
    assert got == {n: f"one {k}\ntwo {k}" for n, k in enumerate(names)}


def test_a_lone_copy_keeps_its_article():
    lines = pagediff.page_lines("<div>Top</div><article><p>a</p><p>b</p></article>")
    assert pagediff.main_text(lines, {0, 1, 2}) == "a\nb"


def test_many_shared_lines_do_not_make_copies(spark):
    """40 shared lines and 3 own ones, with runs of exact copies, without and with furniture marks."""
    for border in ("div", "nav"):
        menu = "".join(f"<{border}>m {k}</{border}>" for k in range(40))
        names = [0, 1, 2, 3, 3, 3, 3, 4, 5]
        got = by_page(spark, [menu + "".join(f"<p>t{i} {k}</p>" for i in range(3)) for k in names])
        assert got == {n: f"t0 {k}\nt1 {k}\nt2 {k}" for n, k in enumerate(names)}


@pytest.mark.parametrize("mark", ["id='related-work'", "id='search'", "class='ad-hoc'", "class='share-price wide'"])
def test_sections_of_an_article_named_like_furniture_stay(mark):
    assert text(f"<article><section {mark}><h2 id='social'>H</h2><p>t</p></section></article>") == "H\nt"
    assert text("<article><p>t</p><div class='wide share'>s</div></article>") == "t"
