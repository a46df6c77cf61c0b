"""Extraction of main text: lines of a page, alignment, neighbours, whole tables."""

import html
import random
import re

from fringeframe.llm import html_extract
from pyspark.sql import functions as F

S = "page_id long, url string, html string"
X = html_extract


def texts(spark, rows):
    return {r["page_id"]: r for r in X.extract(spark.createDataFrame(rows, S)).collect()}


def test_given_table(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    want = {}
    for r in df.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1].replace("<br>", " ").replace("<b>", "")
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        want[r["page_id"]] = (r["url"], "\n\n".join(b for b in blocks if b))
    got = X.extract(df).collect()
    assert len(got) == len(want) and {r["page_id"]: (r["url"], r["text"]) for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert plain_shared(df.collect()) == {r["page_id"]: r["n_shared"] for r in got}


def lcs_size(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def plain_shared(rows):
    """{page: lines outside the main text that are shared with the neighbours}, neighbours found by sorting."""
    units, pages = {}, []
    for r in rows:
        m = re.match(r"https?://([^/?#]*)([^?#]*)", r["url"])
        lines = X.page_lines(r["html"])
        path = re.sub(r"(?:\.html?|/)$", "", m[2])
        key = (m[1], X._digest(lines))
        units[key] = (min(units.get(key, (path,))[0], path), [t for t, _ in lines])
        pages.append((r["page_id"], key, lines))
    order = sorted((k[0].encode(), v[0].encode(), k[1], v[1]) for k, v in units.items())
    shared = {}
    for i, u in enumerate(order):
        found = set()
        for j in (i - 1, i + 1):
            if 0 <= j < len(order) and order[j][0] == u[0]:
                places, _ = X.common_places(u[3], order[j][3])
                assert len(places) == lcs_size(u[3], order[j][3])
                found.update(places)
        shared[(u[0].decode(), u[2])] = found
    return {p: sum(1 for i in shared[k] if lines[i][1] not in (X.MAIN, X.ARTICLE)) for p, k, lines in pages}


def test_alignment_is_longest():
    r = random.Random(1)
    bits = X.TABLE_BITS
    try:
        for X.TABLE_BITS in (bits, 30, 1):
            for _ in range(800):
                a, b = ([r.randrange(r.randint(1, 9)) for _ in range(r.randint(0, 14))] for _ in range(2))
                x, y = X.common_places(a, b)
                assert [a[i] for i in x] == [b[j] for j in y] and x == sorted(set(x)) and y == sorted(set(y)) and len(x) == lcs_size(a, b)
    finally:
        X.TABLE_BITS = bits


def test_long_pages_align():
    a = [f"l{i % 5000}" for i in range(30_000)]
    x, y = X.common_places(a, a[1:] + ["new"])
    assert len(x) == len(y) == 29_999


def test_differencing_decides_without_article(spark):
    """Pages of plain divisions: what neighbours share goes, what differs stays, one page of another host stays whole."""
    page = lambda t: f"<div>Home</div><div>News</div><div>{t}</div><p>second {t}</p><div>Contact us</div>"
    rows = [(i, f"http://h.org/a/{i}.html?x=1", page(f"story {i}")) for i in range(40)] + [(99, "http://other.org/a/1", page("alone"))]
    got = texts(spark, rows)
    assert all(got[i]["text"] == f"story {i}\n\nsecond story {i}" and got[i]["n_shared"] == 3 for i in range(40))
    assert got[99]["text"] == "Home\n\nNews\n\nalone\n\nsecond alone\n\nContact us" and got[99]["n_shared"] == 0


def test_order_of_shared_lines_matters(spark):
    """A line that both pages have, but not in the same order among the others, is not aligned."""
    got = texts(spark, [(1, "http://h.org/1", "<p>A<p>B<p>C<p>only one"), (2, "http://h.org/2", "<p>C<p>A<p>B<p>only two")])
    assert got[1]["text"] == "C\n\nonly one" and got[2]["text"] == "C\n\nonly two"


def test_copies_do_not_delete_each_other(spark):
    rows = [(i, f"http://h.org/{i % 7}?ref={i}", "<div>Top</div><p>Same story</p>") for i in range(30)] + [(50, "http://h.org/9", "<div>Top</div><p>Other</p>")]
    got = texts(spark, rows)
    assert {got[i]["text"] for i in range(30)} == {"Same story"} and got[50]["text"] == "Other"


def test_article_lines_stay(spark):
    page = lambda i: f"<nav>Menu</nav><article><h1>T{i}</h1><p>Released under a licence.</p></article><div class=ad>Buy {i}</div>"
    got = texts(spark, [(i, f"http://h.org/{i}", page(i)) for i in range(5)])
    assert all(got[i]["text"] == f"T{i}\n\nReleased under a licence." and got[i]["n_shared"] == 1 and got[i]["n_marked"] == 2 for i in range(5))


def test_elements_outside_the_main_text():
    cases = {
        '<body class="no-sidebar"><nav><ul><li>m<li>n</ul></nav><main><header><h1>T</h1>by me</header><p>One<p>Two <b>x</b>y<aside>side</aside>'
        '<section id="comments"><article class="comment">c</article></section></main><footer>f': ["T", "One", "Two xy"],
        '<div class="has-sidebar"><article><h1>H</h1><ul><li>a<li>b<ul><li>c</ul></ul></article><div id="cookie-notice">k</div></div>': ["H", "a", "b", "c"],
        "<div class='sidebar'><article>in a marked wrapper</article></div><form><p>f<input><article>no</article></form>": ["in a marked wrapper"],
        "<article>a<nav>b</nav>c<div role=navigation>d</div><p class='ad'>e<p>g</article>": ["a", "c", "g"],
        '<article><div class="post-header">kept</div><div class="site-header">gone</div><span class="advert">gone</span> too</article>': ["kept", "too"],
    }
    for page, want in cases.items():
        lines = X.page_lines(page)
        best = max(k for _, k in lines if k != X.MARKED)
        assert [t for t, k in lines if k == best] == want, page


def test_markup():
    one = lambda page: [t for t, _ in X.page_lines(page)]
    assert one("a < b <3 &copy <!-- x --> <script>\"</p>\"</script>c<style>p{}</style>") == ["a < b <3 © c"]
    assert one("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert one("<a title='x>y'>q</a> <p title=\"oops>z</p>") == ["q", "z"]
    assert one("x&nbsp;&nbsp;y\n\t z<br>w<!-- open <p>never") == ["x y z w"]
    assert one("&amp;amp; &#65;&#x42; &quo &am") == ["&amp; AB &quo &am"]
    assert one("<p>a</p></p></div><b>b") == ["a", "b"] and one("") == [] and one("<p><p> <div>") == []
    assert one("<SCRIPT>x</Script ><P>A</P><textarea>t</textarea>") == ["A"]


def test_awkward_rows(spark):
    rows = [(None, None, None), (None, None, "<p>x</p>"), (1, "", "<p>y</p>"), (2, "not a url", "<p>z</p>"), (3, "http://h/", ""), (4, "http://h/a", "<p>q</p>"), (4, "http://h/a", "<p>q</p>"),
            (5, "http://h/b", "<p>" + "long text " * 200_000 + "</p>"), (6, "http://h/c", "<div>" * 3000 + "deep"), (7, "//u@H:80/c", "<p>r</p>")]
    df = spark.createDataFrame(rows, S)
    got = sorted(((r["page_id"] or 0), r["text"], r["n_chars"]) for r in X.extract(df).collect())
    want = ["", "x", "y", "z", "", "q", "q", ("long text " * 200_000).strip(), "deep", "r"]
    assert got == sorted((r[0] or 0, t, len(t)) for r, t in zip(rows, want))
    wide = df
    for c in ("text", "host", "path", "digest", "marks", "n", "shared", "part", "kinds"):
        wide = wide.withColumn(c, F.lit(1))
    assert sorted(((r["page_id"] or 0), r["text"], r["n_chars"]) for r in X.extract(wide).collect()) == got
    assert X.extract(df.limit(0)).count() == 0
