import html
import re

import llm_data as D

from saleswh.llm import html_blocks, html_text, queries


def texts(page):
    return [b.text for b in html_blocks.blocks(page)]


def test_blocks():
    assert texts("") == [] and texts("plain &amp; simple") == ["plain & simple"]
    assert texts("<p>a <b>b</b>c<p>d<br>e<li>f<li>g</ul><!-- <p>no</p> --><script>var t='</p>no'</script>h") == ["a bc", "d e", "f", "g", "h"]
    assert texts("<div title='a > b'>x &#233;&nbsp;&lt; y\n\n z</div>< 3 <") == ["x é < y z", "< 3 <"]
    assert texts("<style>p{}</style><p>a</p><script>never closed <p>b") == ["a"]
    assert texts("<P CLASS=Big>a</P></div></p><td>b<td>c") == ["a", "b", "c"]
    [b] = html_blocks.blocks("<div class='post-body main' id=x1><ul><li><a href=#>link</a> text</ul>")
    assert b.path == (("div", "post", "body", "main", "x", "1"), ("ul",), ("li",)) and 0.4 < b.linked < 0.5
    assert len(texts("<p>" * 5000 + "deep")) == 1 and texts("<a b='" + "x" * 50000) == []


def test_markup_tells():
    assert html_text.marked((("body",), ("article",), ("p",))) == 1
    assert html_text.marked((("article",), ("div", "comments"), ("p",))) == 0
    assert html_text.marked((("article",), ("header",), ("h1",))) == 1
    assert html_text.marked((("body",), ("div",))) is None and html_text.marked((("nav",), ("main",))) == 0


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"</?(b|a|i|em|strong|span)\b[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|h2|br|ul|li|div)\b[^>]*>", inner)]
    return "\n".join(x for x in parts if x)


def test_articles_are_extracted_whole(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{D.SMALL}/pages.parquet").collect()}
    got = queries.QUERIES["op8_html_extraction"](spark, D.SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_other_sites_and_odd_pages(spark):
    table = spark.read.parquet(f"{D.SMALL}/pages.parquet")
    labeller = html_text.fit(table)
    body = "".join(f"<p>{D.sentences(i, 40).capitalize()}.</p>" for i in range(4))
    site = f"<body><header><a href=/>Home</a></header><aside class=sidebar><a href=/1>One</a></aside><main><h1>Title here</h1>{body}</main><section id=comments><p>First comment!</p></section><form>mail</form></body>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<nav><a>x</a></nav>"), (4, "u", site), (4, "u", site), (None, "u", site.replace("main>", "article>")), (5, "u", f"<article>{'<p>long text.</p>' * 3000}</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'old' as text", "3 as extra")
    got = html_text.extracted(pages, labeller).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and by[1].text == by[2].text == "" and by[1].n_chars == 0 and by[4].extra == 3
    assert by[4].text.count("\n") == 4 and "Home" not in by[4].text and "comment" not in by[4].text and by[None].text == by[4].text
    assert by[5].text.count("long text.") == 3000
    assert html_text.extracted(pages.limit(0), html_text.fit(table.limit(0))).count() == 0


def test_hidden_elements_hide_their_own_content_only():
    assert texts("<p>a <svg class=i/> b</p><p>c <svg viewBox='0 0 1 1' /> d</p><p>e") == ["a b", "c d", "e"]
    assert texts("<p>a <svg><title>no</title><g><text>no</text><path d=x></g></svg>b</p>c") == ["a b", "c"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p><math/>z") == ["Let x=1 be", "z"]
    for tag in ("select", "video", "object", "canvas", "audio", "noscript", "template"):
        assert texts(f"<div>a<{tag} id=x>no <b>no</b></{tag}>b</div>c") == ["a", "b", "c"]
        assert texts(f"<article><div>a<{tag} id=x>no</div><p>b</p></article>c") == ["a", "b", "c"]
        assert texts(f"<article><p>a<{tag}>no</p><p>b</article>c") == ["a", "b", "c"]
    assert texts("<article><svg><path d=x><p>a</p>b</article>c") == ["a", "b", "c"]
    assert texts("<p>a<svg><foreignObject><p>no</p><div>no</div></foreignObject></svg>b") == ["a", "b"]
    assert texts("<video src=x /><track src=y>no</video>a<iframe src=x><p>no</iframe>b<select><option>no<option>no</select>c") == ["a", "b", "c"]


def test_deep_pages_take_memory_by_their_length():
    import tracemalloc

    labeller = html_text.Labeller()
    tracemalloc.start()
    page = html_blocks.blocks("<div>x" * 100_000)
    [score] = labeller.scores([page])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(page) == len(score) == 100_000 and peak < 1 << 30
    assert page[-1].node.depth == 100_000 and page[2].path == (("div",),) * 3


def test_open_elements_do_not_slow_a_page():
    import time

    start = time.time()
    assert len(html_blocks.blocks("<b>" * 20_000 + "<div>x</div></i>" * 20_000)) == 20_000
    assert time.time() - start < 20


def test_pages_that_do_not_say_what_is_what(spark):
    """No telling names in any page of the sample: the example page teaches the labeller, and the article is found."""
    body = "".join(f"<p>{D.sentences(i, 45).capitalize()}. {D.sentences(i + 50, 30).capitalize()}, and so on.</p>" for i in range(5))
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(6))
    site = f"<body><div><ul>{links}</ul></div><div><h1>About words</h1>{body}</div><div><ul>{links}</ul></div></body>"
    pages = spark.createDataFrame([(i, "u", site.replace("About", f"About {i}")) for i in range(3)], "page_id long, url string, html string")
    for r in html_text.extracted(pages, html_text.fit(pages)).collect():
        assert "Link" not in r.text and sum(r.text.count(D.sentences(i, 45).capitalize()) for i in range(5)) == 5
