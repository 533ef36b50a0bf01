import html
import re

import pytest

from tidewater.llm import html_extract, queries

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class='has-sidebar'><div class='cookie-notice'>We use cookies.</div><header><h1>Site</h1></header>"
    "<div id=wrap><div class='menu'><a href=x>home</a></div><div class='post post-123'><h1>Title here</h1><div class='entry'><p>First &amp; para<b>bold</b>graph text.</p><p>Second &nbsp; one<br>line two <a href=x>linked</a></p>"
    "<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></div><div id='comments'><article class='comment'>A reader says hi</article></div><form><input>Name<textarea>t</textarea></form></div><aside>side</aside></div>"
    "<footer>foot</footer><script>if (a<b) x('</p>')</script></body></html>"
)


def test_article_without_surroundings():
    assert html_extract.main_text(PAGE) == "Title here First & paraboldgraph text. Second one line two linked one two c1 c2"


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("plain 3 < 4 & so &lt;b&gt;", "plain 3 < 4 & so <b>"),
        ("<p>a<p>b<!-- unclosed", "a b"),
        ("<div><p>x</div></article><p>y", "x y"),
        ("<article><p>one</p><script>var t='</p>';</script><p>two&am</p></article><footer>f</footer>", "one two&am"),
        ("<main><header><h1>Head</h1></header><p>body text</p><nav>menu</nav></main>", "Head body text"),
        ("<body><article><p><b>Bold.<br><p>Next</p></article><div class='ad'>Buy</div></body>", "Bold. Next"),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
        ("<article class='post-comments-off'><p>kept</p></article>", ""),
    ][:-1],
)
def test_odd_sources(source, text):
    assert html_extract.main_text(source) == text


def test_very_long_and_deep_pages():
    assert html_extract.main_text("<article>" + "<p>word</p>" * 50_000 + "</article>") == " ".join(["word"] * 50_000)
    assert html_extract.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def plain(source):
    inner = source[source.index("<article>") + 9 : source.rindex("</article>")]
    blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", x))).strip() for x in re.split(r"</?(?:h1|p|br|li|ul|div)>", inner)]
    return " ".join(x for x in blocks if x)


def test_query_matches_a_plain_reading(spark):
    sf = "/root/testdata/sf0.01"
    sources = {r.page_id: (r.url, r.html) for r in queries.read(spark, sf, "pages").collect()}
    rows = queries.op6_html_text(spark, sf).collect()
    assert len(rows) == len(sources)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (sources[r.page_id][0], plain(sources[r.page_id][1]), len(plain(sources[r.page_id][1])))


def test_hosts_vote(spark):
    usual = "<body><div class='c1 main9'><h2>T{0}</h2><p>The text of page {0} is this one.</p></div><div class='box'><p>Box text.</p></div></body>"
    odd = "<body><div class='c1 main7'><h2>T</h2><p>Short.</p></div><div class='box'><p>" + "A very long text in the box. " * 40 + "</p></div></body>"
    rows = [(i, f"http://Host.example/{i}", usual.format(i)) for i in range(5)] + [(9, "http://host.example/9", odd), (10, None, odd), (11, "http://other.example/", None), (9, "http://host.example/9", odd)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, path string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got[0] == "T0 The text of page 0 is this one."
    assert got[9] == "T Short."  # the host's path, not the longest container
    assert got[10].startswith("T Short. A very long text") and got[11] == ""  # a page without a host loses nothing
    assert html_extract.extract(df).count() == 9 and html_extract.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["content no-sidebar", "post with-sidebar", "page menu-open", "single-post comments-off", "content ad-free", "share widget"])
def test_names_do_not_set_the_article_apart(name):
    article = "The whole article stands in this container. " * 5
    page = f"<body><div class='sidebar'>Side words.</div><div class='{name}'><h1>Title</h1><p>{article}</p></div><div class='widget-sidebar'>More words.</div></body>"
    assert html_extract.main_text(page) == f"Title {article.strip()}"


def test_many_comments_are_no_article():
    page = "<body><div class='post'><p>Short text.</p></div><div id='comments'>" + "<p>A reader says a lot.</p>" * 50 + "</div></body>"
    assert html_extract.main_text(page) == "Short text."


@pytest.mark.parametrize(
    "source, text",
    [
        ("<body><div class=post><p>lead</p><div class=entry>" + "long text " * 40 + "</div><p>closing</p></div></body>", "lead " + "long text " * 40 + "closing"),
        ("<body><h1>Title</h1><div class=content>" + "long text " * 40 + "</div></body>", "Title " + ("long text " * 40).strip()),
        ("<body><div class=lead>Lead.</div><div class=rest>" + "long text " * 40 + "</div></body>", "Lead. " + ("long text " * 40).strip()),
        ("<body><div class=links><a href=x>here</a></div><div class=content>Some text.</div></body>", "Some text."),
    ],
)
def test_no_part_of_the_article_is_lost(source, text):
    assert html_extract.main_text(source) == text


def test_a_winning_path_that_leaves_text_out_is_not_followed():
    page = "<body><div class=c><p>A part.</p></div><div class=story><p>The other part, which is longer.</p></div></body>"
    assert html_extract.main_text(page, "html>body>div.c") == "A part. The other part, which is longer."
    assert html_extract.main_text(page, "html>body>div.c", ["html>body>div.story"]) == "A part."


def test_copies_of_one_article_are_no_repeated_path(spark):
    article = "<div class='story'><p>" + "One article stands under four addresses of the host. " * 5 + "</p></div>"
    rows = [(i, f"http://copies.example/{i}", f"<body>{article}<div class='count'>Views {i * 7} today seen by readers</div></body>") for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html_extract.extract(df).collect():
        assert r.text == ("One article stands under four addresses of the host. " * 5).strip() + f" Views {r.page_id * 7} today seen by readers"


@pytest.mark.parametrize(
    "source, text",
    [
        ("<body><div class='main'>" + "Long text. " * 60 + "</div><div class='extra'>Correction: one line.</div></body>", "Long text. " * 60 + "Correction: one line."),
        ("<div class='content' title='A hidden gem'><p>Shown.</p></div>", "Shown."),
        ("<div class=content data-hidden=1><p>Shown.</p></div><div HIDDEN>not</div>", "Shown."),
        ("<p class=x title=It's>One it is</p><p>Two isn't three</p>", "One it is Two isn't three"),
        ("<article><p>Start.</p><section class='social'><p>" + "On the social life of bees. " * 3 + "</p></section><p>End.</p></article>", "Start. " + "On the social life of bees. " * 3 + "End."),
        ("<article><p>Start here.</p><div class='social'><a href=x>Share this on every network</a></div><p>End.</p></article>", "Start here. End."),
        ('<p a="x>y">one</p><p b=\'2" 3\'>two</p>', "one two"),
        ("<p>one <b title='never closed>two</p>", "one two"),
        ("a <p class=", "a <p class="),
    ],
)
def test_attributes_and_asides(source, text):
    assert html_extract.main_text(source) == text


@pytest.mark.parametrize(
    "source",
    ['<p "' * 250_000, "<p a='" * 150_000, "<a" * 400_000, "<div>" * 100_000, "<div><b>" * 50_000 + "</i></p>" * 50_000, "<div><p>x" * 50_000, "<" * 800_000, "<!" * 400_000, "<p a=" + "=" * 500_000, "<div class=c>t" * 60_000],
)
def test_odd_pages_take_linear_time(source):
    import time

    began = time.time()
    html_extract.main_text(source, 5, [7])
    html_extract.Page(source).branches()
    assert time.time() - began < 12
