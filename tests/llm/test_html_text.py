import html
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tillscope.llm import html_text

SCHEMA = "page_id long, url string, html string, key string, host string, path string, text string, shared string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def text_of(spark, *rows):
    return {r.page_id: r.text for r in html_text.extract(pages(spark, rows)).collect()}


def test_structure(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="menu-open">
    <header>Site</header><nav><ul><li><a href=/a>A</a><li>B</ul></nav><div class="cookie-notice">We use cookies</div>
    <article><header><h1>Head &amp; line</h1></header><p>One <b>two<br>three</b>&nbsp; four<p>Five &lt;5&#33;
    <script>var t="</p>";</script><div class="ad">Buy</div><table><tr><td>c1<td>c2</table>
    <form><label>Name</label><input></form><!-- hidden --><section id="comments"><article>Nice!</article></section>
    <ul><li>i1<li>i2</ul><p hidden>no</p><footer>by me</footer></article><aside>Side</aside><footer>End</footer></body></html>"""
    got = text_of(spark, (1, "http://h/a", page), (2, "http://h/b", None), (3, None, ""), (4, "nonsense", "plain < text &copy"))
    assert got == {1: "Head & line\nOne two three four\nFive <5!\nc1\nc2\ni1\ni2", 2: "", 3: "", 4: "plain < text ©"}


def test_shared_lines_go_only_outside_an_article(spark):
    def page(k, article=""):
        return f"<body><div>Shop</div><div>Home of {k}</div>{article}<div>Story {k} begins.</div><div>All rights</div></body>"

    got = text_of(
        spark, (1, "http://h.org/n/1", page(1)), (2, "http://h.org/n/2", page(2)), (3, "http://other.org/n/1", page(3)),
        (4, "http://h.org/z", "<article><p>Shop</p><p>Own</p></article><div>Shop</div>"),
        (5, "http://same.org/1", page(5)), (6, "http://same.org/2", page(5)),
    )
    assert got[1] == "Home of 1\nStory 1 begins." and got[2] == "Home of 2\nStory 2 begins."
    assert got[3].startswith("Shop\n") and got[4] == "Shop\nOwn"
    assert got[5] == got[6] == "Shop\nHome of 5\nStory 5 begins.\nAll rights"


def test_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a = np.array([rng.randrange(5) for _ in range(rng.randrange(12))], np.int64)
        b = np.array([rng.randrange(5) for _ in range(rng.randrange(12))], np.int64)
        at = html_text.common(a, b)
        assert at == sorted(set(at)) and len(at) == (html_text._lengths(a, b)[-1] if len(a) and len(b) else 0)
        rest = iter(b.tolist())
        assert all(any(x == y for y in rest) for x in a[at].tolist())


def test_partitions_do_not_matter(spark):
    rows = [(k, f"http://h{k % 3}.org/p/{k}", f"<div>Site {k % 3}</div><div>Body {k}</div><div>Foot</div>") for k in range(60)]
    df = pages(spark, rows + rows[:2])
    a = sorted(map(tuple, html_text.extract(df.coalesce(1)).collect()))
    assert a == sorted(map(tuple, html_text.extract(df.repartition(17)).collect()))
    assert len(a) == 62 and all(r[2].startswith("Body") and "\n" not in r[2] for r in a)


def test_all_pages_against_a_plain_reading(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    for r in df.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[r.page_id].text == "\n".join(x for x in blocks if x)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_odd_markup_and_size(spark):
    deep = "<div>" * 3000 + "core" + "</div>" * 3000
    many = "".join(f"<p>line {k}</p>" for k in range(20_000))
    got = text_of(spark, (1, "http://a/1", deep), (2, "http://a/2", many), (3, "http://a/3", "<p>cut <b"), (4, "http://a/4", "<script>x"))
    assert got[1] == "core" and got[2].count("\n") == 19_999 and got[3] == "cut" and got[4] == ""
    assert html_text.extract(pages(spark, [(1, "u", "x")]).limit(0)).collect() == []


def test_only_named_attributes_drop():
    def text(page):
        return "\n".join(html_text.lines(page))

    for attributes in (
        'style="overflow:hidden"', 'title="the hidden role"', 'aria-hidden="false"', "data-id=ad", 'data-class="ad"', "href=/x?id=comment-3",
        'class="post has-sidebar"', 'class="entry ad-free"', 'class="no-comments"', 'alt=" id=ad "', "data-x='class=\"ad\"'",
    ):
        assert text(f"<div {attributes}><p>one</p><p>two</p></div>") == "one\ntwo", attributes
    for attributes in (
        "hidden", 'HIDDEN=""', "class=ad", 'title="x"class="big ad"', "id='comment-3'", 'class="cookie-notice"', 'class="site-footer"',
        'class="sidebar-left"', 'class="ad-300x250"', 'role="navigation"', 'id="comments"',
    ):
        assert text(f"<p>one</p><div {attributes}><p>two</p></div>") == "one", attributes
    assert text('<article class="post has-sidebar ad" id="notice"><p>one</p></article>') == "one"
    assert text("<article hidden><p>one</p></article>") == ""
    assert text('<article><p>so <a href="/blog/hidden-gems">gems</a> and <math><mi>x</mi></math> stay</p></article>') == "so gems and x stay"


def test_the_article_is_found_without_its_element(spark, sf):
    """The given pages with article and main renamed: differencing alone finds nearly all of the text."""
    df = spark.read.parquet(f"{sf}/pages.parquet")
    wanted = {r.page_id: r.text.split("\n") for r in html_text.extract(df).collect()}
    bare = df.withColumn("html", F.regexp_replace("html", r"<(/?)(?:article|main)\b", "<$1div"))
    got = {r.page_id: r.text.split("\n") for r in html_text.extract(bare).collect()}
    alike = sum(got[k] == wanted[k] for k in wanted)
    lost = sum((Counter(wanted[k]) - Counter(got[k])).total() for k in wanted)
    extra = sum((Counter(got[k]) - Counter(wanted[k])).total() for k in wanted)
    print(alike, len(wanted), lost, sum(map(len, wanted.values())), extra)
    assert alike >= 0.9 * len(wanted)


def test_a_repeated_sentence_stays_in_the_subtree_of_the_own_ones(spark):
    def page(k):
        body = "".join(f"<p>Sentence {i} of story {k} goes on.</p>" for i in range(6))
        return f"<body><div><div><a>Home</a></div><div><p>Same start.</p>{body}</div><div><p>All rights.</p></div></div></body>"

    got = text_of(spark, (1, "http://h/1", page(1)), (2, "http://h/2", page(2)))
    for k in (1, 2):
        assert got[k].split("\n") == ["Same start.", *(f"Sentence {i} of story {k} goes on." for i in range(6))]


def test_copies_of_an_article_and_several_articles(spark):
    same = "<article><p>One story that two pages tell.</p><p>It ends.</p></article>"
    got = text_of(
        spark, (1, "http://h/1", f"<body><div>x 1</div>{same}</body>"), (2, "http://h/2", f"<body><div>y 2</div>{same}</body>"),
        (3, "http://g/1", "<body><div>Site</div><article><p>First tale</p></article><article><p>Second</p></article></body>"),
        (4, "http://g/2", "<body><div>Site</div><p>Part</p></body>"), (5, "http://g/3", "<body><div>Site</div></body>"),
    )
    assert got[1] == got[2] == "One story that two pages tell.\nIt ends."
    assert got[3] == "First tale\nSecond" and got[4] == "Part" and got[5] == "Site"


def test_forms_around_the_page_and_inline_parts():
    def text(page):
        return "\n".join(html_text.lines(page))

    assert text('<body><form id="aspnetForm"><article><p>Hello world</p></article></form></body>') == "Hello world"
    assert text("<body><form><div><p>A long text</p><p>in a form</p></div></form><p>end</p></body>") == "A long text\nin a form\nend"
    assert text("<p>A text that is longer.</p><form><label>Name</label><input></form>") == "A text that is longer."
    assert text('<article><p>Body of it</p><form class="search"><p>Find</p></form></article>') == "Body of it"
    assert text("<p>See <button>copy</button> code</p>") == "See code"
    assert text('<p>So <span class="ad">buy <div>now</div> this</span> it goes</p><p>on</p>').endswith("on")
    assert text("<div>a <select><option>b</select> c<p>d <svg><text>e</text></svg></div>f") == "a c\nd\nf"


def test_pages_whose_keys_collide(spark, monkeypatch):
    rows = [(k, f"http://h{k % 3}.org/p/{k}", f"<div>Site {k % 3}</div><div>Body {k}</div><div>Foot</div>") for k in range(30)]
    wanted = text_of(spark, *rows)
    monkeypatch.setattr(html_text, "page_key", lambda *_: F.lit(7).cast("long"))
    assert text_of(spark, *rows, (90, None, "u"), (91, "u", None)) == wanted | {90: "u", 91: ""}
