import random

import pytest

from lookout.llm import html

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body class="home"><header><h1>Site</h1></header><nav><ul><li>Menu<li>More</ul></nav>
<div class="cookie-notice">We use cookies</div><!-- gone --><article><header><h2>Title</h2><span>by me</span></header><p>One <i>tw</i>o<br>three<p>Four&nbsp;&lt;5 &amp;amp; caf&eacute;<div class='ad-box'>buy</div>
<form><p>mail</p></form><ul><li>a<li>b</ul><section id="comments"><p>nice</p></section></article><aside>side</aside><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, "Title One two three Four <5 &amp; café a b"), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a b"), ("<b>a</b>b", "ab"), ("<td>a</td><td>b</td>", "a b"), ("<!-- a", ""), ("<script>x", ""), ("</p>a</div>", "a"),
        ("<main><p>m</p></main><p>x</p>", "m"), ("<article><nav>n</nav></article><p>x</p>", "x"), ('<p title="a > b">c</p>', "c"), ("<p>1 < 2</p>", "1 < 2"), ("<article>" + "<p>w</p>" * 5000 + "</article>", " ".join(["w"] * 5000)), ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_extract(page, text):
    assert html.extract(page, lambda h: False) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<body class="page has-sidebar"><nav>n</nav><main><p>story</p></main></body>', "story"), ('<body class="no-sidebar"><p>story</p></body>', "story"), ('<html class="sidebar"><body class="menu single comments-open"><article><p>story</p></article>', "story"),
        ('<article class="post comments-open"><p>story</p></article>', "story"), ('<main class="share"><p>story</p></main>', "story"), ('<div class="page sidebar"><article><p>story</p></article></div><div class="sidebar">side</div>', "story"),
        ('<body><form id="aspnetForm"><nav>n</nav><div><article><p>story</p></article></div></form></body>', "story"), ('<form><div class="notice"><p>story</p></div><p>more</p></form>', "more"), ("<form><h1>Title</h1><p>story</p></form><p>foot</p>", "Title story foot"),
        ('<header class="banner"><main><p>story</p></main></header>', "story"), ("<article>story<section id='comments'><article>nice</article></section></article>", "story"), ("<main><article><p>story</p></article><div class='comment-list'><article>nice</article></div></main>", "story"),
        ("<article><p>story</p><form>mail</form><div class='share'>s</div></article>", "story"), ("<aside><article>t</article></aside><p>story</p>", "story"), ('<div class="page-wrap has-nav"><p>story</p></div>', "story"), ("<div class='ad'>buy</div><p>story</p>", "story"),
    ],
)
def test_names_take_no_article(page, text):
    assert html.extract(page, lambda h: False) == text


STORY = "the long story of the river and the stone that walked"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<div><h1>T</h1><p>{STORY}</p></div><article class="related-item">teaser</article>', f"T {STORY}"), (f"<div><p>{STORY}</p></div><article>Next</article>", f"{STORY} Next"),
        (f'<main><p>{STORY}</p><article class="comment">nice</article></main>', STORY), (f'<main><p>{STORY}</p></main><ol class="comment-list"><li><article id="comment-17">{STORY * 3}</article></ol>', STORY),
        (f'<article><p>{STORY}</p></article><ol class="comment-list"><article class="comment-body">{STORY * 3}</article></ol>', STORY), (f'<div><p>{STORY}</p></div><div class="comments"><article>{STORY * 2}</article></div>', STORY),
        ('<article class="comment"><p>all there is</p></article>', "all there is"), (f'<p>{STORY}</p><div class="adbox">buy</div><div class="google-ads">buy</div><div id="adslot-3">x</div>', f"{STORY} x"),
        ("<article><header><h1>T</h1><p>Intro para.</p><span>by me</span></header><p>More.</p></article>", "T Intro para. More."), ('<article><p class="menu-items">Soup.</p><p class="alert">Ice.</p><label>Note.</label></article>', "Soup. Ice. Note."),
        (f'<article class="post comments-open"><p>{STORY}</p></article>', STORY), ("<form><label>Name</label></form><article><p>story</p></article>", "story"), ('<article><p>story</p><div class="alert">cookies</div></article>', "story"),
    ],
)
def test_stories_stay_and_comments_go(page, text):
    assert html.extract(page, lambda h: False) == text


def site(n, host="a.example", seed=1):
    """Pages without an article part: only recurrence tells their template."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        body = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(30))
        out.append((i, f"https://{host}/{i}", f"<body><div><b>All rights</b> reserved</div><div><p>{body}</p></div><div>Contact <i>us</i></div></body>", body))
    return out


@pytest.mark.parametrize("most_sent", [html.MOST_SENT, -1])
def test_templates(spark, most_sent):
    pages = site(20) + site(3, "b.example", 2)
    same = [(100 + i, f"https://c.example/{i}", "<article><p>the same story</p></article>", "the same story") for i in range(30)]
    odd = [(200, None, None, ""), (201, "http://[", "", ""), (202, "https://a.example/x", "<p>short</p>", "short"), (None, "u", "<p>x</p>", "x")]
    df = spark.createDataFrame([p[:3] for p in pages + same + odd + pages[:1]], "page_id long, url string, html string")
    got = html.main_text(df.withColumnRenamed("page_id", "page_id").selectExpr("*", "1 AS text", "2 AS key", "3 AS row"), most_sent=most_sent).collect()
    assert len(got) == len(pages) + len(same) + len(odd) + 1
    want = {p[1]: p[3] for p in pages + same + odd}
    for r in got:
        assert r.n_chars == len(r.text)
        if r.url and "b.example" in r.url:
            assert r.text == f"All rights reserved {want[r.url]} Contact us"  # too few pages for a template
        else:
            assert r.text == want[r.url]
    assert html.main_text(df.limit(0)).count() == 0


def test_all_subtrees_are_counted(spark):
    page = "<body><nav><ul><li>Menu</li></ul></nav><div class='ad'>buy</div><article><p>story</p></article><footer>me</footer></body>"
    assert len(html.subtrees(page)[1]) == 6  # nav, ul, li, ad, p, footer
    share = "<div class='post-share'>tell others</div>"
    pages = [(p[0], p[1], f"<nav><a href='/x'>us</a></nav><div><p>{p[3]}{' <a href=/x>us</a>' if p[0] < 2 else ''}</p></div>".replace("=/x", "='/x'"), p[3] + " us" * (p[0] < 2)) for p in site(20)]  # a menu's link takes none in a text
    pages += [(p[0], p[1], f"<{'footer' if p[0] else 'div'}><p>all rights</p></{'footer' if p[0] else 'div'}><div><p>{p[3]}</p></div>", p[3]) for p in site(20, "c.example", 3)]  # one page has the footer's text elsewhere
    pages += [(p[0], p[1], f"<article><p>{p[3]}</p>{share if p[0] < 10 else ''}</article>", p[3]) for p in site(40, "b.example", 2)]  # a doubtful name on a quarter of the pages
    got = html.main_text(spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")).collect()
    assert {r.url: r.text for r in got} == {p[1]: p[3] for p in pages}


def test_ids_and_tokens_hide_no_template(spark):
    """A notice with another id, token and link on each page is found by its tags and texts; with the template step off it stays."""
    pages = [(p[0], p[1], f"<body><div><p>{p[3]}</p></div><div id='n{p[0]}' data-token='{p[0] * 7919}'><b>Read</b> <a href='/{p[0]}'>our  terms</a></div></body>", p[3]) for p in site(20)]
    got = html.main_text(spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")).collect()
    assert {r.url: r.text for r in got} == {p[1]: p[3] for p in pages}
    off = html.main_text(spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string"), min_pages=10**9).collect()
    assert {r.url: r.text for r in off} == {p[1]: f"{p[3]} Read our terms" for p in pages}


def test_subtree_hashes():
    keys = lambda page: html.subtrees(page)[1]
    assert keys("<div><p>a</p> <i>b</i></div>") == keys("<div class='x'>\n<p id=1>a</p><i title='>'>b</i></div>")
    assert keys("<div><p>a</p><i>b</i></div>")[0] not in keys("<div><i>b</i><p>a</p></div>") or len(set(keys("<div><p>a</p><i>b</i></div>")) & set(keys("<div><i>b</i><p>a</p></div>"))) == 2
    one, other = html.parse("<div><p>a</p><p>b</p></div>")[0][0].hash, html.parse("<div><p>b</p><p>a</p></div>")[0][0].hash
    assert len({one, other, html.parse("<div><p>ab</p></div>")[0][0].hash, html.parse("<div><p><p>a</p>b</div>")[0][0].hash, html.parse("<ul><p>a</p><p>b</p></ul>")[0][0].hash}) == 5


@pytest.mark.parametrize("page", ["<i>" * 4000 + "</b>" * 4000 + "deep", "<div><header>" * 2000 + "<p>w</p>" * 4000, "<li>" * 20_000, "<a x=" * 20_000])
def test_time_grows_with_length(page):
    import time

    began = time.perf_counter()
    html.extract(page, lambda h: False)
    assert time.perf_counter() - began < 5
