import re
import time
from html import unescape

from docloom.llm import html_extract as hx
from docloom.llm.queries import op5_html_extraction


def brute(html):
    """The test pages have one article each; its blocks end at h1, p and br."""
    inner = html.partition("<article>")[2].partition("</article>")[0]
    blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:h1|p|br)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_query_equals_brute_force(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op5_html_extraction(spark, sf).collect()
    assert len(rows) == len(pages) and all(r.text == brute(pages[r.page_id]) and r.n_chars == len(r.text) for r in rows)


ARTICLE = "<p>" + "Plain words make up this paragraph, and they go on for a while. " * 3 + "</p>"


def page(body, head="<head><title>No</title><style>p{}</style></head>"):
    return f"<!DOCTYPE html><html>{head}<body>{body}</body></html>"


def test_boilerplate_goes_and_short_blocks_stay():
    html = page(
        "<header><a href=/>Home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
        f"<article><h1>Title</h1>{ARTICLE}<p>Be.</p><script>var a='<p>';</script><form>Name <input></form><div class=ad>Buy</div>{ARTICLE}"
        "<p>a &amp; b &lt;c&gt; &#233;&nbsp;x\n\ty</p><section id=comments><p>First!</p></section></article><aside>See also</aside><footer>&copy; us</footer>"
    )
    lines = hx.main_text(html).split("\n")
    assert lines[0] == "Title" and "Be." in lines and lines[-1] == "a & b <c> é x y" and len(lines) == 5


def test_without_an_article_element():
    html = page(f"<div class=top><a>1</a><a>2</a><a>3</a></div><div id=x>{ARTICLE * 4}<p>End.</p></div><div><a>l</a> <a>m</a></div>")
    lines = hx.main_text(html).split("\n")
    assert len(lines) == 5 and lines[-1] == "End."


LONG = ARTICLE[3:-4].strip()


def test_regions_are_not_lists_tables_or_quotes():
    for tag, item in (("blockquote", "p"), ("ul", "li"), ("ol", "li"), ("figure", "p"), ("table", "tr")):
        inner = f"<{tag}>" + f"<{item}>{'<td>' * (tag == 'table')}{LONG}</{item}>" * 9 + f"</{tag}>"
        lines = hx.main_text(page(f"<nav><a>1</a></nav><div><p>Opening. {LONG}</p>{inner}<p>Closing. {LONG}</p></div>")).split("\n")
        assert len(lines) == 11 and lines[0].startswith("Opening.") and lines[-1].startswith("Closing."), tag


def test_a_heading_beside_the_body_stays():
    lines = hx.main_text(page(f"<div><a>1</a> <a>2</a></div><div><h1>The title</h1><div>{ARTICLE * 4}</div></div>")).split("\n")
    assert lines == ["The title", *[LONG] * 4]


def test_article_cards_beside_the_text_do_not_win():
    cards = "".join(f"<article><a href=/{i}>Card {i}</a></article>" for i in range(3))
    text = hx.main_text(page(f"<div id=x>{ARTICLE * 5}</div><div>{cards}</div>"))
    assert text.split("\n")[:5] == [LONG] * 5


def test_marks_count_on_every_element():
    beside = (
        "<p class='advert'>Buy now</p>", "<p class=cookie-notice>We use cookies", "<h3 class=comments>Comments</h3>", "<span class='ad ad-slot-2'>Ad</span>", "<li class=sponsored>S</li>",
        "<div class=siteHeader>Site</div>", "<p id=newsletter_signup>Join</p>", "<div role=alert>!</div>", "<p hidden>x</p>", "<p style='display: none'>x</p>", "<dl class=related-posts><dt>R<dd>S</dl>",
        "<p><a href=1>One</a> | <a href=2>Two</a> | <a href=3>Three</a></p>", "<div class=post-comments><p>First!</p></div>", "<button>Go</button>", "<form>Name <input></form>",
    )
    for x in beside:
        assert hx.main_text(page(f"<article><h1>T</h1>{ARTICLE * 2}{x}{ARTICLE}<p>End.</p></article>")).split("\n") == ["T", LONG, LONG, LONG, "End."], x


def test_words_that_only_resemble_marks_stay():
    kept = (
        "<section id=related-work><p>Kept</p></section>", "<section id='modal-logic'><p>Kept</p></section>", "<p class=social-history>Kept</p>", "<h2 id=comments>Kept</h2>", "<div class=entry-header><p>Kept</p></div>",
        "<header><p>Kept</p></header>", "<p>Kept</p>", "<div class=menu-theory><p>Kept</p></div>", "<pre><code><span class=comment>Kept</span></code></pre>", "<p><a href=1>Kept</a></p>", "<p class=shared>Kept</p>",
    )
    for x in kept:
        assert hx.main_text(page(f"<article><h1>T</h1>{ARTICLE * 2}{x}<p>End.</p></article>")).split("\n") == ["T", LONG, LONG, "Kept", "End."], x


def test_dense_text_wins_over_an_element_named_article():
    assert hx.main_text(page(f"<article><p>x</p></article><div>{ARTICLE * 40}</div>")).split("\n")[-40:] == [LONG] * 40


def plain(html):
    """The page without what its tags and classes say: one kind of container, no head."""
    html = re.sub("(?s)<head>.*?</head>", "", html)
    return re.sub("<(/?)(?:nav|article|footer|div class=\"ad\"|ul)>", r"<\1div>", html)


def test_ratios_find_the_article_without_names(spark, sf):
    """Nothing of an article is lost, and where every other line is short nothing else is taken."""
    exact = 0
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    for html in pages:
        want, bare = brute(html), plain(html)
        got = hx.main_text(bare)
        assert want in got
        exact += got == want
        short = re.sub("(?s)(</div>)<div>&copy;.*?</div>(?=</body>|$)", r"\1<div>&copy; 2024</div>", re.sub("(?s)<!-- ad .*?</div>", "<div>Ad</div>", bare))
        if max(map(len, want.split("\n"))) > 200:
            assert hx.main_text(short) == want
    assert exact > len(pages) / 2
    assert all(hx.main_text(h.replace("<article>", "<div>").replace("</article>", "</div>")) == brute(h) for h in pages)


def test_missing_end_tags_are_supplied():
    assert hx.main_text(f"<head><title>No</title><body><article>{ARTICLE}<p>End.").split("\n") == [LONG, "End."]
    assert hx.main_text(f"<article>{ARTICLE}<ul><li class=ad>Buy<li>Kept</ul><table><tr><td class=ad>Buy<td>Kept<tr><td>Too</table><p class=ad>Buy<p>End.</article>").split("\n") == [LONG, "Kept", "Kept", "Too", "End."]


def test_time_grows_with_the_page():
    for html in ("<article><table>" + "<tr><td>a<td>b" * 40_000 + "</table></article>", "<ul>" + "<li>a" * 80_000, "<div>" * 80_000 + "deep", "<b>" * 80_000 + "x", "<p class=ad>" * 40_000 + "<p>x", "x<i class='ad'><p>x</div>" * 80_000, "x<b class=ad><div>" + "<i class=ad>" * 80_000 + "</b>" * 80_000, "x" + "<i class='ad'><p class=ad>y" * 80_000):
        began = time.time()
        assert hx.main_text(html)
        assert time.time() - began < 10


def test_broken_pages():
    assert hx.main_text(None) == hx.main_text("") == hx.main_text("<p></p>") == ""
    assert hx.main_text("just text") == "just text"
    assert hx.main_text("<article><p>open <b>bold<br>next &am") == "open bold\nnext &am"
    assert hx.main_text("<div><nav>menu</div>after<p>text") == "after\ntext"
    assert hx.main_text("</div></p><article>x</article>") == "x"
    assert hx.main_text("<article>" + "<div>" * 3000 + "deep") == "deep"


def test_extra_columns_and_nulls(spark):
    rows = [(1, "u", "<article><p>x</p></article>", "old", 5), (2, None, None, None, None), (1, "u", "<article><p>x</p></article>", "old", 5)]
    out = hx.extract_text(spark.createDataFrame(rows, "page_id int, url string, html string, text string, n_chars int")).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in out if r.page_id == 1) == [(1, "x", 5)] * 2 and [r.text for r in out if r.page_id == 2] == [""]
    assert hx.extract_text(spark.createDataFrame([], "page_id int, html string")).collect() == []


def test_smoothing_keeps_constants():
    import numpy as np

    assert np.allclose(hx.smoothed(np.full(9, 4.0), 2, 1.0), 4.0) and len(hx.smoothed(np.ones(1), 2, 1.0)) == 1
