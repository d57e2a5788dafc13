from __future__ import annotations

import html
import re

from kohort.llm.html_text import extract_pages, extract_text, op5_html_extraction

P1 = "The first paragraph is long enough to count, with commas, and it goes on for a while so that it scores."
P2 = "The second paragraph, too, has a good many words in it, and a &amp; sign &lt;here&gt; as well."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_article_without_its_surroundings():
    text = extract_text(page(
        '<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, a lot, on this site, really.</div>'
        f'<article><h1>Title</h1><p>{P1}</p><p>Short.</p><script>var a="</p>";</script><p>{P2}</p>'
        '<form><p>Subscribe to our newsletter, please, it is free of charge.</p></form></article>'
        f'<aside><p>{P1}</p></aside><div id="comments"><p>A reader says, at length, that this is wrong, and wrong again.</p></div><footer>&copy; me</footer>'))
    assert text == f"Title\n{P1}\nShort.\n{html.unescape(P2)}"


def test_best_container_without_article():
    text = extract_text(page(
        '<div class="menu"><a href="a">one</a> <a href="b">two</a></div>'
        f'<div id="wrap"><div class="story"><h2>Head</h2><p>{P1}</p><p>{P1}</p><ul><li>first point</li><li>second point</li></ul></div>'
        '<div class="links"><p><a href="x">A linked text that is rather long, with commas, and more commas, but only a link</a></p></div></div>'))
    assert text == f"Head\n{P1}\n{P1}\nfirst point\nsecond point"


def test_wrappers_named_like_other_parts():
    whole = f"Title\n{P1}\n{html.unescape(P2)}"
    inner = f"<h1>Title</h1><p>{P1}</p><p>{P2}</p>"
    side = f'<div class="sidebar"><p>{P1}</p></div>'
    for name in ("layout has-sidebar", "post comments-open"):
        assert extract_text(page(f'<div class="{name}"><article>{inner}</article>{side}</div>')) == whole
        assert extract_text(page(f'<div id="{name}"><main>{inner}</main>{side}</div>')) == whole
        assert extract_text(page(f'<div class="{name}"><div>{inner}</div></div><div class="ad"><p>{P1}</p></div>')) == whole
    comments = '<div id="comments"><article class="comment-body">' + f"<p>{P1}</p>" * 9 + "</article></div>"
    assert extract_text(page(f"<article>{inner}</article>{comments}")) == whole
    assert extract_text(page(f'<div class="related-open"><main><div>{inner}</div></main></div><div id="comments">' + f"<p>{P1}</p>" * 9 + "</div>")) == whole


def test_pages_inside_a_form_or_dialog():
    whole = f"Title\n{P1}\n{html.unescape(P2)}"
    inner = f"<h1>Title</h1><p>{P1}</p><p>{P2}</p>"
    assert extract_text(page(f'<form method="post" action="./" id="aspnetForm"><div class="menu">a b</div><article>{inner}</article></form>')) == whole
    assert extract_text(page(f"<form><div>{inner}</div></form>")) == whole
    assert extract_text(page(f'<div role="dialog"><article>{inner}</article></div>')) == whole
    assert extract_text(page(f'<article>{inner}<form><p>Write to us, please, it is free.</p></form></article>')) == whole


def test_names_inside_the_article_are_no_verdict():
    long = f"{P1} {P1} {P1}"
    for part in ('<section id="related-work">', '<div class="overflow-hidden">', '<div class="social-impact">', '<section class="banner">', '<div class="widget">'):
        end = part[1:].split(" ")[0]
        assert extract_text(page(f"<article><p>{P2}</p>{part}<p>{long}</p></{end}></article>")) == f"{html.unescape(P2)}\n{long}", part
    assert extract_text(page(f'<article><h2 id="menu">The menu</h2><p>{P1}</p></article>')) == f"The menu\n{P1}"
    for part in ('<div class="share-buttons">Share this</div>', '<div class="related-posts"><a href="a">' + P1 + "</a><p>" + P1 + "</p></div>",
                 f'<div class="comments"><p>{long}</p></div>', f'<div class="cookie-notice"><p>{long}</p></div>', f'<div class="newsletter-box"><p>{long}</p></div>',
                 f'<div class="ad"><p>{long}</p></div>', f'<section class="notice-box"><p>{long}</p></section>'):
        assert extract_text(page(f"<article><p>{P2}</p>{part}</article>")) == html.unescape(P2), part


def test_names_are_left_aside_where_nothing_remains():
    assert extract_text(page(f'<article><div class="notice"><p>{P1}</p></div></article>')) == P1
    assert extract_text(page(f'<div class="sidebar"><p>{P1}</p></div><div class="ads"><p>{P1}</p></div>')) == f"{P1}\n{P1}"
    assert extract_text(page(f"<nav><p>{P1}</p></nav>")) == ""


def test_sections_in_separate_wrappers():
    first, second = f"<p>{P1}</p>" * 4, f"<p>{P2}</p>" * 3
    want = [P1] * 4 + [html.unescape(P2)] * 3
    assert extract_text(page(f"<div class='row'><section>{first}</section></div><div class='row'><section>{second}</section></div>")).split("\n") == want
    links = '<div><a href="a">One long link, to another place, of the site</a> <a href="b">Two long links, to other places, of the site</a></div>'
    assert extract_text(page(f"<div><div>{first}</div></div><div>{links * 9}<section>{second}</section></div>")).split("\n") == want


def test_parts_beside_the_best_container_stay():
    long = f"<p>{P1}</p>" * 9
    lines = [P1] * 9
    text = extract_text(page(f"<main><h1>Title</h1><section>{long}</section><section><p>{P2}</p></section><p>Short.</p><h2>End</h2></main>"))
    assert text.split("\n") == ["Title", *lines, html.unescape(P2), "Short.", "End"]
    text = extract_text(page(f"<h1>Title</h1><div>{long}</div><p>Short.</p><h2>More</h2><div><p>A few words.</p></div>"))
    assert text.split("\n") == ["Title", *lines, "Short.", "More", "A few words."]
    links = '<ul><li><a href="a">A first reference</a></li><li><a href="b">A second one</a></li></ul>'
    assert extract_text(page(f"{links}<article>{long}{links}</article>{links}")).split("\n") == [*lines, "A first reference", "A second one"]


def test_white_space_and_references():
    assert extract_text(page(f"<article><p>  a\n\t b&nbsp;c <b>d</b>e<br>f &#233;&eacute;&#x1F600; &bogus; {P1}</p></article>")) == \
        f"a b c de f éé😀 &bogus; {P1}"


def test_broken_markup():
    assert extract_text(f"<p>{P1}<p>{P1}") == f"{P1}\n{P1}"
    assert extract_text(f"<article><p>{P1}</p><p>cut off <b") == f"{P1}\ncut off"
    assert extract_text(f"<article><p>{P1}</p><script>no end <p>{P2}") == P1
    assert extract_text(f"<ARTICLE><P CLASS='x>y'>{P1}</P></ARTICLE>") == P1
    assert extract_text(f"<article><p>1 < 2 and <3 {P1}</p></article>") == f"1 < 2 and <3 {P1}"
    assert extract_text("</p></div></article>") == ""
    assert extract_text("<!-- only a comment") == ""
    assert extract_text("just text, no markup") == "just text, no markup"


def test_short_page_falls_back():
    assert extract_text(page("<nav>menu</nav><article><p>Short.</p></article>")) == "Short."
    assert extract_text(page("<p>Tiny.</p>")) == "Tiny."


def test_table_rows_and_lists():
    text = extract_text(f"<main><p>{P1}</p><table><tr><td>a<td>b<tr><td>c</table><dl><dt>t<dd>d</dl></main>")
    assert text == f"{P1}\na\nb\nc\nt\nd"


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + f"<p>{P1}</p>"
    assert extract_text(deep) == P1
    long = extract_text("<article>" + f"<p>{P1}</p>" * 5000 + "</article>")
    assert long.count("\n") == 4999


def test_rows(spark):
    rows = [(1, "u", None, 0), (2, None, "", 1), (3, "u", f"<article><p>{P1}</p></article>", 2), (3, "u", f"<article><p>{P1}</p></article>", 3),
            (None, None, "   ", 4)]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    assert sorted(((r.page_id, r.url, r.text, r.n_chars) for r in got), key=str) == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (3, "u", P1, len(P1)), (3, "u", P1, len(P1)), (None, None, "", 0)], key=str)
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_against_the_article_element(spark):
    """On the given pages the main text is the article element; a plain reading of it must agree."""
    d = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    for r in op5_html_extraction(spark, d).collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", pages[r.page_id], re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert r.text == "\n".join(x for x in lines if x)
