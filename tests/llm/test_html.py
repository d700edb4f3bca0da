import html as entities
import re

import pytest

from reddwatch.llm import html

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><ul><li>Menu</li></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>%s<footer>&copy; x</footer></body></html>"""


def text(page, template=()):
    return html.text_of(html.read(page), set(template))


@pytest.mark.parametrize("body,expected", [
    ("<article><h1>A &amp; B</h1><p>one  two<br>three</p></article>", "A & B\none two three"),
    ("<article><p><b>open<br><p>next</article>", "open\nnext"),
    ("<article><ul><li>a<li>b</ul><p>x<b>y</p>z</b></article>", "a\nb\nxy\nz"),
    ("<article><p>text</p><div class='comments'><p>me</p></div><form>f</form><aside>s</aside></article>", "text"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"),
    ("<main><p>m &lt;b&gt; &#233;&#x41; &nbsp;end</p></main>", "m <b> éA end"),
    ("<p>no article</p><div id='sidebar-left'>s</div><p hidden>h</p>", "no article"),
    ("<article>a<article>b</article></article><article>c</article>", "a\nb\nc"),
    ("<article><p>3 < 4 and a<b</article>", "3 < 4 and a"),
    ("<article></article>", ""),
])
def test_main_text(body, expected):
    assert text(PAGE % body) == expected


@pytest.mark.parametrize("page,expected", [
    ("", ""), ("plain  text", "plain text"), ("<", "<"), ("<p", ""), ("</p></div>x", "x"), ("<p>unclosed", "unclosed"),
    ("<script>never closed", ""), ("<!-- never closed", ""), ("<div><div><div>deep", "deep"),
])
def test_broken_pages(page, expected):
    assert text(page) == expected


def test_deep_nesting_is_borne():
    assert text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"


@pytest.mark.parametrize("size", [html.BROADCAST_BYTES, -1])
def test_what_recurs_on_a_host_goes_and_what_is_copied_stays(make, size):
    rows = []
    for i in range(20):
        body = f"<div><div><p>Site line</p><span>of host</span></div><p>Own text {i}</p></div>"
        rows.append((i, f"http://www.A.example/{i}", f"<html><body>{body}</body></html>", 1))
        rows.append((100 + i, f"https://b.example:80/{i}", "<body><p>Copied page</p><p>as it is</p></body>", 1))
        article = f"<article><p>A passage that many quote</p><p>Own {i}</p><div><b>Share this</b></div></article>"
        rows.append((200 + i, f"//c.example?x={i}", f"<body>{article}</body>", 1))
    rows += [(300, None, "<p>x</p>", 1), (301, "no url", None, 1), (302, "", "", 1), (None, "http://a.example", None, 1), rows[0]]
    pages = make(rows, "page_id long, url string, html string, text int").repartition(3)
    found = html.extracted(pages, broadcast_bytes=size).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    texts = {r.page_id: r.text for r in found}
    for i in range(20):
        assert texts[i] == f"Own text {i}"
        assert texts[100 + i] == "Copied page\nas it is"
        assert texts[200 + i] == f"A passage that many quote\nOwn {i}"
    assert [texts[i] for i in (300, 301, 302, None)] == ["x", "", "", ""]
    assert html.extracted(pages.limit(0)).count() == 0


def test_hosts_in_sql_are_those_in_python(make):
    urls = ["http://www.A.b/x", "https://u:p@h.example:8080?q", "//x", "mailto:a@b", "", None, "http://[::1]:80/", " http://a/", "HTTP://WWW.Q/"]
    pages = make([(i, u, "<div><p>same</p><p>thing</p></div>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    for size in (html.BROADCAST_BYTES, -1):
        found = html.extracted(pages, least=1, broadcast_bytes=size).collect()
        assert {r.page_id: r.text for r in found} == {i: "" for i in range(len(urls))}


def blocks_between_tags(markup):
    """Texts between tags of blocks, each on its line; a plain way that holds where articles have no asides."""
    parts = re.split(r"(?i)</?(?:p|h[1-6]|ul|ol|li|div|table|tr|td|th|section|blockquote|pre|article)\b[^>]*>", markup)
    texts = [entities.unescape(re.sub(r"<[^>]*>", "", re.sub(r"(?i)<br\b[^>]*>", " ", part))) for part in parts]
    return "\n".join(line for line in (" ".join(t.split()) for t in texts) if line)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_articles_of_the_table(spark, sf_dir):
    from reddwatch.llm.queries import op8_html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = op8_html(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == blocks_between_tags((pages[r.page_id] or "").partition("<article>")[2].partition("</article>")[0])


def menu(i, entries):
    return "<div class='top'><ul>%s</ul></div>" % "".join(f"<li><a href='/{i}/{j}'>entry {i} {j}</a></li>" for j in range(entries))


@pytest.mark.parametrize("hosts", [1, 3])
@pytest.mark.parametrize("size", [html.BROADCAST_BYTES, -1])
def test_menus_with_other_words_on_each_page_go_by_their_shape(make, hosts, size):
    rows = []
    for h in range(hosts):
        for i in range(6):
            body = menu(f"{h}-{i}", 3 + i % 3) + f"<div><p>Own text {h} {i}</p><ul><li>a point {i}</li></ul></div>"
            rows.append((100 * h + i, f"http://h{h}.example/{i}", f"<body>{body}</body>"))
    # Four pages are too few for a template, a page of nothing but links keeps them, an article keeps its lists.
    rows += [(1000 + i, "http://few.example", f"<body>{menu(i, 2)}<p>Own {i}</p></body>") for i in range(4)]
    rows += [(2000, "http://h0.example/list", f"<body>{menu('l', 2)}</body>")]
    rows += [(2001, "http://h0.example/art", f"<body><article><p>x</p>{menu('l', 2)}</article></body>")]
    pages = make(rows, "page_id long, url string, html string").repartition(3)
    texts = {r.page_id: r.text for r in html.extracted(pages, broadcast_bytes=size).collect()}
    for h in range(hosts):
        for i in range(6):
            assert texts[100 * h + i] == f"Own text {h} {i}\na point {i}"
    assert texts[1000] == "entry 0 0\nentry 0 1\nOwn 0"
    assert texts[2000] == "entry l 0\nentry l 1"
    assert texts[2001] == "x\nentry l 0\nentry l 1"
    alone = {r.page_id: r.text for r in html.extracted(pages, least=100, broadcast_bytes=size).collect()}
    assert alone[0].startswith("entry 0-0 0\n") and alone[0].endswith("Own text 0 0\na point 0")


@pytest.mark.parametrize("others", [0, 60])
def test_what_goes_does_not_turn_with_the_size_of_the_host(make, others):
    bar = "<div><b>Section</b> <span>of some pages</span></div>"
    rows = [(i, "http://a.example", f"<body>{bar}<p>Own text {i}</p></body>") for i in range(6)]
    rows += [(100 + i, "http://a.example", f"<body><p>Other text {i}</p></body>") for i in range(others)]
    texts = {r.page_id: r.text for r in html.extracted(make(rows, "page_id long, url string, html string")).collect()}
    assert all(texts[i] == f"Own text {i}" for i in range(6))
    assert all(texts[100 + i] == f"Other text {i}" for i in range(others))


@pytest.mark.parametrize("body,expected", [
    ("<p class='notice-period'>A month's notice is given.</p>", "A month's notice is given."),
    ("<p class='notice'>We use cookies.</p><p>text</p>", "text"),
    ("<div class='widget'><p>main story body</p></div>", "main story body"),
    ("<div class='widget'><article><p>story</p></article></div>", "story"),
    ("<div class='widget'><p>short</p></div><p>a longer main text</p>", "a longer main text"),
    ("<article><h1>T</h1><div class='widget'><p>the story itself</p></div></article>", "T\nthe story itself"),
    ("<article><p>text</p><div class='comments'><p>a comment longer than the text</p></div></article>", "text"),
    ("<p>text</p><div class='cookie-notice'><p>a notice longer than the text</p></div>", "text"),
    ("<div class='content has-sidebar'><p>text</p></div>", "text"),
    ("<p>foo\u200bbar \ufeffx\u00a0y</p>", "foo\u200bbar \ufeffx y"),
])
def test_names_alone_do_not_take_main_text(body, expected):
    assert text(PAGE % body) == expected


@pytest.mark.parametrize("body,expected", [
    ("<main><h1>Title</h1><p>main text</p><section><article class='teaser'><p>other</p></article></section></main>",
     "Title\nmain text\nother"),
    ("<main><p>main text</p><article class='comment odd'><p>me</p></article></main>", "main text"),
    ("<main><h1>Title</h1><article><p>text</p></article></main>", "Title\ntext"),
    ("<main><div class='share'><p>s</p></div>list<article class='post has-comments'><p>text</p></article></main>", "text"),
    ("<p>a long main text of the page</p><article class='related-card'><p>other</p></article>", "a long main text of the page"),
    ("<p>a long main text of the page</p><article><p>short</p></article>", "a long main text of the page\nshort"),
    ("<p>notice</p><article><p>a long main text of the page</p></article>", "a long main text of the page"),
    ("<main><p>lead</p></main><article><p>text</p></article>", "lead\ntext"),
    ("<article class='card'><p>only this</p></article>", "only this"),
])
def test_articles_that_are_not_the_main_part(body, expected):
    assert text(PAGE % body) == expected
