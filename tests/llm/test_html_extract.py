import random
from functools import lru_cache

import pytest

from tabreg.llm import html_extract as H
from tabreg.llm import queries


def naive(a, b):
    """Simple tree matching of two child lists by its recursion: largest weight."""
    @lru_cache(maxsize=None)
    def best(i, j):
        if i == len(a) or j == len(b):
            return 0
        out = max(best(i + 1, j), best(i, j + 1))
        if a[i][0] == b[j][0]:
            out = max(out, 1 + naive(a[i][1], b[j][1]) + best(i + 1, j + 1))
        return out
    return best(0, 0)


def tree(rng, depth):
    return tuple((rng.choice("abc"), tree(rng, depth - 1)) for _ in range(rng.randint(0, 3 if depth else 0)))


def as_html(t):
    return "".join(f"<{x}x>{as_html(k)}</{x}x>" for x, k in t)


def test_tree_matching_is_maximal():
    rng = random.Random(4)
    for _ in range(300):
        a, b = (H.parse(as_html(tree(rng, 3))) for _ in range(2))
        w = H.Wrapper(H.json.dumps(H.skeleton(a)))
        got = sum(x for _, _, x in H._match(w.kids, H.folded(b), H.DEPTH))
        shape = lambda s: tuple((label, shape(k)) for label, k in s)
        assert got == naive(shape(H.skeleton(a)), shape(H.skeleton(b)))
        assert all(n.tag + "" for nodes in H.align(w, b).values() for n in nodes)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script><style>p{}</style></head><body class="home">
<header class="site">Site name</header><nav><ul><li><a href="/a">Menu</a><li>Two</ul></nav><div id="cookie-notice">We use cookies</div>
<!-- <p>hidden</p> --><main><article><header><h1>A &amp; B&nbsp; &#169;</h1></header><p>One
  two<br>three <b>four</b><p>Five &lt;b&gt; <i>six</i>.</p><ul><li>x<li>y</ul><div class="ad">Buy</div>
<blockquote>Q</blockquote><form><input value="v">Form text</form><table><tr><td>c1<td>c2</table><pre> a
 b </pre></article></main><section class="comments"><p>First!</p></section><aside>Side</aside><div class="share-buttons">Share</div>
<footer>&copy; footer</footer></body></html>"""


def test_main_text_of_a_full_page():
    assert H.main_text(H.parse(PAGE)) == "A & B ©\nOne two three four\nFive <b> six.\nx\ny\nQ\nc1\nc2\na b"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("a<", "a<"), ("a <3 b", "a <3 b"), ("<p>x</b></p></div>y", "x\ny"),
    ("<p title='a>b'>q</p>", "q"), ("<p title='broken>q</p>", "q"), ("<script>never closed <p>x", ""), ("<!-- never closed <p>x", ""),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"), ("<p>&unknown; &#x41;&#0;</p>", "&unknown; A�"), ("<P>Up</P><Article>in", "in"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<p>a  b</p>", "a b"), ("<![CDATA[x<y]]>", "x<y"), ("<main>m</main>n", "m"),
    ("<article>a</article><p>x</p><article>b</article>", "a\nb"), ("<div>" + "<p>w</p><h2>h</h2>" * 2000 + "</div>", "\n".join(["w", "h"] * 2000))])
def test_odd_html(page, text):
    assert H.main_text(H.parse(page)) == text


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, text int")


def test_wrapper_drops_constant_nodes(spark):
    """Unmarked template text goes, by alignment with the host's other pages; the same text elsewhere stays."""
    def page(i):
        extra = "<section>extra <span>one</span></section>" if i % 3 == 0 else ""
        return f"<body><div>Brand slogan</div>{extra}<h1>Title {i}</h1><p>Text {i}</p><p>Same line</p><h6>Read our terms</h6></body>"
    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(20)]
    rows += [(100, "http://b.example/", "<div>Brand slogan</div><p>z</p>"), (101, None, "<p>n</p>"), (102, "http://a.example/n", None),
             (103, "http://a.example/e", ""), (None, "http://c.example", "<p>k</p>"), (0, "http://a.example/0", page(0))]
    rows += [(200 + i, "http://copies.example/", "<div>All</div><p>alike</p>") for i in range(30)]
    got = H.extract(pages_of(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    for i in range(20):
        assert text[i] == ("extra one\n" if i % 3 == 0 else "") + f"Title {i}\nText {i}\nSame line"
    assert text[100] == "Brand slogan\nz" and text[101] == "n" and text[102] == text[103] == "" and text[None] == "k"
    assert text[200] == "All\nalike"            # one distinct page tells nothing about a template
    assert H.extract(pages_of(spark, [])).count() == 0


def test_shuffled_wrappers_give_the_same(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    a = sorted(map(tuple, H.extract(pages).collect()))
    monkeypatch.setattr(H, "BROADCAST_BYTES", 0)
    assert a == sorted(map(tuple, H.extract(pages).collect()))


def test_query_gives_the_source_text(spark):
    """The pages hold texts of documents: after the heading, the article is one of them."""
    sf = "/root/testdata/sf0.01"
    docs = {" ".join(r["text"].split()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r["text"]}
    got = queries.QUERIES["op3_html_extract"](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert all(" ".join(r["text"].split("\n")[1:]) in docs for r in got)


def test_only_the_template_text_is_dropped(spark):
    """A filled optional slot, a page whose node reads otherwise, and copies of one article keep their text."""
    def page(i):
        return f"<body><div>{'Brand' if i else 'Own words'}</div><table>{'<td>Box 7' if i == 7 else ''}</table><p>Text {i}</p></body>"
    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(20)]
    rows += [(50, "http://a.example/x", "<body><div>All of the article</div></body>")]
    rows += [(100 + i, "http://b.example/", f"<body><title>{i}</title><script>{i}</script><div class='ad'>Buy {i}</div><h1>Part {i}</h1>"
                                            f"<div>The article</div></body>") for i in range(30)]
    text = {r["page_id"]: r["text"] for r in H.extract(pages_of(spark, rows)).collect()}
    for i in range(1, 20):
        assert text[i] == ("Box 7\n" if i == 7 else "") + f"Text {i}"
    assert text[0] == "Own words\nText 0" and text[50] == "All of the article"
    assert all(text[100 + i] == f"Part {i}\nThe article" for i in range(30))


@pytest.mark.parametrize("page, text", [
    (f"<body><div {mark}><div><article><h1>T</h1><p>x</p></article></div></div><p>y</p></body>", "T\nx") for mark in (
        'class="has-sidebar"', 'class="content-sidebar-wrap"', 'class="ad-free"', 'class="no-comments"', 'class="widget"', 'id="search"',
        'class="sidebar"', 'class="header"', 'role="banner"')] + [
    ('<article><section id="search-methods"><h2 id="comments-on-the-law">C</h2><p class="notice">n</p></section><i class="ad">b</i></article>',
     "C\nn"), ('<form id="aspnet"><main>m</main></form>', "m"), ('<main>m<div class="ad-free">a</div><div class="lead AD">b</div></main>', "m\na"),
    ('<article>a</article><div class="related"><article>r</article></div>', "a"), ('<div class="widget">w</div>', "w"),
    ('<div class="sidebar">s</div>', ""), ('<div class="related"><article>a</article></div>', "a"), ('<p>p</p><div class="widget">w</div>', "p"),
    ('<p>p</p><section class="comments"><article>c</article></section>', "p")])
def test_layout_classes(page, text):
    assert H.main_text(H.parse(page)) == text


def test_wrapper_shows_article_slots(spark):
    """A marked element with a text of its own on each page stays; one with few texts goes."""
    rows = [(i, f"http://a.example/{i}", f'<body><p>Intro {i}</p><div class="widget">Text {i}</div><div class="promo">Deal {i % 2}</div></body>')
            for i in range(20)]
    text = {r["page_id"]: r["text"] for r in H.extract(pages_of(spark, rows)).collect()}
    assert all(text[i] == f"Intro {i}\nText {i}" for i in range(20))


def test_large_sibling_lists_are_matched_exactly(monkeypatch):
    """The tables made with arrays give the same matches as the small ones."""
    rng = random.Random(9)
    cases = [[H.parse(as_html(tree(rng, 3))) for _ in range(2)] for _ in range(150)]
    one = lambda a, b: H._match(H.Wrapper(H.dumps(H.skeleton(a))).kids, H.folded(b), H.DEPTH)
    small = [one(a, b) for a, b in cases]
    monkeypatch.setattr(H, "CELLS", 0)
    assert small == [one(a, b) for a, b in cases]


def test_template_in_long_and_deep_pages_is_found(spark):
    """A sibling that is missing early and occurs late, and elements of any depth, are aligned."""
    def page(i):
        early = "" if i % 20 == 1 else "<ul>Menu</ul>"
        text = "".join(f"<p>Text {i} {k}</p><h2>Head {i} {k}</h2>" for k in range(300))
        return f"<body>{early}<div>{'<section>' * 20}<b>Slogan</b>{'</section>' * 20}</div>{text}<h6>Terms</h6><ul>Own {i}</ul></body>"
    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(20)]
    rows += [(100 + i, "http://b.example/", "<div>" * 1500 + f"<h6>Terms</h6><p>Text {i}</p>" + "</div>" * 1500) for i in range(6)]
    text = {r["page_id"]: r["text"] for r in H.extract(pages_of(spark, rows)).collect()}
    for i in range(20):
        assert text[i] == "\n".join(x for k in range(300) for x in (f"Text {i} {k}", f"Head {i} {k}")) + f"\nOwn {i}"
    assert all(text[100 + i] == f"Text {i}" for i in range(6))


CHROME = ['id="comments"', 'class="comment-list"', 'class="comments-section"', 'class="site-nav"', 'class="main-menu"', 'class="footer-links"',
          'class="sidebar-left"', 'id="advert"', 'class="siteNav"', 'id="site_footer"', 'class="x related-posts-x related-post"',
          'class="site-header"', 'id="cookie-banner"', 'id="main-menu"']


@pytest.mark.parametrize("mark", CHROME)
def test_joined_tokens_and_ids_mark_parts_of_a_page(mark):
    assert H.main_text(H.parse(f"<body><h1>T</h1><p>x</p><div {mark}><p>Not the text</p></div><p>y</p></body>")) == "T\nx\ny"


@pytest.mark.parametrize("mark", ['class="page-header"', 'class="search-methods"', 'id="comments-on-the-law"', 'class="add"', 'class="article-footer-notes"',
                                  'class="no-sidebar"', 'class="shared-memory"', 'class="main"', 'class="post-body"', 'class="-"'])
def test_other_tokens_do_not(mark):
    assert H.main_text(H.parse(f"<body><p>x</p><div {mark}><h2>Text</h2></div><p>y</p></body>")) == "x\nText\ny"


def test_ids_inside_an_article_name_its_sections():
    page = ('<body><div id="comments">c</div><article><p>x</p><section id="comments"><p>How to write comments</p></section>'
            '<div class="cookie-banner">We use cookies</div><div class="notice-box">n</div></article></body>')
    assert H.main_text(H.parse(page)) == "x\nHow to write comments\nn"


@pytest.mark.parametrize("pages", [1, 50])
def test_reader_comments_and_menus_go_without_an_article(spark, pages):
    """Comments differ from page to page, so no template shows them; a small host has no template at all."""
    def page(i):
        said = "".join(f'<div class="comment-item">Reader {i} {k} says {i * k}</div>' for k in range(4))
        return (f'<body><div class="site-nav"><a>Home</a><a>News</a></div><h1>Title {i}</h1><p>Text {i}</p>'
                f'<div id="comments"><h3>{i} comments</h3>{said}</div><div class="cookie-notice">Cookies</div><div class="footer-links">Terms</div></body>')
    got = H.extract(pages_of(spark, [(i, f"http://a.example/{i}", page(i)) for i in range(pages)])).collect()
    assert sorted(r["text"] for r in got) == sorted(f"Title {i}\nText {i}" for i in range(pages))
