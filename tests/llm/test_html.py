"""Main texts: on pages of known structure, and against the article element of the test pages."""

import html
import re

from palaver.llm.op6_html import blocks, main_path, main_texts, text_at

PAGE = '<body><nav>menu<a href="/">x</a></nav><div class="wrap"><div class="post-{i}"><h1>T &lt;b&gt;</h1><p>a  b<br>c <i>d</i><p>{text}{more}</div></div><footer>f</footer>'


def test_boilerplate_goes_and_blocks_stay_in_order():
    page = PAGE.format(i=1, text="long text " * 9, more='<div class="comments"><p>no</p></div><ul><li>x<li>y</ul><aside>s</aside><script>var p="</p>"</script>')
    assert text_at(blocks(page), None) == "T <b>\na b c d\n" + ("long text " * 9).strip() + "\nx\ny"
    assert text_at(blocks("<p>a<!-- <p>b --><style>p{}</style>c &amp d"), None) == "ac & d"
    assert blocks("") == [] and main_path([]) is None and text_at([], ">body") == ""
    assert blocks("<" * 50_000)[0][1] == "<" * 50_000


def test_the_hosts_path_wins(spark):
    link = '<div class="teaser">' + "other words of the site " * 20 + "</div>"
    pages = [(i, f"https://h.example.com/{i}", PAGE.format(i=i, text="some text of the page " * 9, more="")) for i in range(5)]
    pages += [(10, "http://u@H.example.com:80/x", PAGE.format(i=10, text="short", more="").replace("<footer>", link + "<footer>"))]
    pages += [(11, None, "<p>no host"), (12, "x", None), (13, "https://h.example.com/e", ""), (13, "https://h.example.com/e", "")]
    table = spark.createDataFrame([(*p, "p", 1) for p in pages], "page_id bigint, url string, html string, path string, host int")
    found = {r.page_id: r.text for r in main_texts(table.repartition(3)).collect()}
    assert found[10] == "T <b>\na b c d\nshort"
    assert found[0] == "T <b>\na b c d\n" + ("some text of the page " * 9).strip()
    assert (found[11], found[12], found[13]) == ("no host", "", "")
    assert main_texts(table).count() == len(pages) and main_texts(table.limit(0)).collect() == []


def test_texts_of_the_test_pages_are_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in main_texts(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert found[row.page_id] == "\n".join(x for x in parts if x)


LONG = "a sentence of the article with some words in it. " * 8


def test_names_do_not_veto_the_article():
    for name in ("content no-sidebar", "post-content has-sidebar", "layout with-menu", "social-science", "html-forms", "content sidebar", "widget"):
        for wrap in (f'<div class="{name}"><h1>T</h1><p>{LONG}</div>', f'<article class="{name}"><h1>T</h1><p>{LONG}</article>', f'<div class="{name}"><main><h1>T</h1><p>{LONG}</main></div>'):
            page = f'<body><nav><a href="/">x</a></nav><div class="ad">buy</div>{wrap}<div class="site-footer">f</div>'
            assert text_at(blocks(page), None) == "T\n" + LONG.strip(), (name, wrap)
    page = f'<body><form action="/"><div class="search-form">find</div><article><h1>T</h1><p>{LONG}</article></form>'
    assert text_at(blocks(page), None) == "T\n" + LONG.strip()
    for name in ("discussion", "side-effects", "search-algorithms", "search"):
        page = f'<body><article><div class="entry-header header"><h1>T</h1></div><p>{LONG}<section id="{name}"><h2 id="{name}">S</h2><p>more</section></article>'
        assert text_at(blocks(page), None) == "T\n" + LONG.strip() + "\nS\nmore", name


def test_parts_that_a_template_repeats_stay_together():
    parts = [f"{n} {LONG}".strip() for n in ("one", "two", "three")]
    page = "<body><h1>T</h1>" + "".join(f'<div class="widget"><p>{x}</div>' for x in parts)
    assert [b[1] for b in blocks(page)] == ["T", *parts]


def test_named_boilerplate_still_goes():
    names = ("ad", "sidebar", "main-nav", "social-share", "related", "site-header", "login-form", "widget-area", "comments", "breadcrumbs")
    boxes = "".join(f'<div class="{n}"><p>box</div>' for n in names) + '<div id="sidebar">box</div><div role="navigation">box</div><form>box</form>'
    assert text_at(blocks(f"<body>{boxes}<h1>T</h1><p>{LONG}"), None) == "T\n" + LONG.strip()
    comments = f'<div class="comments"><article class="comment">{LONG * 3}</article></div>'
    assert text_at(blocks(f"<body><article><h1>T</h1><p>{LONG}{comments}</article>"), None) == "T\n" + LONG.strip()
    assert text_at(blocks(f'<body><div class="ad">{LONG}</div><article><h1>T</h1><p>short</article>'), None) == "T\nshort"


SECTIONS = '<body><nav><a href="/">x</a></nav><div class="wrap"><h1><a href="/p">Title {i}</a></h1><p class="lead">A lead {i}.</p><div class="text"><p>{text}</p></div>{more}</div><div class="links"><a href="/a">one</a> <a href="/b">two</a></div>'


def test_nothing_beside_the_largest_container_is_cut(spark):
    long, short = LONG.strip() * 9, "<section><h2>Second</h2><p>short section</section>"
    pages = [(i, f"https://h.example.com/{i}", SECTIONS.format(i=i, text=long, more="")) for i in range(4)]
    pages += [(5, "https://s.example.com/5", f"<body><table><tr><td><h1>T</h1><td><p>{long}</table>{short}")]
    pages += [(6, "https://h.example.com/6", SECTIONS.format(i=6, text=long, more=short))]
    found = {r.page_id: r.text for r in main_texts(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert found[0] == f"Title 0\nA lead 0.\n{long}"
    assert found[5] == f"T\n{long}\nSecond\nshort section"
    assert found[6] == f"Title 6\nA lead 6.\n{long}\nSecond\nshort section"


def test_a_small_block_at_the_hosts_path_does_not_hide_the_article(spark):
    one = '<body><div class="post"><p>{a}</div>'
    pages = [(i, f"https://h.example.com/{i}", one.format(a=f"{i} {LONG}")) for i in range(3)]
    pages += [(3, "https://h.example.com/3", one.format(a="about the author") + f'<div class="story"><h1>T</h1><p>{LONG}</div>')]
    pages += [(4, "https://h.example.com/4", one.format(a="about the author") + f'<div class="story"><p>{LONG}</div>')]
    found = {r.page_id: r.text for r in main_texts(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert found[0] == f"0 {LONG}".strip()
    assert found[3] == f"about the author\nT\n{LONG}".strip()
    assert found[4] == f"about the author\n{LONG}".strip()


def test_a_title_beside_the_hosts_path_is_kept(spark):
    pages = [(i, f"https://h.example.com/{i}", f'<body><div class="text"><p>{i} {LONG}</div>') for i in range(3)]
    pages += [(3, "https://h.example.com/3", f'<body><h1>T</h1><p>lead<div class="text"><p>3 {LONG}</div>')]
    found = {r.page_id: r.text for r in main_texts(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert found[3] == f"T\nlead\n3 {LONG}".strip()
