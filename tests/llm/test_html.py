import html as entities
import re

from tallyloom.llm import html, queries

HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>"
MENU = '<header><a href="/">Home</a></header><nav><ul><li>One</li><li>Two</li></ul></nav>'
TAIL = "<footer>&copy; site</footer></body></html>"


def article(i, n=3):
    return f"<h1>Title {i}</h1>" + "".join(f"<p>Text {i} part {k} of the article &amp; more.</p>" for k in range(n))


def text(i, n=3):
    return "\n\n".join([f"Title {i}", *[f"Text {i} part {k} of the article & more." for k in range(n)]])


PAGES = [
    # a host whose pages have an article with asides in and around it
    *[(i, f"http://a.example/{i}", HEAD + MENU + '<div class="cookie-notice">We use cookies</div><article>' + article(i, i + 1) + '<div class="ad">Buy</div><form><p>Mail</p></form></article>'
       + '<aside>Side</aside><section id="comments"><article class="comment"><p>Nice</p></article></section>' + TAIL, text(i, i + 1)) for i in range(4)],
    # a host that marks nothing: the element with the most varying text
    *[(10 + i, f"https://b.example:80/{i}", HEAD + "<div><div>Site name</div><div>Menu</div></div><div>" + article(i) + "<div>Written by our staff.</div></div><div>Imprint</div>" + TAIL, text(i)) for i in range(5)],
    # alone on its host
    (20, "http://c.example/", HEAD + MENU + "<main>" + article(20) + "</main>" + TAIL, text(20)),
    (21, None, "<p>No host", "No host"),
    (22, "http://d.example/", None, ""), (23, "http://d.example/", "", ""), (24, "http://d.example/", HEAD + MENU + TAIL, ""),
    (25, "http://e.example/", "<article><p>a<br>b&nbsp;c <b>d</b>e<p>f\n g</article>", "a b c de\n\nf g"),
    (26, "http://f.example/", "<article><script>var t='</p>';</script><!-- <p>no</p> --><p title='>'>x &lt;b&gt; &#233;</p><ul><li>1<li>2</ul></article>", "x <b> é\n\n1\n\n2"),
    (27, "http://g.example/", "<article>" + "<p>long text</p>" * 20_000 + "</article>", "\n\n".join(["long text"] * 20_000)),
]


def test_articles_without_what_surrounds_them(spark):
    pages = spark.createDataFrame([(i, u, h, "clash") for i, u, h, _ in PAGES] + [(0, *PAGES[0][1:3], "again")], "page_id bigint, url string, html string, text string").repartition(4)
    got = html.extract(pages).collect()
    assert len(got) == len(PAGES) + 1
    want = {i: t for i, _, _, t in PAGES}
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(want[r["page_id"]]) for r in got)


def test_wrappers_have_slots_optional_and_repeated_parts():
    node = html.collapse(html.parse(PAGES[0][2])[0])
    for page in PAGES[1:4]:
        node = html.merge(node, html.collapse(html.parse(page[2])[0]))
    shape = node.shape()
    assert "li*(T)" in shape and "p*" in shape
    title = next(n for n in node.leaves() if n.chars == sum(len(f"Title {i}") for i in range(4)))
    assert title.text is None and title.pages == 4
    other = html.merge(html.collapse(html.parse("<div><h2>a</h2><p>b</p></div>")[0]), html.collapse(html.parse("<div><p>b</p><table><tr><td>1</table></div>")[0]))
    assert "h2?" in other.shape() and "table?" in other.shape() and "p(" in other.shape()
    pairs = html.collapse(html.parse("<div>" + "<h3>q</h3><pre>a</pre>" * 5 + "</div>")[0])
    assert "(h3 pre)*" in pairs.shape()


def test_no_pages(spark):
    assert html.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_query_on_the_test_tables(spark, folder):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in queries.op2_main_text(spark, folder).collect():
        body = re.sub(r"<br>|</?b>", " ", re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1])
        blocks = [" ".join(entities.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


AROUND = ['<div class="layout has-sidebar">', '<div id="wrap" class="nav-open">', '<div class="content no-comments">', '<div class="page-with-sidebar">', '<div class="sidebar">', '<form id="form">']
INSIDE = [
    '<h2 id="discussion">Part {i}</h2>', '<section id="legal-form"><p>Part {i}</p></section>', '<p class="search-term">Part {i}</p>', '<section id="discussion"><p>Part {i}</p></section>',
    '<ul><li id="search">Part {i}</li></ul>', '<div class="notice-period">Part {i}</div>', '<p id="related">Part {i}</p>',
]


def test_words_of_asides_in_classes_and_ids_lose_no_article(spark):
    rows, want = [], {}
    for n, part in enumerate([*AROUND, *INSIDE]):
        for i in range(4):
            around, inner = (part, "") if n < len(AROUND) else ("<div>", part.format(i=i))
            close = "</form>" if around.startswith("<form") else "</div>"
            page = HEAD + MENU + around + "<article>" + article(i) + inner + '<div class="ad">Buy</div></article>' + close + TAIL
            rows.append((10 * n + i, f"http://h{n}.example/{i}", page))
            want[10 * n + i] = text(i) + (f"\n\nPart {i}" if inner else "")
    got = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_compounds_without_a_marked_article(spark):
    """What is named post-comments is not the article; a text found nowhere else is."""
    plain = [(i, f"http://x.example/{i}", HEAD + '<div class="post">' + article(i) + f'</div><div class="post-comments"><p>Said {i} by some</p></div>' + TAIL) for i in range(4)]
    other = [(10 + i, f"http://y.example/{i}", HEAD + MENU + '<div class="sidebar-layout">' + article(i) + "</div>" + TAIL) for i in range(4)]
    got = html.extract(spark.createDataFrame(plain + other, "page_id bigint, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k + i: text(i) for i in range(4) for k in (0, 10)}
