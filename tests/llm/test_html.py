import brute
import duckdb
import pytest
from cases import SMALL

from tallyworks.llm import html_template as ht

PAGES = "page_id long, url string, html string, host string, token string, content string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "t", "c") for r in rows], PAGES)


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SMALL}/pages.parquet'").fetchall()
    got = {r.id: r for r in ht.extract(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, url, source in rows:
        assert got[i].text == brute.article(source) and got[i].n_chars == len(got[i].text) and got[i].address == url


def other_layout(i, body, fixed="Read more on our site every day"):
    """A site without article elements: a table of regions named by class, a sidebar, comments and a form."""
    return (
        f"<html><head><title>t{i}</title><style>.a{{}}</style></head><body><header><a href='/'>Home</a> Site name</header>"
        f"<div class='top-nav'><a href='/x'>Products and services</a></div><div id='wrap-{i}'><div class=\"cookie-notice\">We use cookies &amp; more</div>"
        f"<div class='story'><h2>Head {i}</h2>{body}<p>{fixed}</p><div class=\"ad-slot\">Buy this thing now {i}</div></div>"
        f"<aside>Most read {i}: <a href='/y'>other story</a></aside><div id='comments'><article class='comment'><p>I disagree {i}!</p></article></div>"
        f"<form action='/s'><label>Search here</label><input value='x>y'></form></div><footer>All rights</footer><script>if (a < b) {{ '</p>' }}</script></body></html>"
    )


def test_layout_without_article(spark):
    bodies = [f"<p>Story {i} has <b>bo</b>ld words,<br>two   lines\n&eacute;&nbsp;&lt;{i}&gt;.</p><p>Second piece number {i} " + "text " * (i % 7 + 3) for i in range(30)]
    rows = [(i, f"https://News.example.org:80/{i}", other_layout(i, b + "</p>")) for i, b in enumerate(bodies)]
    got = {r.id: r.text for r in ht.extract(pages(spark, rows)).collect()}
    for i in range(30):
        assert got[i] == f"Head {i} Story {i} has bold words, two lines é <{i}>. Second piece number {i} " + " ".join(["text"] * (i % 7 + 3))


def test_page_of_another_layout(spark):
    """On a host of articles, a page without one is read by itself."""
    rows = [(i, "http://a.b/", f"<body><nav>menu</nav><article><p>text {i}</p></article></body>") for i in range(20)]
    rows.append((99, "http://a.b/99", "<body><nav>menu</nav><div><p>lonely page with words</p></div></body>"))
    got = {r.id: r.text for r in ht.extract(pages(spark, rows)).collect()}
    assert got[3] == "text 3" and got[99] == "lonely page with words"


@pytest.mark.parametrize(
    ("source", "want"),
    [
        (None, ""), ("", ""), ("plain text &amp; no markup", "plain text & no markup"), ("<p>a<p>b", "a b"), ("<p>un<i>closed", "unclosed"),
        ("<div><!-- x > y --><p>a</p><!-- cut", "a"), ("<p title=\"a>b\">c</p><p title='open>d</p>", "c d"), ("a <script>never closed", "a"),
        ("<ul><li>one<li>two</ul>", "one two"), ("<article>x<header><h1>T</h1></header><footer>f</footer>y</article><p>out</p>", "x T y"),
        ("<p>x &unknown; &am</p>", "x &unknown; &am"), ("</p></div>text</b>", "text"), ("<p hidden>no</p><p>yes</p>", "yes"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<body>a<br/>b<img src=x>c</body>", "a bc"), ("<", "<"), ("a < b and <3", "a < b and <3"),
        ("<form><article><p>in a form</p></article></form>", "in a form"), ("<main><section class=comments><p>reader</p></section><p>main</p></main>", "main"),
    ],
)
def test_markup(source, want):
    assert ht.alone(ht.Page(source or "")) == want


def test_equivalence_classes():
    """Classes by brute force over occurrence vectors are those of the fingerprints."""
    sources = [f"<body><nav><ul>{'<li><a>x</a>' * (i % 3 + 1)}</ul></nav><article><h1>t</h1>{'<p>z</p>' * (i % 4)}</article></body>" for i in range(12)]
    counts = [ht.page_tokens(ht.Page(s)) for s in sources]
    tokens = sorted({t for c in counts for t in c if not t.startswith("=")})
    vectors = {t: tuple(c.get(t, [0])[0] for c in counts) for t in tokens}
    sums = []
    for t in tokens:
        h = [(ht._hash(s + str(i), 1) >> 36, ht._hash(s + str(i), 2) >> 36) for i, s in enumerate(sources)]
        sums.append(
            {"token": t, "is_text": 0, "pages": sum(v > 0 for v in vectors[t]), "total": sum(vectors[t]), "place": counts[-1].get(t, [0, 0])[1],
             "f1": sum(v * x[0] for v, x in zip(vectors[t], h)), "f2": sum(v * x[1] for v, x in zip(vectors[t], h))}
        )
    found = ht.equivalence_classes(sums)
    for c in found:
        assert len({vectors[t] for t in c["tokens"]}) == 1
    root = [c for c in found if c["per_page"] == 1]
    assert len(root) == 1 and {"/body", "/body/article", "/body/article/h1"} <= set(root[0]["tokens"])


def test_templates_and_empty_table(spark):
    rows = [(i, "http://a.b/", f"<body><nav>menu</nav><article><p>text {i}</p></article></body>") for i in range(20)]
    found = ht.templates(pages(spark, rows + [(50, None, "<p>x</p>"), (None, "no address", None)])).collect()
    assert {r.host for r in found} == {"a.b", ""} and {r.content for r in found if r.host == "a.b"} == {"/body/article"}
    assert ht.extract(pages(spark, [])).count() == 0
    repeated = ht.extract(pages(spark, [rows[0], rows[0], (None, None, None)]))
    assert sorted(r.text for r in repeated.collect()) == ["", "text 0", "text 0"]


@pytest.mark.parametrize("copies", [9, 10, 1000])
def test_copies_of_a_page_keep_their_text(spark, copies):
    """Copies of one page, alone or beside others of the host, are no template of their text; nor are near copies."""
    page = "<body><nav>menu</nav><{0}><h1>Head</h1><p>first {1}</p><p>second</p></{0}></body>"
    rows = [(i, "http://a.b/", page.format("article", "one")) for i in range(copies)]
    rows += [(5000 + i, "http://c.d/", page.format("div", "one")) for i in range(copies)]
    rows += [(7000 + i, "http://e.f/", page.format("article", f"n{i}")) for i in range(12)]
    got = {r.id: r.text for r in ht.extract(pages(spark, rows)).collect()}
    assert {got[i] for i in range(copies)} == {got[5000 + i] for i in range(copies)} == {"Head first one second"}
    assert all(got[7000 + i] == f"Head first n{i} second" for i in range(12))


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<div style='overflow:hidden'><article>a <a href='/hidden-valley'>b</a></article></div>", "a b"),
        ("<div class=overflow-hidden><p class='hidden-xs'>a</p></div>", "a"), ("<p data-x='display:none' title='hidden'>a</p>", "a"),
        ("<div class='content-sidebar-wrap'><article>a</article><div class=sidebar>no</div></div>", "a"),
        ("<div class='comments-open'><main>a<div class=comments><article>no</article></div></main></div>", "a"),
        ("<article>a</article><div class=comments><article>no, and longer than the text</article></div>", "a"),
        ("<p HIDDEN>no</p><p hidden=''>no</p><p style='color:red; display : none'>no</p><p aria-hidden=true>no</p><p hidden=until-found>a</p>", "a"),
    ],
)
def test_hidden_and_named_wrappers(source, want):
    assert ht.alone(ht.Page(source)) == want


def neutral(i):
    """Only div and span with names that say nothing: long fixed menu, story with a fixed line, advert, sidebar of links, comments."""
    story = "".join(f"<div>{w} {i} was told by people of the town and written down here</div>" for w in ("One", "Two", "Three", "Four")[: i % 3 + 2])
    comments = "".join(f"<div class='k'><span>reader {i} {k}</span></div>" for k in range(i % 3))
    side = "".join(f"<div class='l'><a href='/{i}{k}'>Another story of that day, {i} {k}, by someone else</a></div>" for k in range(4))
    return (
        f"<html><body><div class='w'><div class='a'><div>{'Sections of this paper and all that it offers. ' * 12}</div></div>"
        f"<div class='b'><div class='h'>Head {i}</div>{story}<div class='z'>Write to us</div></div>"
        f"<div class='c'><div>Buy kettle {i}</div></div><div class='d'>{side}</div><div class='e'>{comments}</div></div></body></html>"
    )


@pytest.mark.parametrize("n", [3, 9, 30, 1000])
def test_host_of_neutral_names(spark, n):
    """The slots find the story at every number of pages, where a page alone does not tell it from its menu."""
    got = {r.id: r.text for r in ht.extract(pages(spark, [(i, f"http://a.b/{i}", neutral(i)) for i in range(n)])).collect()}
    for i in range(n):
        told = " ".join(f"{w} {i} was told by people of the town and written down here" for w in ("One", "Two", "Three", "Four")[: i % 3 + 2])
        assert got[i] == f"Head {i} {told}" != ht.alone(ht.Page(neutral(i)))
    found = ht.templates(pages(spark, [(i, f"http://a.b/{i}", neutral(i)) for i in range(n)])).first()
    assert found.content == "/html/body/div.w/div.b" and "div.a" not in found.slots and "/html/body/div.w/div.b" in found.slots


@pytest.mark.parametrize("n", [2, 5, 12])
def test_near_copies_without_article_keep_their_text(spark, n):
    rows = [(i, "http://g.h/", f"<body><nav>menu</nav><div><h1>Head</h1><p>first n{i}</p><p>second piece of text</p></div></body>") for i in range(n)]
    rows += [(100 + i, "http://i.j/", f"<body><div><h1>Head</h1><p>{'long text ' * 50}</p></div><div><p>day {i}</p></div></body>") for i in range(n)]
    got = {r.id: r.text for r in ht.extract(pages(spark, rows)).collect()}
    assert all(got[i] == f"Head first n{i} second piece of text" for i in range(n))
    assert all("Head " + "long text " * 49 + "long text" in got[100 + i] for i in range(n))


def test_blocks_inside_an_article():
    source = "<article>a<div class='related-story'>b</div><p class='legal'>c</p><div class='ad-slot'>no</div><div class='w-1/2'>d</div><div class='cookie-notice'>no</div></article>"
    assert ht.alone(ht.Page(source)) == "a b c d"
