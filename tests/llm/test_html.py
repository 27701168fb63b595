import random
import re
from html import unescape

import pytest

from sparktab.llm import html
from sparktab.llm.html import Wrapper, distinct, expression, extract_text, learn_page, load, merge_lists, parse, shape, slots
from sparktab.llm.queries import QUERIES

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>menu</ul></nav>
<div class="cookie-notice">cookies</div><!-- <p>comment</p> --><main><article><header><h1>Title &amp; more</h1><span>by me</span></header>
<p>First  para&nbsp;with<br>line <b>bo</b>ld &lt;x&gt;<script>if (a<b) "</p>"</script><ul><li>one<li>two</ul><div class="ad banner">buy</div>
<p>Last<section class="comments"><h2>Comments</h2><p>reader says</p></section></article></main><aside>side</aside>
<form><p>name <input></p></form><footer>&copy; foot</footer></body></html>"""
WANT = "Title & more\nFirst para with line bold <x>\none\ntwo\nLast"


def alone(page):
    tree = parse(page)
    return Wrapper(learn_page(page)).read(tree)


@pytest.mark.parametrize(
    "page,want",
    [
        (FULL, WANT),
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>open <b>bold<p>next</p></p>", "open bold\nnext"),
        ("<a href='x>broken", "broken"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000 + "after", "deep\nafter"),
        ("<article><p>a</article><article class=comment><p>c</article>", "a"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<p>a<script>x", "a"),
        ("<P>Up</P><DIV>per &#233;&eacute;&unknown;", "Up\nper éé&unknown;"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"),
    ],
)
def test_pages(page, want):
    assert alone(page) == want


def test_wrapper_of_two_pages():
    pages = ["<h1>a</h1><ul><li>1</li><li>2</li></ul><p>x</p>", "<h1>b</h1><ul><li>3</li></ul><div>y</div><p>x</p>"]
    nodes = merge_lists(learn_page(pages[0]), learn_page(pages[1]))
    assert expression(nodes) == "<h1>#text</h1><ul>(<li>#text</li>)+</ul>(<div>#text</div>)?<p>#text</p>"
    assert [[len(x) for x in n[3][0][3][:2]] for n in nodes if n[0] in ("h1", "p")] == [[2, 2], [1, 2]]
    pairs = "<dl>" + "<dt>t</dt><dd>d</dd>" * 3 + "</dl>"
    assert expression(shape(parse(pairs))) == "<dl>(<dt>#text</dt><dd>#text</dd>)+</dl>"


def test_every_page_fits_the_wrapper():
    """A page's own tags, read against the merged wrapper, always find their nodes."""
    rng = random.Random(12)
    tags = ["p", "div", "h2", "ul", "section", "pre"]

    def make(depth):
        if depth > 3 or rng.random() < 0.3:
            return "t" + str(rng.random())
        return "".join(f"<{t}>{make(depth + 1)}</{t}>" for t in rng.choices(tags, k=rng.randint(1, 5)))

    pages = [make(0) for _ in range(80)]
    nodes = learn_page(pages[0])
    for p in pages[1:]:
        nodes = merge_lists(nodes, learn_page(p))
    for p in pages:
        want = [x for x in re.findall(r"t0\.[0-9e-]+", p)]
        assert Wrapper(nodes).read(parse(p)).split("\n") == want
        stack = [(parse(p), slots(nodes))]
        while stack:
            element, here = stack.pop()
            for child in element.children:
                assert ("#" if isinstance(child, str) else child.key) in here
                if not isinstance(child, str):
                    stack.append((child, here[child.key].below))


def test_template_text_of_a_host(spark):
    pages = [(i, f"http://h.com/{i}", f"<body><div>Same notice</div><p>own {i}</p><p>tail {i}</p></body>") for i in range(6)]
    pages += [(9, "http://few.com/", "<body><div>Same notice</div><p>own 9</p></body>")]
    rows = extract_text(spark.createDataFrame(pages, "page_id int, url string, html string")).collect()
    assert {r.page_id: r.text for r in rows} == {i: f"own {i}\ntail {i}" for i in range(6)} | {9: "Same notice\nown 9"}


def article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", body[1] if body else "")
    blocks = [" ".join(unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_query(spark, small):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = QUERIES["op10_extract_text"](spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_rows(spark, monkeypatch):
    rows = [(1, None, None, "x"), (2, "", "", "x"), (2, "", "", "x"), (None, "http://a.b/", FULL, "x"), (3, "nohost", "<p>z " + "w " * 300_000, None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string")
    got = extract_text(df).collect()
    assert len(got) == 5 and {r.page_id: r.text_ for r in got} == {1: "", 2: "", None: WANT, 3: ("z " + "w " * 300_000).strip()}
    assert extract_text(df.where("false")).count() == 0
    monkeypatch.setattr(html, "SEND_BYTES", 0)
    assert sorted(len(r.text_) for r in extract_text(df).collect()) == sorted(len(r.text_) for r in got)


def host(pages):
    nodes = learn_page(pages[0])
    for p in pages[1:]:
        nodes = merge_lists(nodes, learn_page(p))
    return Wrapper(nodes)


@pytest.mark.parametrize(
    "part",
    [
        '<p class="social">social life {}</p>',
        '<section class="related-work"><p>others did {}</p></section>',
        '<div class="header-image">figure {}</div>',
        '<p>see <span class="comment">remark {}</span></p>',
    ],
)
def test_class_names_inside_an_article(part):
    """A name alone takes no text away; texts that the host repeats under such a name go."""
    pages = [f"<nav>menu</nav><article><h1>Title {i}</h1><p>long text number {i} of the article</p>{part.format(i)}</article>" for i in range(5)]
    for n in (1, 5):
        wrapper = host(pages[:n])
        for p in pages[:n]:
            assert wrapper.read(parse(p)).splitlines()[-1] == re.sub("<[^>]*>", "", part).format(pages.index(p))
    same = [p.replace(part.format(i), part.format("same")) for i, p in enumerate(pages)]
    wrapper = host(same)
    assert all("same" not in wrapper.read(parse(p)) and f"number {i}" in wrapper.read(parse(p)) for i, p in enumerate(same))


@pytest.mark.parametrize("name", ["navbar-light", "notice", "banner"])
def test_body_under_an_odd_class(name):
    page = f'<body><ul class="menu"><li>a</ul><div class="{name}"><h1>Head</h1><p>{"whole body of the page " * 9}</p></div></body>'
    assert alone(page) == "Head\n" + ("whole body of the page " * 9).strip()


def test_adverts_and_comments_of_readers_go():
    pages = [f'<article><p>text {i} ' + "w " * 40 + f'</p><div class="ad">buy {i}</div><div class="user-comments"><p>{"nice " * 30}{i}</p></div></article>' for i in range(4)]
    for n in (1, 4):
        wrapper = host(pages[:n])
        assert all(wrapper.read(parse(p)) == f"text {i} " + ("w " * 40).strip() for i, p in enumerate(pages[:n]))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9])
def test_equal_pages_keep_their_text(n):
    assert host(["<body><p>Whole text of a page</p></body>"] * n).read(parse("<body><p>Whole text of a page</p></body>")) == "Whole text of a page"
    near = [f"<body><p>Whole text of a page</p><i>{i}</i></body>" for i in range(n)]
    assert "Whole text" in host(near).read(parse(near[0]))


def test_order_of_pages_does_not_matter():
    rng = random.Random(3)
    pages = ["".join(rng.choice(['<p>x{}</p>', '<div class="ad">same</div>', "<h2>h{}</h2>", "<ul><li>{}<li>b</ul>", '<div class="notice">n{}</div>']).format(rng.randint(0, 9)) for _ in range(rng.randint(1, 70))) for _ in range(12)]
    want = [host(pages).read(parse(p)) for p in pages]
    for _ in range(5):
        other = pages[:]
        rng.shuffle(other)
        wrapper = host(other)
        assert [wrapper.read(parse(p)) for p in pages] == want


def test_counts_of_sketches():
    texts = [f"<p>{i}</p>" for i in range(400)]
    slot = learn_page("<div>" + "".join(texts) + "</div>")[0][3][0][3][0][3]
    assert 200 < distinct(slot[0]) < 800 and distinct([1, 2, 3]) == 3


def test_wrapper_decides(spark, small):
    """Without its host's wrapper a page gives another text: the article and the adverts are known from the wrapper alone."""
    pages = [r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect() if r.html]
    assert all(load("[]").read(parse(p)) != host([p]).read(parse(p)) for p in pages)
