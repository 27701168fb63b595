import pytest

from tests.llm.test_html import alone

DEEP = 200


@pytest.mark.parametrize(
    "page,want",
    [
        ("<body><div><article><p>a</p>" + "<div>" * DEEP + "deep" + "</div>" * DEEP + "<p>later</p></article><p>out</p></div></body>", "a\ndeep\nlater"),
        ("<article>" + "<div>" * DEEP + "<nav><div>menu</div></nav><p>in</p>after" + "</div>" * DEEP + "<p>z</p></article>", "in\nafter\nz"),
        ("<div>" * DEEP + "<article><p>x</p><div>y</div>z</article><p>no</p>" + "</div>" * DEEP, "x\ny\nz"),
        ("<article>" + "<div>" * DEEP + "one<div>two</div>three <b>bold</b> end", "one\ntwo\nthree bold end"),
        ("<article><p>a</p>" + "<font>" * 3000 + "b" + "<aside>side</aside>" + "</font>" * 3000 + "<p>c</p></article><p>out</p>", "a\nb\nc"),
    ],
)
def test_deep_pages(page, want):
    assert alone(page) == want
