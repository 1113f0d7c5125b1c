import random
import time
from html.parser import HTMLParser

import numpy as np

from opinio.llm.html_extract import FEATURES, LABELLED, Tree, extract, features, main_text, page_blocks, train

TREE = train()


def text(page):
    return main_text(page, TREE)[0]


def test_tree_learns_its_table():
    table = np.array(LABELLED, float)
    assert (TREE.predict(table[:, :-1]) == table[:, -1]).all()
    assert Tree(np.zeros((3, 2)), np.array([1, 1, 0])).predict(np.zeros((2, 2))).tolist() == [1, 1]


def test_article_without_what_surrounds_it():
    page = (
        "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t='</p>';</script></head><body class='nav'><header>Site</header>"
        "<nav><ul><li><a href=/>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div><article><h1>Caf&eacute; &amp; more&am</h1>"
        "<p>One <b>two</b><br>three\n  f<i>ou</i>r<p>Un.<div class=ad>Buy now</div><form><input value=x><label>Mail</label></form>"
        "<p>a &lt; b &copy 1 &#65;&#x42;<!-- gone --></p><aside>Side bar</aside><ul><li>first</li><li>second</li></ul>"
        "<ul><li><a href=1>link one</a></li><li><a href=2>link two</a></li></ul><section id='comments'><p>" + "nice " * 60 + "</p></section></article>"
        "<div class=sidebar><p>" + "long " * 80 + "</p></div><footer>&copy; me</footer></body></html>"
    )
    assert text(page) == "Café & more&am One two three four Un. a < b © 1 AB first second"


def test_pages_without_an_article_element():
    body = "word " * 60
    assert text(f"<div><a href=1>Home</a> <a href=2>News</a></div><p>{body}</p><p>Short.</p><p>{body}</p>") == f"{body}Short. {body}".strip()


def test_broken_and_empty_pages():
    for page in (None, "", "   ", "<", "<p", "<!-- x", "<script>x", "</p></div>", "<article>", "<a href='x", "&", "<div " * 2000):
        text(page)
    assert text(None) == text("") == text("<script>var a</script>") == ""
    assert text("<article><p>a<div>b</article><p>c") == "a b"
    assert page_blocks("<article><p hidden>x</p><p>y</p><span style='display:none'>z</span>w</article>")[0].text == "y"
    assert features([]).shape == (0, 11)
    long = "<article>" + "<p>w</p>" * 30_000 + "</article>"
    assert text(long) == " ".join(["w"] * 30_000)


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>x y</p></article>"), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    pages = pages.selectExpr("*", "7 as text", "8 as row")
    got = sorted((r.page_id, r.url, r.text, r.n_chars) for r in extract(pages, keep=("url",)).collect() if r.page_id == 1)
    assert got == [(1, "u", "x y", 3)]
    assert [(r.text, r.n_chars) for r in extract(pages).where("page_id = 2").collect()] == [("", 0)] * 2
    assert extract(pages.limit(0)).count() == 0


def test_names_that_mislead_erase_no_text():
    body = "<p>one two three four</p><p>five six</p>"
    for page in (f"<article class='post tags'>{body}</article>", f"<div class='main sidebar-right'>{body}</div>", f"<div class='comment-free content'>{body}</div>", f"<main class=search>{body}</main>"):
        assert text(page) == "one two three four five six"
    assert text("A page of plain text") == "A page of plain text" and text("Hi") == "Hi"
    # a name of the page's layout around its only article
    assert text(f"<div class='has-sidebar'><nav><a href=1>Home</a></nav><main><h1>Title</h1><p>{'w ' * 30}</p><p>{'v ' * 20}</p></main></div>") == "Title " + "w " * 30 + ("v " * 20).strip()
    # compounds keep the word of clutter
    assert text(f"<article>{body}<div class='post-comments'><p>{'nice ' * 50}</p></div><div class='article-footer'>me</div></article>") == "one two three four five six"


def test_links_beside_a_block_decide_where_names_disagree():
    links = "<div><a href=1>one link</a></div>"
    around = "<p>" + "word " * 20 + "</p>"
    page = lambda inside: f"<article><p>first text here</p></article><div class='content widget'>{inside}</div>"
    assert "in between" in text(page(f"{around}<p>in between</p>{around}"))
    assert "in between" not in text(page(f"{links}<p>in between</p>{links}"))
    split = lambda t: set() if t.feature < 0 else {FEATURES[t.feature]} | split(t.below) | split(t.above)
    assert {"linked", "linked_before", "linked_after", "clutter", "article"} <= split(TREE)


class Reader(HTMLParser):
    """Flat blocks of well-formed pages of a few tags, by the standard parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out, self.words, self.linked, self.link, self.items = [], "", "", False, 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        if self.words.split():
            self.out.append((" ".join(self.words.split()), min(len(self.linked.split()) / len(self.words.split()), 1.0), self.items > 0))
        self.words = self.linked = ""

    def handle_starttag(self, tag, _):
        if tag == "a":
            self.link, self.linked = True, self.linked + " "
        elif tag != "b":
            self.flush()
            self.items += tag == "li"

    def handle_endtag(self, tag):
        if tag == "a":
            self.link, self.linked = False, self.linked + " "
        elif tag != "b":
            self.flush()
            self.items -= tag == "li"

    def handle_data(self, data):
        self.words += data
        self.linked += data if self.link else ""


def test_blocks_equal_those_of_a_plain_reader():
    rng = random.Random(7)

    def inside(depth):
        parts = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.choice(["text", "text", "a", "b", "p", "div", "ul", "section", "blockquote"])
            word = " ".join(rng.choices(["x", "yy", "a &amp; b", "&#65;", "é"], k=rng.randint(1, 4)))
            if kind == "text":
                parts.append(rng.choice([" ", "\n", ""]) + word + rng.choice([" ", ""]))
            elif kind in ("a", "b", "p"):
                parts.append(f"<{kind}>{word}</{kind}>")
            elif depth < 5:
                body = "".join(f"<li>{inside(depth + 1)}</li>" for _ in range(rng.randint(1, 3))) if kind == "ul" else inside(depth + 1)
                parts.append(f"<{kind}>{body}</{kind}>")
        return "".join(parts)

    for _ in range(400):
        page = inside(0)
        assert [(b.text, b.linked, b.item) for b in page_blocks(page)] == Reader(page).out, page


def test_deep_pages_take_time_in_proportion():
    def seconds(n):
        start = time.perf_counter()
        page_blocks("<div>x<span hidden>y</span><li>z" * n)
        return time.perf_counter() - start

    seconds(1000)
    assert min(seconds(32_000) for _ in range(2)) < 20 * min(seconds(4_000) for _ in range(3)) + 0.2
