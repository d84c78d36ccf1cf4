import numpy as np
import pytest

from tarnwheel.llm import htmltext as h
from tarnwheel.llm.htmlblocks import leaves


@pytest.fixture(scope="module")
def field():
    return h.trained()


def around(leaf):
    """The elements around a block, outermost first."""
    out, at = [], leaf.around
    while at.outer is not None:
        out.append(at)
        at = at.outer
    return out[::-1]


def test_blocks_and_their_surroundings():
    page = "<html><head><title>T</title><style>p{}</style></head><body><nav class='topNav'><ul><li>A <a href=x>b</a><li>c</ul></nav><p>x &amp; y<br>z&nbsp; &#65;<p>q <b>r</b>s<script>var t='<p>no</p>';</script><div id=main>u<p>v</div>w<!-- <p>no -->"
    found = leaves(page)
    assert [b.text for b in found] == ["A b", "c", "x & y z A", "q rs", "u", "v", "w"]
    assert [e.tag for e in around(found[1])] == ["html", "body", "nav", "ul", "li"]
    assert around(found[0])[2].said == ("top", "nav") and found[0].linked == 1
    assert [e.tag for e in around(found[5])] == ["html", "body", "div", "p"]
    assert around(found[6])[-1].tag == "body"


@pytest.mark.parametrize("page", ["", "text", "<", "<p", "<p>a<b", "a<script>b", "<!-- a", "</p></div>a", "<p>" * 500 + "a", "<a><a><a>x", "<p title='>'>a</p>", "<p title='>a</p>", "&amp &bogus; &#0;", "<div>" * 3000 + "deep"])
def test_broken_pages_never_fail(page, field):
    assert isinstance(h.text_of(page, field), str)


def test_long_pages_take_time_in_proportion():
    assert [b.text for b in leaves("<p>a</p>" + "<" * 10)] == ["a", "<" * 10]
    assert len(leaves("<p>x</p>" * 100_000)) == 100_000
    leaves("<p title='" * 20_000)


def test_held_out_pages(field):
    right = total = whole = 0
    pages = h.examples(200, seed=77)
    for page, text in pages:
        blocks = leaves(page)
        truth, found = h.labels(blocks, text), field.decode(blocks)
        assert sum(truth) == len(text.split("\n"))
        right += sum(a == b for a, b in zip(truth, found, strict=True))
        total += len(truth)
        whole += truth == found
    assert right / total > 0.985 and whole / len(pages) > 0.8


def test_viterbi_is_the_best_of_all_paths(field):
    rng = np.random.default_rng(3)
    blocks = leaves(h.examples(1, seed=5)[0][0])[:9]
    gains = rng.normal(0, 3, len(blocks))
    toy = h.Field({}, rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2), rng.normal(0, 1, 2))
    toy.gains = lambda _: gains.tolist()

    def score(path):
        return toy.first[path[0]] + toy.last[path[-1]] + sum(gains[k] for k, s in enumerate(path) if s) + sum(toy.moves[a, b] for a, b in zip(path, path[1:], strict=False))

    paths = [[n >> k & 1 for k in range(len(blocks))] for n in range(1 << len(blocks))]
    assert [int(x) for x in toy.decode(blocks)] == max(paths, key=score)


def test_usual_parts_go_and_the_article_stays(field):
    page = """<body><header class=site-header><a href=/>Site</a></header><nav><a href=/a>A</a> <a href=/b>B</a></nav>
    <div class="cookie-notice">We use them. <button>Fine</button></div><div class=ad>Buy now.</div>
    <article><h1>The  title</h1><p>First &lt;part&gt;.<p>Second<br>part, <i>long</i> enough to read.</p><ul><li>One</li></ul>
    <div class="ad">Buy this too.</div><p>Last.</p></article><aside class=sidebar><p>Other stories that you may like.</p></aside>
    <section id=comments><h2>Comments</h2><div class=comment><p>I liked this very much, thank you.</p></div></section>
    <form><label>Name</label><input><button>Send</button></form><footer>&copy; All rights reserved.</footer></body>"""
    assert h.text_of(page, field) == "The title\nFirst <part>.\nSecond part, long enough to read.\nOne\nLast."


def test_query_and_odd_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<article><p>Some words here.</p></article>", "x"), (3, "u", "<nav><a>x</a></nav>", "x"), (3, "u", "<nav><a>x</a></nav>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = h.extracted(pages).collect()
    assert sorted(((r.page_id, r.text, r.n_chars) for r in found), key=repr) == sorted([(1, "", 0), (2, "", 0), (None, "Some words here.", 16), (3, "", 0), (3, "", 0)], key=repr)
    assert h.extracted(pages.limit(0)).collect() == []


def test_pages_of_the_table(spark, field):
    """The pages' articles are known by their element."""
    import html
    import re

    for r in h.op5_extract_text(spark, "/root/testdata/sf0.001").join(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text)


def test_attribute_values_are_read_whole():
    from tarnwheel.llm.htmlblocks import marks

    classes = " ".join(f"utility-{k}" for k in range(200))
    for name in ("class", "id", "role", "itemprop", "aria-label"):
        assert "sidebar" in marks(f' {name}="{classes} sidebar"')


def test_deep_pages_take_time_in_proportion(field):
    """A megabyte of nested elements, of unmatched ends, and of open inline elements: seconds, not hours."""
    import time

    for page in ("<div>x" * 150_000, "<div>" * 80_000 + "</p></li>x" * 60_000, "<b>" * 150_000 + "<div>x</div>" * 30_000, "<div class=a><p>x" * 60_000, "<div>" * 80_000 + "<li>x</li><a>y" * 40_000):
        began = time.perf_counter()
        assert isinstance(h.text_of(page, field), str)
        assert time.perf_counter() - began < 40, page[:20]


def test_form_controls_go_and_formulas_stay(field):
    page = "<body><article><h1>A title of words</h1><p>The sum <math><mi>x</mi><mo>+</mo><mn>1</mn><annotation encoding=tex>x+1</annotation></math> is known to all readers of this.</p><textarea>Write here</textarea><button>Send it now</button><select><option>One<option>Two</select><p>This is the second paragraph.</p></article></body>"
    assert h.text_of(page, field) == "A title of words\nThe sum x+1 is known to all readers of this.\nThis is the second paragraph."


def test_what_is_not_shown_goes(field):
    page = """<body><article><h1>A title of words</h1><p>The first paragraph has <span hidden>some secret </span>words to read, and goes on a little.</p>
    <div style="color:red; display: none"><p>Nobody sees this paragraph, which is as long as others are here.</p></div><p hidden>Nor this one, which is as long as others are.</p>
    <p title="the hidden truth" data-state="hidden" class="overflow-hidden">The second paragraph is there for all to see and read.</p></article></body>"""
    assert h.text_of(page, field) == "A title of words\nThe first paragraph has words to read, and goes on a little.\nThe second paragraph is there for all to see and read."
