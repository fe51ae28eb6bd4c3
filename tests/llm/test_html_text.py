import math
import random

import numpy as np
import pytest

from adflow.llm import html_text as ht

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def net(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    return ht.train(pages)


def test_blocks_of_broken_markup():
    page = """<!DOCTYPE html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>x";</script></head>
    <body><nav class="top menu"><ul><li><a href="/a">One</a><li>Two</ul></nav><!-- <p>no</p> --><div id='Main-Content'>
    <p>First <b>bo</b>ld<br>line&nbsp;two<p>Second<div class=ad>Buy</div>tail</div><img alt="x>y"><footer>&copy; end"""
    got = ht.blocks(page)
    assert [t for _, t, _ in got] == ["T & t", "One", "Two", "First bold line two", "Second", "Buy", "tail", "© end"]
    paths = {t: p for p, t, _ in got}
    assert paths["One"] == ("body", "nav", ".top", ".menu", "ul", "li") == paths["Two"]
    assert paths["tail"] == ("body", "div", ".main", ".content") and paths["Buy"][-2:] == ("div", ".ad")
    assert paths["Second"][-1] == "p" and paths["Second"].count("p") == 1
    assert [n for _, t, n in got if t == "One"] == [3]
    assert ht.teach(got).tolist() == [0, 0, 0, 1, 1, 0, 1, 0]


@pytest.mark.parametrize("page", ["", "<", "<p", "a < b > c", "<script>x", "<!-- x", "<p class='", "&", "</div></p>", "\x00<p>\x00", "<a" * 50])
def test_any_text_is_a_page(page):
    ht.blocks(page)


@pytest.mark.parametrize("mark", [
    '<svg class="i"/>', '<svg-icon name="x"></svg-icon>', "<svg class=i />", '<svg title="a>b"/>', "<template-x></template-x>",
    "<object-fit>", "<svg><text>no</text></svg>", "<SVG><path d='M0'/></SVG >", "<canvas>", "<iframe src=x>", "<svg>",
    "<script-x></script-x>", "<style-y>", "<script>a</script-x>b</script >"])
def test_text_after_a_mark_is_kept(mark):
    page = f"<article><p>one</p>{mark}<p>two</p><p>three</p></article><svg-icon></svg-icon><footer>end</footer>"
    assert [t for _, t, _ in ht.blocks(page)] == ["one", "two", "three", "end"]


def test_formulas_and_old_code_are_text():
    page = """<article><p>Let <math display="inline"><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p>
    <xmp>if (a < b) &amp; <p>x</p></xmp><p>Last<xmp>open"""
    assert [(p, t) for p, t, _ in ht.blocks(page)] == [
        (("article", "p"), "Let x=1 hold."), (("article", "pre"), "if (a < b) &amp; <p>x</p>"), (("article", "p"), "Last"),
        (("article", "p", "xmp"), "open")]


def test_marks_and_formulas_in_main_text(net):
    one, two, three = (f"This is the {n} paragraph of the text, which is long enough." for n in ("first", "second", "third"))
    for mark, text in (('<svg class="i"/>', ""), ("<svg-icon name='x'></svg-icon>", ""), ("<xmp>a < b, and some code.</xmp>", "a < b, and some code. "),
                       ("<p>Here <math><mi>x</mi><mo>=</mo><mn>1</mn></math> is set to one.</p>", "Here x=1 is set to one. ")):
        page = f"<nav><ul><li><a>Home</a></ul></nav><article><p>{one}</p>{mark}<p>{two}</p><p>{three}</p></article><footer>(c)</footer>"
        assert ht.main_texts(net, [page]) == [f"{one} {text}{two} {three}"]


def test_many_open_marks_cost_their_size():
    assert len(ht.blocks("<p>x<iframe>" * 50_000)) == 50_000


def test_article_of_every_page(spark, net):
    """The fixture's pages hold their text in an article element."""
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = ht.main_texts(net, pages)
    for page, text in zip(pages, got):
        own = [t for path, t, _ in ht.blocks(page) if "article" in path]
        assert text == " ".join(own) and text


def test_other_markup(net):
    page = """<header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div><ul class="menu"><li><a>Home</a></ul>
    <div id="main-content"><h1>A title</h1><p>This is the first paragraph of text, which is long.<p>Second one here, of some length.
    <div class="ad">Buy now</div></div><aside>Other stories</aside><form><label>Mail</label></form>
    <div class="comments"><p>I disagree with all of that, said a reader.</p></div><footer>(c)</footer>"""
    assert ht.main_texts(net, [page]) == ["A title This is the first paragraph of text, which is long. Second one here, of some length."]


P1 = "This is the first paragraph of the text, which is long enough to be one, and has a comma."
P2 = "Here is the second paragraph, of some length too; it ends the article."


@pytest.mark.parametrize("names", [
    "story-body", "story", "text", "body", "entry", "post", "article-text", "main-content", "entry-content x7", "page-story q", "prose", "lede", "", "w3 zz"])
@pytest.mark.parametrize("before", ["", '<div class="cookie-notice"><p>We use cookies to make this site better.</p></div>'])
def test_articles_of_any_wrapper_are_whole(net, names, before):
    """Names the labels know, alone or among others, and names that say nothing."""
    page = f'<nav><ul><li><a href="/">Home</a><li><a href="/n">News</a></ul></nav>{before}<div class="{names}"><p>{P1}</p><p>{P2}</p></div><footer>Copyright</footer>'
    assert ht.main_texts(net, [page]) == [f"{P1} {P2}"]
    alone = f'{before}<div class="{names}"><p>{P1}</p><p>{P2}</p></div>'
    assert ht.main_texts(net, [alone]) == [f"{P1} {P2}"]


def test_bare_text_and_no_network(spark, net):
    assert ht.main_texts(net, [f"{P1} {P2}", "<nav>menu</nav>", ""]) == [f"{P1} {P2}", "", ""]
    assert ht.fit([]) is None and ht.fit(["", "<br>"]) is None
    page = f"<nav>Home News</nav><h1>A title</h1><p>{P1}</p><footer>Copyright</footer>"
    rows = spark.createDataFrame([(None, "u", page), (None, "v", None)], "page_id bigint, url string, html string")
    assert sorted(r["text"] for r in ht.page_texts(rows).collect()) == ["", f"A title {P1}"]


def slow_logits(net, x):
    """The network step by step, with plain loops over gates and units."""
    def one(side, rows):
        w, u, b = net.params[3 * side:3 * side + 3]
        h, c, out = [0.0] * ht.HIDDEN, [0.0] * ht.HIDDEN, []
        for row in rows:
            z = [b[j] + sum(row[k] * w[k, j] for k in range(len(row)) if row[k]) + sum(h[k] * u[k, j] for k in range(ht.HIDDEN))
                 for j in range(4 * ht.HIDDEN)]
            s = lambda v: 1 / (1 + math.exp(-v))
            n = ht.HIDDEN
            c = [s(z[n + k]) * c[k] + s(z[k]) * math.tanh(z[3 * n + k]) for k in range(n)]
            h = [s(z[2 * n + k]) * math.tanh(c[k]) for k in range(n)]
            out.append(h)
        return out

    left, right = one(0, x), one(1, x[::-1])[::-1]
    return [sum(v * w for v, w in zip(a + b, net.params[6])) + net.params[7][0] for a, b in zip(left, right)]


def test_network_against_a_slow_twin(net):
    page = f"<nav><a>Home</a></nav><div class=post><h1>Title</h1><p>{P1}</p><p>{P2}</p></div><footer>end</footer>"
    own = ht.blocks(page)
    x, live = ht._padded(ht.features([own]), [len(own)])
    assert np.allclose(net.logits(x, live)[:, 0], slow_logits(net, x[:, 0].astype(float)), atol=1e-4)


def test_varied_pages_are_labelled(net):
    rng = np.random.default_rng(8)
    page = [(("html", "body", "nav", "ul", "li"), "menu", 4)] + [
        (("html", "body", "article", "p"), " ".join(["some", "words"] * 12) + ".", 0) for _ in range(6)]
    wrong = total = 0
    for _ in range(60):
        own, y = ht.vary(page, ht.teach(page), rng)
        x, live = ht._padded(ht.features([own]), [len(y)])
        wrong += int(((net.logits(x, live)[:, 0] > 0) != (y > 0)).sum())
        total += len(y)
    assert wrong < 0.02 * total


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = ht.BiLstm.fresh(rng)
    x, live = rng.standard_normal((4, 3, ht.WIDTH)), np.ones((4, 3), bool)
    live[2:, 0] = False
    y = rng.integers(0, 2, (4, 3)).astype(float) * live

    def loss():
        z = net.logits(x, live)
        return float(((np.logaddexp(0, z) - y * z) * live).sum() / live.sum())

    grads = net.gradients(x, live, y)
    for param, grad in zip(net.params, grads):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in param.shape)
            old = param[at]
            param[at] = old + 1e-5
            up = loss()
            param[at] = old - 1e-5
            down = loss()
            param[at] = old
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-5


def test_batching_does_not_matter(net):
    rng = random.Random(4)
    pages = ["<article>" + "".join(f"<p>{rng.random()} text</p>" for _ in range(rng.randrange(0, 40))) + "</article><nav>x</nav>" for _ in range(30)]
    assert ht.main_texts(net, pages) == [ht.main_texts(net, [p])[0] for p in pages]


def test_odd_rows(spark, net):
    schema = "page_id bigint, url string, html string"
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<article><p>Some text in here, enough of it.</article>"), (3, "w", "<nav>menu</nav>"),
            (3, "w", "<nav>menu</nav>"), (4, "x", "<article>" + "<p>word, and word.</p>" * 5000 + "</article>")]
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS k", "2 AS text", "3 AS page")
    got = ht.extract(df, net, ["page_id", "url"]).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 6 and by[1] == by[2] == "" and by[None] == "Some text in here, enough of it."
    assert len(by[4].split()) > 14_000
    assert ht.page_texts(df).count() == 6
    assert ht.page_texts(spark.createDataFrame([], schema)).count() == 0
