import html as entities
import re

import numpy as np
import pytest

from ledgerline.llm import boosting, html_main
from ledgerline.llm.dom import Page

DATA = "/root/testdata/sf0.001"
TEXT = "The river rose in the night. By dawn, the lower road had gone under water and the ferry stayed at its mooring. "


def article_text(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(entities.unescape(re.sub(r"</?b>", "", re.sub(r"<br>|</?(?:p|h1)>", " ", inner))).split())


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{DATA}/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return html_main.train(pages)


def text(model, page):
    read = Page(page)
    return read.text_of(html_main.decode(read, model.probability(read.features())))


def test_given_pages(pages, model):
    got = {r["page_id"]: r for r in html_main.extract(pages, model).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == article_text(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


@pytest.mark.parametrize("main", ['<article>%s</article>', '<div class="post-content">%s</div>', '<main id="main">%s</main>',
                                  '<section class="entry">%s</section>'])
@pytest.mark.parametrize("side", [
    '<aside class="sidebar"><p>Popular: %s</p></aside>', '<div class="cookie-notice"><p>We use cookies. %s</p></div>',
    '<div id="comments"><div class="comment"><p>%s</p></div><div class="comment"><p>%s</p></div></div>',
    '<form><label>Name</label><input><p>%s</p></form>', '<header><a href="/">Home</a></header>', '<div class="ad">%s</div>'])
def test_other_markup(model, main, side):
    block = side.replace("%s", TEXT)
    body = "".join(f"<p>{k}. {TEXT}{TEXT}</p>" for k in range(6))
    page = f"<html><body><nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li></ul></nav>{block}{main % body}{block}<footer>&copy; x</footer></body></html>"
    assert text(model, page) == " ".join(f"{k}. {TEXT}{TEXT}".strip() for k in range(6))


@pytest.mark.parametrize("tag", ["button", "video", "canvas", "object", "svg", "select", "audio", "noscript"])
def test_hidden_elements_that_are_not_closed_hide_nothing_more(model, tag):
    body = f"<article><p>{TEXT}</p><p>START <{tag}>x<p>{TEXT}</p><p>END</article>"
    got = text(model, f"<body>{body}<footer>no</footer></body>")
    assert got.startswith(TEXT.strip() + " START") and got.endswith(TEXT.strip() + " END")
    # closed elsewhere: the end of the block they stand in closes them
    split = f"<article><p>{TEXT}</p><div>A <{tag}>x</div><p>{TEXT}</p><div>B <{tag}>y</{tag}> C</div></article>"
    assert text(model, f"<body>{split}</body>") == f"{TEXT.strip()} A {TEXT.strip()} B C"


def test_formulas_are_text(model):
    page = f"<article><p>{TEXT}</p><p>Let <math><mi>x</mi><mo>+</mo><mn>1</mn></math> be.</p><p>{TEXT}</p></article>"
    assert text(model, page) == f"{TEXT.strip()} Let x+1 be. {TEXT.strip()}"


def test_white_space_references_and_hidden_elements(model):
    page = ("<body><article><h1>A &amp; B</h1><p>x\n\t y<b>bold</b>z &#233;&lt;p&gt;</p><script>var t='</p><p>no';</script><!-- no -->"
            f"<style>p{{}}</style><p>{TEXT}<br>next<p>unclosed</article></body>")
    assert text(model, page) == f"A & B x yboldz é<p> {TEXT.strip()} next unclosed"


def test_page_cases(spark, model):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "no markup at all"), (3, "w", "<p>"), (3, "w", "<p>"), (4, "x", "<<<>><a <b></div></p>"),
            (5, "y", "<div>" * 3000 + "deep" + "</div>" * 10), (6, "z", "<article><p>" + TEXT * 5000 + "</p></article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' as text", "1 as n_chars")
    got = html_main.extract(frame, model).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[3] == "" and by[6] == (TEXT * 5000).strip()
    assert html_main.extract(frame.limit(0), model).count() == 0
    assert html_main.train(frame.limit(0)).trees == []


def test_no_kept_node_below_a_dropped_one(model):
    page = Page("<body><div><article><p>a</p><aside><p>b</p></aside></article></div></body>")
    rng = np.random.default_rng(1)
    for _ in range(200):
        keep = html_main.decode(page, rng.random(len(page.nodes)))
        for k, node in enumerate(page.nodes):
            ups, up = [], node.parent
            while up >= 0:
                ups.append(bool(keep[up]))
                up = page.nodes[up].parent
            if keep[k] and True in ups:
                assert all(ups[:ups.index(True) + 1])


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    model = boosting.fit(x, y, trees=30, depth=3)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.97
    assert boosting.fit(x[:0], y[:0]).probability(x).max() < 0.5


def test_any_markup_is_read():
    import random

    rng = random.Random(1)
    parts = ["<", "<!", "<![", "<!--", "-->", "]]>", ">", "</", "<p>", "</p>", "<script>", "</script>", "<![CDATA[", "<?", "&", "&#x", "a='", '"',
             "<a href=", "text ", "<body>", "<title>", "<textarea>", "\x00", "<!DOCTYPE", "[if IE]", "<svg>", "<li>", "<table><tr><td>"]
    for _ in range(3000):
        page = Page("".join(rng.choices(parts, k=rng.randint(1, 14))))
        assert len(page.features()) == len(page.nodes)
        page.text_of([True] * len(page.nodes))
    page = Page("<body><p>a<![if IE]>b<![endif]>c</p>")
    assert page.text_of([True] * len(page.nodes)) == "abc"
