"""Main text of web pages: gradient-boosted trees over DOM-node features and a hierarchical decoding.

Each block of a page gets a probability of being main text from its tag,
attribute tokens, depth, text and link density of its subtree and the sizes of
its siblings.  A dynamic programme over the tree then picks the labels with
the highest total evidence among those that agree with each other: below a
block that is kept, subtrees may be dropped, but nothing is kept below a
dropped one.

The trees learn from a bounded sample of the pages.  Elements that say what
they hold (article and main; navigation, footers, forms, blocks named as
adverts and so on) are the labels.  Every sampled page is also learned from in
variants whose elements and names are changed and into which side blocks are
put, so that the classifier does not lean on one site's markup.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees, fit
from .common import map_arrow, text_lists
from .dom import _TOKEN, AGAINST_TAGS, AGAINST_TOKENS, TRUTH, Page

SAMPLE_PAGES = 300
VARIANTS = 3
_TAG = re.compile(r"<(/?)([a-zA-Z][\w-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARAGRAPH = re.compile(r"<p>([^<]{20,400})", re.I)
MAIN_FORMS = [("article", ""), ("main", ""), ("div", ' class="content"'), ("div", ' class="post-body"'), ("div", ' id="main-content"'),
              ("section", ' class="entry"'), ("div", ' class="story text"'), ("div", ""), ("article", ' class="post"')]
SIDE_FORMS = ["div", "section", "aside", "ul", "p", "header", "footer", "form", "nav"]
SIDE_NAMES = sorted(AGAINST_TOKENS)


def marked(html: str) -> str:
    """``html`` with a truth attribute on elements that say whether they hold main text."""
    def mark(m):
        end, tag, attrs = m.groups()
        if end:
            return m[0]
        names = {t.lower() for g in _NAMES.findall(attrs) for t in _TOKEN.findall("".join(g))}
        if tag.lower() in AGAINST_TAGS or names & AGAINST_TOKENS:
            return f'<{tag}{attrs.rstrip("/")} {TRUTH}="0">'
        return f'<{tag}{attrs.rstrip("/")} {TRUTH}="1">' if tag.lower() in ("article", "main") else m[0]

    return _TAG.sub(mark, html)


def side_block(rng: random.Random, texts: list[str]) -> str:
    """A block that is not main text, with words of the page itself."""
    name, tag = rng.choice(SIDE_NAMES), rng.choice(SIDE_FORMS)
    name = rng.choice([name, f"site-{name}", f"{name}_box", f"{name}-{rng.randrange(9)}", f"page{name.title()}"])
    kind = rng.choice(["class", "id", "class"])
    text = lambda: rng.choice(texts) if texts else "text"
    body = rng.choice([
        lambda: text(),
        lambda: f"<p>{text()}</p>" * rng.randint(1, 4),
        lambda: "".join(f"<li><a href='/{k}'>{' '.join(text().split()[:3])}</a></li>" for k in range(rng.randint(2, 7))),
        lambda: f"<h3>{text()}</h3>" + "".join(f"<div class='comment'><b>{text()[:12]}</b><p>{text()}</p></div>" for _ in range(rng.randint(1, 4))),
        lambda: f"<label>{text()[:20]}</label><input name='q'><button>ok</button>",
    ])()
    if tag in ("nav", "footer", "aside", "form", "header") and rng.random() < 0.5:
        return f'<{tag} {TRUTH}="0">{body}</{tag}>'
    return f'<{tag} {kind}="{name}" {TRUTH}="0">{body}</{tag}>'


def variant(html: str, rng: random.Random) -> str:
    """A marked page with other elements and names and with side blocks put in."""
    texts = _PARAGRAPH.findall(html)
    new_tag, new_attrs = rng.choice(MAIN_FORMS)
    plain_sides = rng.random() < 0.6

    def change(m):
        end, tag, attrs = m.groups()
        low = tag.lower()
        if low in ("article", "main"):
            return f"</{new_tag}>" if end else f'<{new_tag}{new_attrs} {TRUTH}="1">'
        if low in ("nav", "footer", "aside", "header") and plain_sides:
            names = {"nav": "menu", "footer": "footer", "aside": "sidebar", "header": "site-header"}
            return "</div>" if end else f'<div class="{names[low]}" {TRUTH}="0">'
        return m[0]

    html = _TAG.sub(change, html)
    spots = [m.start() for m in re.finditer(rf'<p>|<h\d>|</{new_tag}>|<{new_tag}\b|</body>|<footer', html)]
    for at in sorted(rng.sample(spots, min(len(spots), rng.randint(1, 5))), reverse=True):
        html = html[:at] + side_block(rng, texts) + html[at:]
    return html


def examples(html: str, seed: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of a page and its variants; none if no element is known to hold main text."""
    base = marked(html)
    rows, labels = [], []
    for k in range(1 + VARIANTS):
        page = Page(base if k == 0 else variant(base, random.Random(f"{seed}-{k}")))
        truth = np.array([n.truth or 0 for n in page.nodes], np.int8)
        if truth.any():
            rows.append(page.features())
            labels.append(truth)
    return (np.concatenate(rows), np.concatenate(labels)) if rows else (np.zeros((0, Page("").features().shape[1])), np.zeros(0, np.int8))


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, id_col: str = "page_id", html_col: str = "html") -> BoostedTrees:
    """Learn from about ``sample_pages`` pages, chosen by a hash of id and address; only their node features reach the driver."""
    known = pages.where(F.col(html_col).isNotNull())
    share = min(1.0, sample_pages / max(1, known.count()))
    place = F.pmod(F.xxhash64(F.lit("html"), F.col(id_col), F.length(html_col)), F.lit(1_000_003)) / 1_000_003
    sample = known.where(place < share).select(F.col(id_col).cast("string").alias("seed"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seed, html in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = examples(html, seed or "")
                yield pa.RecordBatch.from_arrays([pa.array([x.astype("<f4").tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["x", "y"])

    got = map_arrow(sample, run, "x binary, y binary").collect()
    width = Page("").features().shape[1]
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), "<f4").reshape(-1, width).astype(float)
    y = np.frombuffer(b"".join(bytes(r["y"]) for r in got), np.int8).astype(float)
    return fit(x, y, trees=24, depth=5)


def decode(page: Page, p: np.ndarray) -> np.ndarray:
    """The nodes to keep: of all labellings without a kept node below a dropped one, that of the highest evidence."""
    p = np.clip(p, 1e-4, 1 - 1e-4)
    own = np.array([n.own for n in page.nodes])
    evidence = (np.log(p / (1 - p)) * (1 + np.log1p(own))).tolist()
    n = len(page.nodes)
    inside, outside = [0.0] * n, [0.0] * n
    for k in range(n - 1, -1, -1):
        kids = page.nodes[k].children
        inside[k] = evidence[k] + sum(max(0.0, inside[c]) for c in kids)
        outside[k] = sum(max(outside[c], inside[c]) for c in kids)
    keep = np.zeros(n, bool)
    state = [0] * n
    for k in range(n):
        if k:
            above = state[page.nodes[k].parent]
            if above == 0:
                state[k] = 1 if inside[k] > outside[k] else 0
            else:
                state[k] = 1 if above == 1 and inside[k] > 0 else 2
        elif inside[0] > outside[0]:
            state[0] = 1
        keep[k] = state[k] == 1
    return keep


def extract(pages: DataFrame, model: BoostedTrees, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (main text; empty if none) and n_chars (its code points).

    The whole html is read.  Null and empty html give an empty text.  Character
    references are decoded; white space is turned into single spaces; blocks
    are joined in page order by one space.  Ids and addresses may repeat or be
    null; other columns are not read; an empty table gives an empty table.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            for lo, hi, texts in text_lists(batch.column("html"), 1 << 20):
                read = [Page(t) for t in texts]
                p = trees.probability(np.concatenate([r.features() for r in read]))
                bounds = np.cumsum([0, *[len(r.nodes) for r in read]])
                out = [r.text_of(decode(r, p[a:b])) for r, a, b in zip(read, bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column("page_id").slice(lo, hi - lo), batch.column("url").slice(lo, hi - lo), pa.array(out, pa.string()),
                    pa.array(map(len, out), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return map_arrow(source, run, "page_id long, url string, text string, n_chars long")
