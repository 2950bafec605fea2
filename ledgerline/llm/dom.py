"""A forgiving HTML reader for main-text extraction: block nodes, their text in page order, node features."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np

# Elements by how HTML treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style head title template noscript svg iframe object canvas select textarea button audio video".split())
# hidden elements that other markup may stand in; where none is closed any more, they hide nothing
OPEN_HIDDEN = frozenset("noscript svg object canvas select button audio video".split())
INLINE = frozenset(("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
                    "strong sub sup time tt u var math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover "
                    "mspace mstyle mpadded mphantom menclose semantics annotation").split())
SCOPES = frozenset("body article section main div nav aside header footer form table td th ul ol dl blockquote figure fieldset".split())
SELF_CLOSING = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
                "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
# Tokens of class, id and role attributes that speak for and against main text.
FOR_TOKENS = frozenset("article content main post entry story body text prose blog paragraph".split())
AGAINST_TOKENS = frozenset((
    "nav navigation navbar menu menubar header masthead topbar footer bottom sidebar side aside rail ad ads adbox advert adverts advertisement "
    "sponsor sponsored promo promotion banner notice notices cookie cookies consent gdpr privacy alert warning popup modal overlay newsletter "
    "subscribe subscription signup login register form search comment comments commentlist reply replies respond discussion disqus feedback "
    "share sharing social follow related recommended recommendations more popular trending breadcrumb breadcrumbs pagination pager widget "
    "toolbar copyright legal disclaimer terms tags tagcloud skip hidden utility links").split())
COMMENT_TOKENS = frozenset("comment comments commentlist reply replies respond discussion disqus feedback".split())
AGAINST_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
KINDS = ["article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "table", "td", "nav", "header", "footer", "aside",
         "form", "blockquote", "pre", "figure", "body"]
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_CLOSING = re.compile("</(" + "|".join(sorted(OPEN_HIDDEN)) + r")(?=[\s/>])", re.I)
TRUTH = "data-truth"


@dataclass
class Node:
    """A block, or an inline element that has attribute tokens."""

    tag: str
    parent: int
    depth: int
    place: int
    tokens: frozenset = frozenset()
    truth: int | None = None
    children: list[int] = field(default_factory=list)
    own: int = 0
    text: int = 0
    linked: int = 0
    stops: int = 0
    commas: int = 0
    paragraphs: int = 0
    blocks: int = 0
    links: int = 0


class Page(HTMLParser):
    """Nodes of a page in page order (``nodes[0]`` is the whole page) and its text parts by node."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("html", -1, 0, 0)]
        self.parts: list[tuple[int, str]] = []
        self.stack: list[tuple[str, int]] = [("html", 0)]
        self.hidden = 0
        self.in_link = 0
        # end tags of such elements that are still to come
        self.closing = Counter(t.lower() for t in _CLOSING.findall(html))
        self.feed(html)
        self.close()
        self._sum()

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in ("br", "hr") and not self.hidden:
                self.parts.append((-1, " "))
            return
        if tag in OPEN_HIDDEN and not self.closing[tag]:
            return  # it is never closed: what follows is text
        if tag in HIDDEN:
            self.stack.append((tag, -1))
            self.hidden += 1
            return
        if self.hidden:
            if tag != "body":
                self.stack.append((tag, -2))
                return
            while self.hidden:
                self._pop()
        if tag in ("html", "body"):
            if tag == "body" and len(self.stack) == 1:
                self._open(tag, attrs)
            return
        if tag not in INLINE:
            self._imply_ends(tag)
        if tag in INLINE:
            if tag == "a":
                self.in_link += 1
                self.nodes[self.stack[-1][1]].links += 1
            if not any(k in ("class", "id", "role", TRUTH) for k, _ in attrs):
                self.stack.append((tag, self.stack[-1][1]))
                return
        self._open(tag, attrs)

    def _imply_ends(self, tag):
        closes = SELF_CLOSING.get(tag)
        for k in range(len(self.stack) - 1, 0, -1):
            open_tag = self.stack[k][0]
            if open_tag == "p" or closes and open_tag in closes:
                while len(self.stack) > k:
                    self._pop()
                return
            if open_tag in SCOPES:
                return

    def _open(self, tag, attrs):
        parent = self.stack[-1][1]
        up = self.nodes[parent]
        tokens, truth = [], None
        for k, v in attrs:
            if k in ("class", "id", "role") and v:
                tokens += [t.lower() for t in _TOKEN.findall(v)]
            elif k == TRUTH:
                truth = int(v)
        node = Node(tag, parent, up.depth + 1, len(up.children), frozenset(tokens), truth if truth is not None else up.truth)
        up.children.append(len(self.nodes))
        self.stack.append((tag, len(self.nodes)))
        self.nodes.append(node)
        if tag not in INLINE:
            self.parts.append((-1, " "))

    def _pop(self):
        tag, node = self.stack.pop()
        if tag in HIDDEN and node == -1:
            self.hidden -= 1
        elif node >= 0:
            if tag == "a":
                self.in_link -= 1
            if tag not in INLINE:
                self.parts.append((-1, " "))

    def handle_endtag(self, tag):
        if tag in OPEN_HIDDEN and self.closing[tag]:
            self.closing[tag] -= 1
        for k in range(len(self.stack) - 1, 0, -1):
            open_tag, node = self.stack[k]
            if open_tag == tag:
                while len(self.stack) > k:
                    self._pop()
                return
            # the end of a block closes what is left open in it, hidden elements too, but for those that hold raw text
            if tag in INLINE and open_tag in SCOPES or tag == "p" and open_tag in SCOPES:
                return
            if node == -1 and (open_tag not in OPEN_HIDDEN or tag not in SCOPES):
                return

    def handle_data(self, data):
        if self.hidden:
            return
        node = self.stack[-1][1]
        self.parts.append((node, data))
        n = len(data.strip())
        if n:
            at = self.nodes[node]
            at.own += n
            at.stops += data.count(".") + data.count("!") + data.count("?")
            at.commas += data.count(",")
            if self.in_link:
                at.linked += n

    def parse_marked_section(self, i, report=1):
        """A declaration in brackets is a comment up to the next ``>``, whatever it holds."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def unknown_decl(self, data):
        pass

    def _sum(self):
        for node in self.nodes:
            node.text += node.own
        for k in range(len(self.nodes) - 1, 0, -1):
            node = self.nodes[k]
            up = self.nodes[node.parent]
            up.text += node.text
            up.linked += node.linked
            up.stops += node.stops
            up.commas += node.commas
            up.links += node.links
            up.paragraphs += node.paragraphs + (node.tag == "p")
            up.blocks += node.blocks + 1

    def features(self) -> np.ndarray:
        """One row per node: tag, attribute tokens of the node and above it, depth, subtree density, siblings."""
        nodes, total = self.nodes, max(1, self.nodes[0].text)
        above_for, above_against, above_tags, above_comment = [0], [0], [0], [0]
        out = np.zeros((len(nodes), len(KINDS) + 24))
        kinds = {t: i for i, t in enumerate(KINDS)}
        for k, n in enumerate(nodes):
            pros, cons = len(n.tokens & FOR_TOKENS), len(n.tokens & AGAINST_TOKENS)
            comment = bool(n.tokens & COMMENT_TOKENS)
            bad = n.tag in AGAINST_TAGS
            good = n.tag in ("article", "main")
            if k:
                up = n.parent
                above_for.append(above_for[up] + pros + good)
                above_against.append(above_against[up] + cons)
                above_tags.append(above_tags[up] + bad)
                above_comment.append(above_comment[up] + comment)
                parent = nodes[up]
                siblings, parent_text = len(parent.children), max(1, parent.text)
                before = nodes[parent.children[n.place - 1]].text if n.place else 0
                after = nodes[parent.children[n.place + 1]].text if n.place + 1 < siblings else 0
            else:
                siblings, parent_text, before, after = 1, total, 0, 0
            text = max(1, n.text)
            if n.tag in kinds:
                out[k, kinds[n.tag]] = 1
            out[k, len(KINDS):] = (
                pros, cons, comment, bad, above_for[k], above_against[k], above_tags[k], above_comment[k], n.depth, k / len(nodes),
                n.place, siblings, n.text, n.own, n.text / total, n.text / parent_text, n.linked / text, n.links / text * 100,
                n.stops / text * 100, n.commas / text * 100, n.paragraphs, n.text / (n.blocks + 1), before, after)
        return out

    def text_of(self, keep: np.ndarray) -> str:
        """Text of the kept nodes in page order; blocks are parted by one space."""
        return " ".join("".join([t for k, t in self.parts if k < 0 or keep[k]]).split())
