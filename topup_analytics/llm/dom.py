"""The parts of an HTML page that may hold text, with what an extractor measures of them.

A page becomes a tree of nodes (block elements, inline elements whose names say what they are, and
runs of text directly inside containers) and a list of text blocks whose pieces belong to nodes.
Nothing recurses, and every step looks only at the ends of its stacks, so a page of any
size or depth takes time in proportion.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np

#: Elements of HTML by the way they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe noembed noframes textarea title xmp".split())
SKIPPED = frozenset("audio button canvas datalist head math object select svg template video".split())
HEAD = frozenset("base link meta noscript script style template title".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 pre figcaption dt summary caption address legend".split())
CONTAINERS = frozenset(
    "article aside blockquote body center dd details dialog dir div dl fieldset figure footer form header hgroup "
    "html li main menu nav ol search section table tbody td tfoot th thead tr ul".split()
)
BLOCKS = PLAIN | CONTAINERS
#: What a start tag closes, and what it does not look beyond.
_SCOPE = ("table", "td", "th", "caption", "button", "object", "template")
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", *_SCOPE)),
    "dt": (("dt", "dd"), ("dl", *_SCOPE)),
    "dd": (("dt", "dd"), ("dl", *_SCOPE)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}

#: Words in the names of elements (tag, class, id, role) and the part of a page that they speak of.
WORDS_OF = {
    "content": "article content post entry story main body prose articlebody blogpost",
    "menu": "nav menu navigation navbar breadcrumb breadcrumbs toc pagination pager tabs skip",
    "header": "header masthead topbar logo branding tagline",
    "footer": "footer copyright colophon legal contentinfo bottom",
    "side": "sidebar aside complementary widget widgets related recommended trending popular rail teaser",
    "advert": "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner",
    "notice": "cookie cookies consent gdpr notice notification alert alertdialog popup modal overlay paywall dialog toast disclaimer",
    "form": "form search searchbox login signin signup register subscribe subscription newsletter",
    "comment": "comment comments commentlist disqus reply replies respond discussion feedback reviews",
    "share": "share sharing social follow toolbar print",
    "hidden": "hidden offscreen",
}
GROUPS = list(WORDS_OF)
_GROUP_OF = {word + more: i for i, group in enumerate(GROUPS) for word in WORDS_OF[group].split() for more in ("", "s")}
#: Groups of tags that a feature stands for.
KINDS = ["p", "h1", "h2 h3 h4 h5 h6", "ul ol menu dir dl", "li dt dd", "table tbody thead tfoot tr td th caption", "blockquote pre"]
KINDS += ["div section center", "article main", "nav", "header hgroup", "footer", "aside", "form fieldset", "figure figcaption", "#text"]
_KIND_OF = {tag: i for i, tags in enumerate(KINDS) for tag in tags.split()}

_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>]*+))?+"""
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)>", re.ASCII)
_NAMED = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""", re.ASCII)
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
_COMMENT_END = re.compile(r"-?>|.*?--!?>", re.DOTALL)
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _bits(tag: str, attributes: str) -> int:
    """A bit for each group that the element's names speak of."""
    found = 0
    if tag in _GROUP_OF:
        found |= 1 << _GROUP_OF[tag]
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return found
    for name, a, b, c in _NAMED.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role", "itemprop"):
            for word in _NAME_PARTS.findall(value):
                if word.lower() in _GROUP_OF:
                    found |= 1 << _GROUP_OF[word.lower()]
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _INVISIBLE.search(value)):
            found |= 1 << GROUPS.index("hidden")
    return found


@dataclass
class Page:
    """Nodes in the order of their start, each with its parent (a smaller number), and text blocks.

    Node 0 is the page itself. ``blocks`` holds lists of (node, text).
    """

    parent: list[int] = field(default_factory=lambda: [0])
    kind: list[int] = field(default_factory=lambda: [-1])
    bits: list[int] = field(default_factory=lambda: [0])
    end: list[int] = field(default_factory=lambda: [0])
    chars: list[int] = field(default_factory=lambda: [0])
    words: list[int] = field(default_factory=lambda: [0])
    linked: list[int] = field(default_factory=lambda: [0])
    marks: list[int] = field(default_factory=lambda: [0])
    blocks: list[list[tuple[int, str]]] = field(default_factory=list)

    def add(self, parent: int, kind: int, bits: int) -> int:
        self.parent.append(parent)
        self.kind.append(kind)
        self.bits.append(bits)
        self.end.append(0)
        for counts in (self.chars, self.words, self.linked, self.marks):
            counts.append(0)
        return len(self.parent) - 1


class _Reader:
    """Builds the tree of a page from its tags and texts."""

    def __init__(self):
        self.page = Page()
        self.tags: list[str] = []
        self.nodes: list[int] = []
        self.where: dict[str, list[int]] = defaultdict(list)
        self.block_at: list[int] = []
        self.skipped = 0
        self.node = 0
        self.run: list[tuple[int, str]] = []
        self.loose: dict[int, int] = {}

    def _last(self, tags) -> int:
        return max((self.where[t][-1] for t in tags if self.where[t]), default=-1)

    def _pop_to(self, place: int) -> None:
        """Closes open elements down to, and with, the one at ``place``."""
        while len(self.tags) > place:
            tag, node = self.tags.pop(), self.nodes.pop()
            self.where[tag].pop()
            if self.block_at and self.block_at[-1] == len(self.tags):
                self.block_at.pop()
                self.flush()
            if tag in SKIPPED:
                self.skipped -= 1
            self.node = self.nodes[-1] if self.nodes else 0
            if node != self.node:
                self.page.end[node] = len(self.page.parent)

    def flush(self) -> None:
        """Ends a text block."""
        if self.run:
            self.page.blocks.append(self.run)
        self.run, self.loose = [], {}

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            self._pop_to(self.where["head"][-1] if self.where["head"] else len(self.tags))
            self.flush()
            return
        if self.where["head"] and tag not in HEAD:
            self._pop_to(self.where["head"][-1])
        if tag in BLOCKS or tag == "hr":
            paragraph = self._last(("p",))
            if paragraph >= 0 and paragraph > self._last(_SCOPE):
                self._pop_to(paragraph)
            self.flush()
        if tag in _CLOSES:
            inner, outer = _CLOSES[tag]
            place = self._last(inner)
            if place >= 0 and place > self._last(outer):
                self._pop_to(place)
        elif tag == "a" and self.where["a"]:
            self.end("a")
        if tag in VOID:
            if tag == "br" and not self.skipped:
                self.run.append((self.node, " "))
            return
        node = self.node
        if not self.skipped and tag not in SKIPPED:
            bits = _bits(tag, attributes)
            if tag in BLOCKS or bits:
                node = self.page.add(self.node, _KIND_OF.get(tag, -1), bits)
        self.where[tag].append(len(self.tags))
        if tag in BLOCKS:
            self.block_at.append(len(self.tags))
        self.tags.append(tag)
        self.nodes.append(node)
        self.skipped += tag in SKIPPED
        self.node = node

    def end(self, tag: str) -> None:
        places = self.where.get(tag)
        if not places:
            if tag == "p":
                self.flush()
            return
        place = places[-1]
        if tag in BLOCKS or tag in SKIPPED:
            if tag in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "caption") or place > self._last(("td", "th", "caption")):
                self._pop_to(place)
        elif not self.block_at or place > self.block_at[-1]:
            self._pop_to(place)

    def text(self, text: str) -> None:
        if self.skipped:
            return
        if "&" in text:
            text = html.unescape(text)
        words = len(text.split())
        if not words:
            self.run.append((self.node, text))
            return
        page, node = self.page, self.node
        block = self.block_at[-1] if self.block_at else -1
        # Text directly in a container is a node of its own: its neighbours may be something else.
        if node == 0 or block >= 0 and self.nodes[block] == node and self.tags[block] in CONTAINERS:
            node = self.loose.get(node) or self.loose.setdefault(node, page.add(node, _KIND_OF["#text"], 0))
            page.end[node] = len(page.parent)
        page.chars[node] += len(text)
        page.words[node] += words
        page.marks[node] += sum(map(text.count, ".,;:!?"))
        if self.where["a"]:
            page.linked[node] += len(text)
        self.run.append((node, text))


def parse(text: str) -> Page:
    """Reads a whole page, however broken."""
    reader, at, n = _Reader(), 0, len(text)
    while at < n:
        tag = text.find("<", at)
        if tag < 0:
            reader.text(text[at:])
            break
        following = text[tag + 1 : tag + 2]
        if not (following.isascii() and following.isalpha()) and following not in ("/", "!", "?"):
            reader.text(text[at : tag + 1])
            at = tag + 1
            continue
        if tag > at:
            reader.text(text[at:tag])
        if text.startswith("<!--", tag):
            close = _COMMENT_END.match(text, tag + 4)
            at = close.end() if close else n
            continue
        found = _TAG.match(text, tag)
        if found:
            at = found.end()
            name = found[2].lower()
            if found[1]:
                reader.end(name)
            elif name in RAW:
                if reader.where["head"] and name not in HEAD:
                    reader.start("body", "")
                close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE | re.ASCII).search(text, at)
                if not close:
                    break
                at = text.find(">", close.end()) + 1 or n
            else:
                reader.start(name, found[3])
        elif following in "!?" or following == "/" and not text[tag + 2 : tag + 3].isalpha():
            at = text.find(">", tag) + 1 or n
        else:
            break  # the page ends inside a tag
    reader._pop_to(0)
    reader.flush()
    page = reader.page
    page.end[0] = len(page.parent)
    return page


def features(page: Page) -> np.ndarray:
    """What is measured of every node: density of its subtree, names, depth, siblings, parent and place in the page."""
    n = len(page.parent)
    parent, end = np.array(page.parent), np.array(page.end)
    kind, bits = np.array(page.kind), np.array(page.bits)
    start = np.arange(n)

    def subtree(values) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(values)))
        return upto[end] - upto[start]

    own = np.array(page.chars)
    chars, words, linked, marks = subtree(own), subtree(page.words), subtree(page.linked), subtree(page.marks)
    before = np.concatenate(([0], np.cumsum(own)))[:n]
    depth, above = np.zeros(n), np.zeros(n, dtype=np.int64)
    previous, following, rank = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n)
    siblings, last = np.zeros(n), {}
    for i in range(1, n):
        p = page.parent[i]
        depth[i] = depth[p] + 1
        above[i] = above[p] | page.bits[p]
        if p in last:
            previous[i], rank[i] = last[p], rank[last[p]] + 1
            following[last[p]] = i
        last[p] = i
        siblings[p] += 1
    children = siblings[parent]
    link_share = linked / np.maximum(chars, 1)
    mark_share = marks / np.maximum(words, 1)
    size = np.log1p(chars)
    # Siblings of the same kind, the node itself among them.
    family = np.unique(parent * (len(KINDS) + 1) + kind + 1, return_inverse=True)[1]
    alike = np.bincount(family)[family]
    usual = (np.bincount(family, weights=size) / np.bincount(family))[family]
    nodes = end - start
    plain = subtree((kind >= 0) & (kind <= 2))
    columns = [
        depth, size, np.log1p(own), link_share, np.log1p(words), mark_share, np.log1p(nodes), np.log1p(chars / nodes),
        plain / nodes, chars / max(1, chars[0]), before / max(1, chars[0]), rank / np.maximum(children, 1), np.log1p(children),
        chars / np.maximum(chars[parent], 1), np.where(previous > 0, size[previous], -1), np.where(previous > 0, link_share[previous], -1),
        np.where(following > 0, size[following], -1), np.where(following > 0, link_share[following], -1), usual, np.log1p(alike),
        link_share[parent], size[parent], mark_share[parent], (chars[parent] / max(1, chars[0])),
    ]
    columns += [kind == i for i in range(len(KINDS))]
    columns += [kind[parent] == i for i in range(len(KINDS))]
    columns += [bits >> i & 1 for i in range(len(GROUPS))]
    columns += [above >> i & 1 for i in range(len(GROUPS))]
    columns += [subtree(bits >> i & 1) > 0 for i in range(len(GROUPS))]
    return np.stack([np.asarray(c, dtype=np.float64) for c in columns], axis=1)


def kept_nodes(page: Page, log_odds: np.ndarray) -> list[bool]:
    """The nodes that more likely than not hold main text.

    ``log_odds`` are those of a node whose parent holds main text. The product of the chances along its path
    is the chance of a node, and falls from parent to child: no node is kept below one that is not.
    """
    chance = (1 / (1 + np.exp(-log_odds))).tolist()
    chance[0] = 1.0
    for i in range(1, len(chance)):
        chance[i] *= chance[page.parent[i]]
    return [c > 0.5 for c in chance]


def text_of(page: Page, kept: list[bool]) -> str:
    """The text of the kept nodes, a line for each block."""
    lines = (" ".join("".join(t for node, t in block if kept[node]).split()) for block in page.blocks)
    return "\n".join(line for line in lines if line)
