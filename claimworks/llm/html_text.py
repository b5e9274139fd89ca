"""Main text of web pages by composite text density.

A page becomes a tree. What is never part of an article (menus, page headers and footers, side
bars, notices, adverts, forms, scripts, styles, reader comments) is left out by element, role and
class. A class counts if all of its words are known for that (``cookie-notice``, not ``share-price``);
inside an article a word that may mean something else there (``related``) only counts on a part that
is half links. What holds most of the page's text is not left out for its class. For each node of the rest: characters C, tags T, characters LC and tags LT inside links give
the density

    C / T * log_b(C * T / (LC * LT)),   b = ln(C * LC / (C - LC) + C * LCb / Cb + e)

with LCb, Cb those of the body. A node's sum is that of its children's densities. The node with the
largest sum is the core; the least density on its path up to the body is the threshold. A core inside
an article (or else main) element grows to it; one outside stays as it is. Other branches at or over
the threshold are added, unless half of their text is links.

Each page is judged by itself, in time that grows with its length, so nothing is shuffled. Defined results: a null, empty or textless
page gives an empty text; broken markup is closed at the end; null and repeated keys give one row
per input row. The whole page is read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import extended

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|</?[a-zA-Z][^>]*\Z", re.S)
_LAST = re.compile(r"<!--.*\Z|</?[a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_TELLING = re.compile(r"class|id|role|hidden", re.I)

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup. Without a close tag of their own, scripts and styles run to the
#: end of the page, as in browsers; of the others only the tag is left out.
_RAW = set("script style noscript template iframe textarea title xmp noembed noframes".split())
_FOREIGN = set("svg math select".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
              "small span strike strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot munder "
              "mover munderover mstyle semantics annotation".split())
_DROPPED = set("nav footer aside form button dialog menu head input option fieldset audio video canvas svg select".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
#: Words of class and id names that mark what is around an article: anywhere, outside articles only, and
#: words that say nothing beside one of them.
_FURNITURE = set("ad ads advert adverts advertisement advertising sponsor sponsored sidebar nav navbar navigation breadcrumb "
                 "breadcrumbs footer masthead cookie cookies consent gdpr newsletter subscribe subscription login signup "
                 "popup modal pagination pager".split())
_COMMENTS = set("comment comments commentlist disqus replies reply respond".split())
_MAYBE = set("promo promotion banner aside menu notice notices share sharing social related recommended widget search toolbar "
             "skip alert header topbar hero logo".split())
_BESIDE = set("site page main top bottom left right global primary secondary box bar block area wrap wrapper container inner outer "
              "section list items item links link buttons button icons unit slot space text posts articles stories form the to "
              "content js".split())
_CLOSES_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                "main menu nav ol p pre section table ul".split())
_CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
#: Kinds of elements a start tag looks for around it: the nearest of a kind is kept with each node.
_KINDS = {"fence": {"foreignobject", "annotation-xml", "mtext", "desc", "article", "main", *_FOREIGN},
          "block": {"p", "button", "td", "th", "li", "article", "div", "section"},
          "list": {"li", "ul", "ol", "menu"}, "terms": {"dt", "dd", "dl"},
          "table": {"tr", "td", "th", "thead", "tbody", "table"}, "choice": {"option"}}
_KIND_OF = {"li": "list", "dt": "terms", "dd": "terms", "tr": "table", "td": "table", "th": "table", "thead": "table",
            "tbody": "table", "option": "choice"}


_CODE_END = {tag: re.compile(rf"(</){tag}[\s/>]", re.I) for tag in ("script", "style")}
_RAW_NEXT = {tag: re.compile(rf"<(/?){tag}[\s/>]", re.I) for tag in _RAW}
#: Start tags that end an unclosed drawing, formula or list of choices.
_BREAKS_OUT = (_CLOSES_P | set("b center code dd dt em i img li small span strong sub sup select".split())) - {"hr", "header"}


class Node:
    __slots__ = ("tag", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "sum", "drop", "near")

    def __init__(self, tag: str, parent: Node | None, drop: str = ""):
        self.tag, self.parent, self.parts, self.drop = tag, parent, [], drop
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        above = parent.near if parent else dict.fromkeys(_KINDS)
        kinds = [k for k, tags in _KINDS.items() if tag in tags]
        self.near = {**above, **dict.fromkeys(kinds, self)} if kinds else above


def _surrounds(tag: str, attributes: str, inside: bool) -> str:
    """Why an element is around an article rather than part of it: its element, what readers wrote, a
    name that may also be that of a layout around everything, or one that is to be judged by its
    links. Empty if it is not."""
    if tag in _DROPPED or (tag == "header" and not inside):
        return "element"
    if not _TELLING.search(attributes):
        return ""
    found = ""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in _ROLES):
            return "element"
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            kinds = {_named(token) for token in value.split()}
            if "comments" in kinds:
                return "comments"
            if "layout" in kinds or ("maybe" in kinds and not inside):
                found = "layout"
            elif "maybe" in kinds and not found and tag not in _INLINE:
                found = "maybe"
        elif name == "class" and tag in ("article", "main") and "comments" in map(_named, value.split()):
            return "comments"
    return "" if found == "layout" and inside and tag in _INLINE | {"p"} else found


def _named(token: str) -> str:
    """What one class says: all of its words have to be known."""
    words = [w for w in re.split(r"[^a-z]+", token) if w]
    for kind, known in (("comments", _COMMENTS), ("layout", _FURNITURE), ("maybe", _MAYBE)):
        if not known.isdisjoint(words) and all(w in known or w in _BESIDE or w in _FURNITURE or w in _MAYBE for w in words):
            return kind
    return ""


def _outside(node: Node, tag: str) -> Node:
    """The node around the drawing, formula or list of choices that holds ``node``; html inside a
    drawing's or a formula's own element for it belongs there."""
    fence = node.near["fence"]
    if fence is None or fence.tag not in _FOREIGN or (fence.tag == "select" and tag in _INLINE):
        return node
    return fence.parent


class _Open:
    """The open elements: the innermost, how many there are of each tag, and layouts among them."""

    def __init__(self, root: Node):
        self.node, self.count, self.layouts = root, Counter(), []

    def push(self, child: Node) -> None:
        self.node = child
        self.count[child.tag] += 1
        if child.drop == "layout":
            self.layouts.append(child)

    def back_to(self, node: Node) -> None:
        """Close everything inside ``node``."""
        while self.node is not node:
            self.count[self.node.tag] -= 1
            if self.layouts and self.layouts[-1] is self.node:
                self.layouts.pop()
            self.node = self.node.parent

    def close(self, tag: str) -> bool:
        """Close the innermost element of a tag, with all inside it."""
        if not self.count[tag]:
            return False
        up = self.node
        while up.tag != tag:
            up = up.parent
        self.back_to(up.parent)
        return True

    def inside(self) -> bool:
        return self.count["article"] + self.count["main"] > 0


def parse(page: str) -> Node:
    """The page as a tree; ``parts`` holds texts and child nodes in order."""
    root = Node("body", None)
    stack, at, end = _Open(root), 0, page.rfind(">") + 1
    while True:
        m = _TAG.search(page, at, end) if at < end else _LAST.search(page, at)
        if m is None and at < end:  # no more whole tags
            m = _LAST.search(page, end)
        text = page[at:m.start() if m else len(page)]
        if text:
            stack.node.parts.append(html.unescape(text) if "&" in text else text)
        if not m or m.re is _LAST:
            return root
        at = m.end()
        if m[0].startswith("<!--") and not m[0].endswith("-->"):
            return root
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m[1] or m[4])
        if closing:
            if not stack.close(tag) and tag == "p" or tag == "br":
                stack.node.parts.append(" ")
            continue
        if tag in _RAW:
            code = tag in ("script", "style")
            stop = (_CODE_END if code else _RAW_NEXT)[tag].search(page, at)
            if stop and (code or stop[1]):
                at = page.find(">", stop.start()) + 1 or len(page)
            elif code:
                at = len(page)
            stack.node.parts.append(" ")
            continue
        if tag in ("html", "body", "head"):
            if tag == "head":
                head = Node("head", stack.node, "element")
                stack.node.parts.append(head)
                stack.push(head)
            elif tag == "body":
                stack.back_to(root)
            continue
        _make_way(stack, tag)
        child = Node(tag, stack.node, _surrounds(tag, m[3] or m[6] or "", stack.inside()))
        stack.node.parts.append(child)
        if tag in ("article", "main") and not stack.inside() and not child.drop:
            for up in stack.layouts:  # a layout named after its side bar holds the article too
                up.drop = ""
            stack.layouts.clear()
        if tag not in _VOID and not (m[3] or "").endswith("/"):
            stack.push(child)


def _make_way(stack: _Open, tag: str) -> None:
    """Close what a start tag ends."""
    if tag in _BREAKS_OUT:
        stack.back_to(_outside(stack.node, tag))
    near = stack.node.near
    if tag in _CLOSES_P and near["block"] is not None and near["block"].tag == "p":
        stack.back_to(near["block"].parent)
    elif tag in _CLOSES_SAME:
        up = near[_KIND_OF[tag]]
        if up is not None and up.tag in _CLOSES_SAME[tag]:
            while up.parent is not None and up.parent.tag in _CLOSES_SAME[tag]:
                up = up.parent
            stack.back_to(up.parent)


def settle(root: Node) -> None:
    """Decide on what is left out by its name: parts of an article that are half links go, and a layout
    that holds most of the plain text of a page without an article stays."""
    todo, nodes = [root], []
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo.extend(p for p in node.parts if isinstance(p, Node) and p.drop not in ("element", "comments"))
    size = {}
    for node in reversed(nodes):
        chars = sum(_length(p) for p in node.parts if isinstance(p, str))
        inner = [size[id(p)] for p in node.parts if isinstance(p, Node) and id(p) in size]
        chars, links = chars + sum(c for c, _ in inner), sum(n for _, n in inner)
        size[id(node)] = (chars, chars if node.tag == "a" else links)
    chars, links = size[id(root)]
    article = any(n.tag in ("article", "main") and size[id(n)][0] for n in _walk(root))
    for node in nodes:
        own, own_links = size[id(node)]
        if node.drop == "layout" and not article and 2 * (own - own_links) > chars - links:
            node.drop = ""
        elif node.drop == "maybe" and 2 * own_links < own:
            node.drop = ""


def _walk(root: Node) -> list[Node]:
    """All nodes that are not dropped, parents first."""
    todo, out = [root], []
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(p for p in reversed(node.parts) if isinstance(p, Node) and not p.drop)
    return out


def _length(text: str) -> int:
    return len(" ".join(text.split()))


def measure(root: Node) -> list[Node]:
    nodes = _walk(root)
    for node in reversed(nodes):
        for p in node.parts:
            if isinstance(p, str):
                node.chars += _length(p)
            elif not p.drop:
                node.chars += p.chars
                node.tags += p.tags + 1
                node.link_chars += p.link_chars
                node.link_tags += p.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    body_share = root.link_chars / max(1, root.chars)
    for node in reversed(nodes):
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        if c:
            base = math.log(c * lc / max(1, c - lc) + body_share * c + math.e)
            node.density = max(0.0, c / t * math.log(max(1.0, c * t / (lc * lt))) / max(base, 1e-9))
        own = sum(_length(p) for p in node.parts if isinstance(p, str))
        node.sum = own + sum(p.density for p in node.parts if isinstance(p, Node) and not p.drop)
    return nodes


def _path(node: Node) -> list[Node]:
    out = []
    while node is not None:
        out.append(node)
        node = node.parent
    return out


def choose(root: Node) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    nodes = measure(root)
    core = max(nodes, key=lambda n: n.sum)
    path = _path(core)
    threshold = min(n.density for n in path)
    around = [n for n in path if n.tag == "article"] or [n for n in path if n.tag == "main"]
    core = around[-1] if around else core
    picked = set()
    on_path = {id(n) for n in _path(core)}
    for node in _path(core)[1:]:
        for p in node.parts:
            if isinstance(p, Node) and not p.drop and id(p) not in on_path and 0 < p.density >= threshold \
                    and p.link_chars * 2 < p.chars and p.tag not in _INLINE:
                picked.add(id(p))
    return [n for n in nodes if n is core or id(n) in picked]


def text_of(node: Node) -> str:
    """Inline parts run on; every other element starts and ends a block."""
    out, todo = [], [node]
    while todo:
        p = todo.pop()
        if isinstance(p, str):
            out.append(p)
        elif not p.drop:
            block = p.tag not in _INLINE
            todo.extend([" "] * block + p.parts[::-1] + [" "] * block)
    return " ".join("".join(out).split())


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    settle(root)
    return " ".join(t for t in map(text_of, choose(root)) if t)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` for each row of ``pages``."""
    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[key, url, "text", "n_chars"])

    plain = pages.select(F.col(key), F.col(url), F.col(page).alias("__html"))
    schema = extended(plain.select(key, url).schema, text="string", n_chars="long")
    return plain.mapInArrow(run, schema)
