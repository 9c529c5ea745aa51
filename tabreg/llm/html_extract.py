"""HTML extraction by wrapper induction over the pages of a host.

A page's skeleton is its tree of elements (tag and class words), runs of equal
siblings folded into one. The wrapper of a host is the skeleton most of its pages
have. Every page is aligned with it by simple tree matching (the largest number of
equal nodes that keep order and ancestry), and the text of each wrapper node is
compared over the host's pages of distinct main content: a node that has the same
text, and not an empty one, on ``CONSTANT`` of them is template, the others are
slots. A page loses its elements at a template node only where their text is that
template's. The main text of a page is the text of its slots, of template nodes that
read otherwise there, and of its nodes that the wrapper lacks, inside the article
(or main, or body), without the elements that HTML or a whole token of their class or
role marks as menus, headers, footers, sidebars, notices, adverts, forms or comments.
A joined token (``comments-section``, ``site-nav``) marks where each of its words is a mark
or names a part of a page (``PARTS``), so ``has-sidebar`` and ``search-methods`` do not; ids
mark by the same rule, but not inside an article and not a heading, paragraph or link.
Marks that also name parts of articles (``LOOSE``) do not count inside an article or
main, nor at a node where the host's pages each have a text of their own; no mark
drops an element that holds an article or main, but for lists of comments and teasers.

Three passes over the pages: skeletons (counted with partial sums), node texts
(hashes, counted), extraction. Wrappers are joined by host: broadcast while at
most ``BROADCAST_BYTES``, else shuffled, where AQE splits a hot host. No host's pages
ever meet in one task.
"""

from __future__ import annotations

import html
import json
import re
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, map_batches, write_table
from .url_filter import host

CONSTANT = 0.9           # a node is template if so many of the host's distinct pages have the same text there
MIN_PAGES = 5            # and at least so many distinct pages have the node
BROADCAST_BYTES = 64 << 20      # of wrappers that are broadcast; more are shuffled
DEPTH = 1 << 62          # levels of a skeleton: all
CELLS = 250_000          # larger sibling tables are made with arrays, and only some rows are kept

# Element and class names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg textarea math object canvas audio video".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
             "caption".split())
DROPPED = RAW | set("head title nav footer aside form button select option input label dialog menu".split())
WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
            "disqus footer menu modal nav navbar navigation newsletter notice notices pager pagination popup promo related replies "
            "reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget login signup search alert gdpr "
            "complementary contentinfo masthead toc skip".split())
OTHERS = set("comment comments disqus replies reply respond related".split())      # other articles than the page's own
LOOSE = set("alert banner login menu modal notice notices popup promo search signup skip subscribe toc widget".split())
HEADERS = set("header topbar".split())
PARTS = set("site main top bottom left right primary secondary global page post block box area section list links link bar wrapper wrap "
            "container panel row thread form buttons inner outer item body author meta bottom mobile sticky fixed floating".split())
SITE = set("site global top sticky fixed mobile".split())      # whose header is not a text's own
TEXTS = set("h1 h2 h3 h4 h5 h6 p a span b i em strong li td th dt dd sup sub".split())      # their ids name places in a text
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
P_SCOPE = set("td th li button table body article section div main aside footer header nav form blockquote dd".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
                  r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_TOKENS = re.compile(r"(?:^|\s)(?:class|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_HINT = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[a-z]+|\d+")


class Node:
    __slots__ = ("tag", "words", "marks", "ids", "kids", "drop", "slot", "holds")

    def __init__(self, tag: str, words: tuple = (), marks: frozenset = frozenset(), ids: frozenset = frozenset()):
        self.tag, self.words, self.marks, self.ids, self.kids = tag, words, marks, ids, []
        self.drop = self.slot = self.holds = False      # template text; a text of its own on each page; has an article or main

    def label(self) -> str:
        return ".".join((self.tag, *self.words))


@lru_cache(maxsize=4096)
def _words(attrs: str) -> tuple:
    found = " ".join(v.strip("\"'") for _, v in _HINT.findall(attrs))
    return tuple(sorted(w for w in set(_WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", found).lower())) if w.isalpha()))


def _named(value: str) -> set:
    """The marks that tokens name: whole ones, and joined ones of marks and ``PARTS`` only."""
    out: set = set()
    for token in html.unescape(value.strip("\"'")).split():
        parts = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower().replace("_", "-").split("-")
        named = [t for t in parts if t in WORDS or t in HEADERS and (len(parts) == 1 or not SITE.isdisjoint(parts))]
        if named and all(t in WORDS or t in HEADERS or t in PARTS or not t for t in parts):
            out.update(named)
    return out


@lru_cache(maxsize=4096)
def _marks(attrs: str) -> frozenset:
    """Marks of class and role."""
    return frozenset(t for v in _TOKENS.findall(attrs) for t in _named(v))


@lru_cache(maxsize=4096)
def _ids(attrs: str) -> frozenset:
    """Marks of the id."""
    return frozenset(t for k, v in _HINT.findall(attrs) if k.lower() == "id" for t in _named(v))


def parse(text: str) -> Node:
    """The element tree of a page: text is kept as it is written, between nodes."""
    root = Node("#root")
    stack, at = [root], 0
    pos, size = 0, len(text)
    while pos < size:
        m = _TAG.search(text, pos)
        if m is None:
            stack[-1].kids.append(text[pos:])
            break
        if m.start() > pos:
            stack[-1].kids.append(text[pos:m.start()])
        pos = m.end()
        close, name, attrs = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not name:
            if m.group().startswith("<![CDATA["):
                stack[-1].kids.append(html.escape(m.group()[9:-3], quote=False))
            continue
        name = name.lower()
        if close:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at].tag == name:
                    del stack[at:]
                    break
            continue
        if name in BLOCKS:
            _close(stack, {"p"}, P_SCOPE)
        if name in CLOSES:
            _close(stack, CLOSES[name], SCOPES[name])
        node = Node(name, _words(attrs), _marks(attrs), frozenset() if name in TEXTS else _ids(attrs)) if attrs.strip(" /") else Node(name)
        stack[-1].kids.append(node)
        if name in ("article", "main"):
            for above in reversed(stack):
                if above.holds:
                    break
                above.holds = True
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(text, pos) if not attrs.endswith("/") else None
            pos = end.end() if end else (size if not attrs.endswith("/") else pos)
        elif name not in VOID and not attrs.endswith("/"):
            stack.append(node)
    return root


def _close(stack: list, tags: set, scope: set) -> None:
    """Close the nearest open element of ``tags`` that no element of ``scope`` shields."""
    for at in range(len(stack) - 1, 0, -1):
        if stack[at].tag in tags:
            del stack[at:]
            return
        if stack[at].tag in scope:
            return


def folded(node: Node) -> list[tuple[str, list[Node]]]:
    """Runs of element children with an equal label."""
    out: list = []
    for kid in node.kids:
        if isinstance(kid, Node) and kid.tag not in RAW and kid.tag not in VOID:
            label = kid.label()
            if out and out[-1][0] == label:
                out[-1][1].append(kid)
            else:
                out.append((label, [kid]))
    return out


def skeleton(node: Node, depth: int = DEPTH) -> list:
    """Nested [label, children]; a run is described by its first element."""
    out: list = []
    todo = [(node, out, depth)]
    while todo:
        node, kids, left = todo.pop()
        for label, run in folded(node):
            kids.append([label, []])
            if left > 1:
                todo.append((run[0], kids[-1][1], left - 1))
    return out


def dumps(tree: list) -> str:
    """A skeleton of any depth as JSON."""
    out, todo = [], [tree]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            out.append("[")
            todo.append("]")
            for at in range(len(x) - 1, -1, -1):
                todo.append("]")
                todo.append(x[at][1])
                todo.append(("," if at else "") + "[" + json.dumps(x[at][0]) + ",")
    return "".join(out)


_JSON = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]]')


def loads(text: str) -> list:
    """The nested lists of ``dumps``."""
    stack: list = [[]]
    for m in _JSON.finditer(text):
        t = m.group()
        if t == "[":
            stack.append([])
        elif t == "]":
            done = stack.pop()
            stack[-1].append(done)
        else:
            stack[-1].append(json.loads(t))
    return stack[0][0]


class Shapes:
    """Numbers of child lists by skeleton: equal ones share a number, parts have smaller numbers than the whole, none is 0."""

    def __init__(self, base: Shapes | None = None):
        self.base = base
        self.own: dict = {} if base else {(): 0}
        self.first = len(base.own) if base else 0
        self.list: list = [] if base else [()]
        self.sizes: list = [] if base else [0]

    def number(self, parts: tuple) -> int:
        """Of a tuple of (label, number)."""
        at = self.base.own.get(parts) if self.base else None
        if at is None:
            at = self.own.get(parts)
        if at is None:
            at = self.own[parts] = self.first + len(self.list)
            self.list.append(parts)
            self.sizes.append(sum(1 + self.size(n) for _, n in parts))
        return at

    def size(self, number: int) -> int:
        """Nodes of the skeleton."""
        return self.base.sizes[number] if number < self.first else self.sizes[number - self.first]

    def parts(self, number: int) -> tuple:
        return self.base.list[number] if number < self.first else self.list[number - self.first]

    def pages(self, node: Node) -> dict[int, int]:
        """Numbers of the elements below a node and of the node itself, by id()."""
        out: dict[int, int] = {}
        order, todo = [], [node]
        while todo:
            one = todo.pop()
            runs = folded(one)
            order.append((one, runs))
            for _, run in runs:
                todo.extend(run)
        for one, runs in reversed(order):
            out[id(one)] = self.number(tuple((label, out[id(run[0])]) for label, run in runs))
        return out


class Kids(list):
    """The top child list of a wrapper."""
    __slots__ = ("shapes", "shape")


class Wrapper:
    """A skeleton with numbered nodes (preorder): kids are (label, number, kids, shape)."""

    def __init__(self, text: str):
        self.shapes = Shapes()
        tree = loads(text)
        order, todo = [], [("", tree)]
        while todo:
            node = todo.pop()
            order.append(node)
            todo.extend(reversed(node[1]))
        self.size = len(order) - 1
        kids, shape = {}, {}
        for number in range(self.size, -1, -1):
            own = order[number][1]
            kids[id(own)] = [(label, kids[id(k), "at"], kids[id(k)], shape[id(k)]) for label, k in own]
            kids[id(own), "at"] = number - 1
            shape[id(own)] = self.shapes.number(tuple((label, shape[id(k)]) for label, k in own))
        self.kids = Kids(kids[id(tree)])
        self.kids.shapes, self.kids.shape = self.shapes, shape[id(tree)]


@lru_cache(maxsize=256)
def wrapper(text: str) -> Wrapper:
    return Wrapper(text)


class Matching:
    """Simple tree matching of a wrapper's child lists with a page's, exact at every size and depth.

    Weights depend only on the two shapes, so each pair of shapes is matched once,
    those with smaller parts first.
    """

    def __init__(self, shapes: Shapes):
        self.shapes, self.weights = Shapes(shapes), {}

    def weight(self, kids: list, shape: int, number: int) -> int:
        """Nodes matched between a wrapper's child list and a page's."""
        found, todo = [], [(kids, shape, number)]
        while todo:
            kids, shape, number = todo.pop()
            if not shape or not number or (shape, number) in self.weights:
                continue
            self.weights[shape, number] = self.shapes.size(number) if shape == number else 0
            if shape == number:                   # the only matching of all nodes
                continue
            found.append((number, shape, kids))
            below: dict = {}
            for label, n in self.shapes.parts(number):
                below.setdefault(label, set()).add(n)
            for label, _, under, own in kids:
                todo.extend((under, own, n) for n in below.get(label, ()))
        for number, shape, kids in sorted(found, key=lambda f: f[0]):
            a, b = [(k[0], k[3]) for k in kids], self.shapes.parts(number)
            for row in self._rows(a, b):
                pass
            self.weights[shape, number] = int(row[-1])
        return self.weights.get((shape, number), 0)

    def _rows(self, a: list, b, row=None, first: int = 0):
        """Rows of the table of sibling lists: the largest weight of the first i and the first j."""
        n = len(b)
        if len(a) * n > CELLS:
            row = np.zeros(n + 1, np.int64) if row is None else row
            at: dict = {}
            for j, (label, _) in enumerate(b):
                at.setdefault(label, []).append(j)
            at = {label: (np.array(js), *np.unique([b[j][1] for j in js], return_inverse=True)) for label, js in at.items()}
            for label, shape in a[first:]:
                new = row.copy()
                if label in at:
                    js, numbers, back = at[label]
                    w = np.array([1 + self.weights.get((shape, x), 0) for x in numbers.tolist()])[back]
                    new[js + 1] = np.maximum(new[js + 1], row[js] + w)
                    np.maximum.accumulate(new, out=new)
                row = new
                yield row
            return
        row = [0] * (n + 1) if row is None else row
        for label, shape in a[first:]:
            new, best = [0], 0
            for j in range(n):
                if row[j + 1] > best:
                    best = row[j + 1]
                if b[j][0] == label:
                    w = row[j] + 1 + self.weights.get((shape, b[j][1]), 0)
                    if w > best:
                        best = w
                new.append(best)
            row = new
            yield row

    def pairs(self, kids: list, b: tuple, shape: int, number: int) -> list[tuple[int, int, int]]:
        """(i, j, weight) of matched children."""
        if shape == number:
            return [(i, i, 1 + self.shapes.size(k[3])) for i, k in enumerate(kids)]
        self.weight(kids, shape, number)
        a = [(k[0], k[3]) for k in kids]
        m, n = len(a), len(b)
        if not m or not n:
            return []
        step = 1 if m * n <= CELLS else isqrt(m)
        kept = {0: None}
        for i, row in enumerate(self._rows(a, b), 1):
            if i % step == 0:
                kept[i] = row
        zero = [0] * (n + 1)
        rows = kept if step == 1 else {}
        out, i, j = [], m, n
        while i and j:
            if i not in rows or i - 1 not in rows:
                lo = (i - 1) // step * step       # this part of the table again
                rows = {lo: kept[lo]}
                for k, row in enumerate(self._rows(a, b, kept[lo], lo), lo + 1):
                    rows[k] = row
                    if k == i:
                        break
            row, above = rows[i], zero if rows[i - 1] is None else rows[i - 1]
            if row[j] == above[j]:
                i -= 1
            elif row[j] == row[j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((i, j, 1 + self.weights.get((a[i][1], b[j][1]), 0)))
        return out[::-1]


def _match(kids: Kids, runs: list, depth: int = DEPTH) -> list[tuple[int, int, int]]:
    """(i, j, weight) of a wrapper's children and runs of a page's."""
    matching = Matching(kids.shapes)
    b = tuple((label, matching.shapes.pages(run[0])[id(run[0])]) for label, run in runs)
    return matching.pairs(kids, b, kids.shape, matching.shapes.number(b))


def align(w: Wrapper, page: Node) -> dict[int, list[Node]]:
    """Elements of a page that stand at each node of the wrapper."""
    found: dict[int, list[Node]] = {}
    matching = Matching(w.shapes)
    number = matching.shapes.pages(page)
    todo = [(w.kids, w.kids.shape, page)]
    while todo:
        kids, shape, node = todo.pop()
        runs = folded(node)
        b = tuple((label, number[id(run[0])]) for label, run in runs)
        for i, j, _ in matching.pairs(kids, b, shape, number[id(node)]):
            _, at, below, own = kids[i]
            found.setdefault(at, []).extend(runs[j][1])
            todo.extend((below, own, one) for one in runs[j][1] if below)
    return found


def blocks(root: Node, skip=lambda node, inside: False, spans: dict | None = None) -> list[str]:
    """Texts of the blocks below a node, decoded and trimmed; empty ones are left out.

    ``spans`` gets the first and the last line (not included) of each block element, by id()."""
    out: list[str] = []
    held: list[str] = []

    def flush():
        line = " ".join(html.unescape("".join(held)).split())
        if line:
            out.append(line)
        held.clear()

    todo: list = [(root, False)]
    while todo:
        kid, inside = todo.pop()
        if kid is None:
            flush()
            if spans is not None:
                spans[inside[0]] = inside[1], len(out)
        elif isinstance(kid, str):
            held.append(kid)
        elif kid.tag == "br":
            held.append(" ")
        elif not unread(kid) and not skip(kid, inside):
            inside = inside or kid.tag in ("article", "main")
            block = kid.tag in BLOCKS
            if block:
                flush()
                todo.append((None, (id(kid), len(out))))
            todo.extend((k, inside) for k in reversed(kid.kids))
    flush()
    return out


def unread(node: Node) -> bool:
    """Elements that HTML keeps out of the text; a form around an article or main is layout."""
    return node.tag in DROPPED and not (node.tag == "form" and node.holds)


def bare(node: Node, inside: bool) -> bool:
    """Template text, or marked beyond doubt."""
    return node.drop or not node.holds and node.tag not in ("body", "html") and not (
        node.marks & OTHERS if node.tag in ("article", "main") else node.marks & WORDS) <= LOOSE


def boilerplate(node: Node, inside: bool) -> bool:
    """Template text, or marked as no article text. A header with a heading inside an article is the article's own."""
    if bare(node, inside) or node.holds and not node.marks.isdisjoint(OTHERS) and node.tag not in ("body", "html", "main"):
        return True
    if node.holds or node.tag in ("article", "main", "body", "html"):
        return False
    if not inside and (not node.ids <= LOOSE | HEADERS or not node.slot and not LOOSE.isdisjoint(node.marks | node.ids)):
        return True
    if node.tag == "header":
        return not (inside and any(isinstance(k, Node) and k.tag in HEADINGS for k in _all(node)))
    return not inside and not HEADERS.isdisjoint(node.marks | node.ids)


def _all(node: Node):
    todo = [node]
    while todo:
        for k in todo.pop().kids:
            if isinstance(k, Node):
                yield k
                todo.append(k)


def roots(page: Node, skip=boilerplate) -> list[Node]:
    """Articles outside boilerplate and other articles; else main; else the page."""
    for tag in ("article", "main"):
        found, todo = [], [(page, False)]
        while todo:
            node, inside = todo.pop()
            if unread(node) or skip(node, inside):
                continue
            if node.tag == tag:
                found.append(node)
            elif node.holds:
                todo.extend((k, inside or node.tag == "main") for k in reversed(node.kids) if isinstance(k, Node))
        if found:
            return found
    return [page]


def main_text(page: Node) -> str:
    for skip in (boilerplate, bare):              # where the marks leave nothing, they tell nothing
        lines = [line for node in roots(page, skip) for line in blocks(node, skip)]
        if lines:
            break
    return "\n".join(lines)


def content(page: Node) -> list[str]:
    """What tells pages apart: the main text but for its headings, or all of it if there is nothing else."""
    found = roots(page)
    return [line for node in found for line in blocks(node, lambda n, inside: n.tag in HEADINGS or bare(n, inside))] \
        or [line for node in found for line in blocks(node, bare)]


def texts(page: Node, found: dict[int, list[Node]]) -> dict[int, int | None]:
    """Digest of the text of some elements of a page; None for an empty text."""
    spans: dict = {}
    lines = blocks(page, spans=spans)
    out = {}
    for number, nodes in found.items():
        own: list = []
        for n in nodes:
            own += blocks(n) if n.tag not in BLOCKS else lines[slice(*spans.get(id(n), (0, 0)))]
        out[number] = _digest(own) if own else None
    return out


def _digest(parts: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(parts)) - (1 << 63)


_SHAPES = pa.schema([("host", pa.string()), ("skeleton", pa.string())])
_TEXTS = pa.schema([("host", pa.string()), ("node", pa.int32()), ("text", pa.int64()), ("page", pa.int64())])
_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _shapes(batches):
    for b in batches:
        rows = [(h, dumps(skeleton(parse(t or ""))))
                for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        if rows:
            yield batch(_SHAPES, *zip(*rows))


def _texts(batches):
    for b in batches:
        rows = []
        for h, text, shape in zip(*(c.to_pylist() for c in b.columns)):
            page = parse(text or "")
            own = _digest(content(page))
            rows += [(h, number, digest, own) for number, digest in texts(page, align(wrapper(shape), page)).items()]
        if rows:
            yield batch(_TEXTS, *zip(*rows))


def _extract(batches):
    for b in batches:
        rows = []
        for page_id, url, text, shape, known in zip(*(c.to_pylist() for c in b.columns)):
            page = parse(text or "")
            if shape and known:
                found = align(wrapper(shape), page)
                constant = {c["node"]: c["text"] for c in known if c["node"] in found}
                digests = texts(page, {number: found[number] for number, digest in constant.items() if digest is not None})
                for number, digest in constant.items():
                    for node in found[number]:
                        if digest is None:
                            node.slot = True
                        elif digests[number] == digest:
                            node.drop = True
            out = main_text(page)
            rows.append((page_id, url, out, len(out)))
        if rows:
            yield batch(_OUT, *zip(*rows))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, skeleton, nodes array<struct<node, text>>) of every host of (host, html).

    Template nodes with their text's digest; with null, nodes where pages each have a text of their own.
    """
    shapes = map_batches(pages.select("host", "html"), _shapes, "host string, skeleton string")
    best = shapes.groupBy("host", "skeleton").count().groupBy("host") \
        .agg(F.max(F.struct("count", "skeleton")).alias("b")).select("host", F.col("b.skeleton").alias("skeleton"))
    best = write_table(best, "skeletons")
    joined = _with_wrapper(pages, best).select("host", "html", "skeleton")
    texts = map_batches(joined, _texts, "host string, node int, text long, page long").distinct()
    same = texts.groupBy("host", "node", "text").count()
    filled = F.when(F.col("text").isNotNull(), F.struct("count", "text"))        # an empty text is no template
    nodes = same.groupBy("host", "node").agg(F.sum("count").alias("n"), F.count("text").alias("texts"), F.max(filled).alias("top")) \
        .filter(F.col("n") >= MIN_PAGES)
    constant = F.col("top.count") >= CONSTANT * F.col("n")
    nodes = nodes.filter(constant | (F.col("texts") >= CONSTANT * F.col("n"))) \
        .select("host", F.struct("node", F.when(constant, F.col("top.text")).alias("text")).alias("one"))
    nodes = nodes.groupBy("host").agg(F.sort_array(F.collect_list("one")).alias("nodes"))
    return write_table(best.join(nodes, "host", "left"), "wrappers")


def _with_wrapper(pages: DataFrame, table: DataFrame) -> DataFrame:
    """Pages with their host's row of a written table: broadcast if its size, which is summed, is bounded."""
    size = F.length("host") + F.length("skeleton") + 64
    if "nodes" in table.columns:
        size = size + F.greatest(F.size("nodes"), F.lit(0)) * 24
    total = table.agg(F.sum(F.coalesce(size, F.lit(64)).cast("long"))).first()[0] or 0
    return pages.join(F.broadcast(table) if total <= BROADCAST_BYTES else table.hint("merge"), "host", "left")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row's whole html.

    Null and empty html: an empty text of 0 characters. Rows with a null or repeated
    page_id stay; null urls share the empty host. A host with fewer than ``MIN_PAGES``
    pages of distinct main content has no template nodes, so its pages lose only marked elements.
    Ties between skeletons go to the one last in order. Extra columns are left out.
    """
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    src = src.withColumn("host", host(F.col("url")))
    joined = _with_wrapper(src, wrappers(src))
    return map_batches(joined.select("page_id", "url", "html", "skeleton", "nodes"), _extract,
                       "page_id long, url string, text string, n_chars long")
