"""Main text of web pages by wrapper induction.

Each host gets a wrapper: a tree with constant texts and a content slot. A few
different pages of the host (the ``EXEMPLARS`` least hashes) give the seed tree.
All pages of the host are then aligned with it by simple tree matching: two
nodes match if tag and class agree, and their children are matched in order so
that the most nodes match. Nothing is removed before. Every page sends one
small row: which texts equal the seed's, and how much varying text outside
links each element holds. Counted over the different pages of a host, a text
node that says the same in nearly all of them is template. The content slot is
found from the root downwards: the element that holds the most varying text, as
long as it holds ``SHARE`` of its parent's (``MARKED_SHARE`` if it is an article
or main element) and has no sibling of its own kind;
headlines (h1) left beside the way belong to it.

A page's text is what its node at the content slot holds, without template
texts. Tag names are only features: elements that by tag, role or class name
are never an article (navigation, forms, adverts, comments and the like) count
no varying text and are left out inside the slot; a class name speaks only if
all of its parts do ("cookie-notice", not "article-header"), and never of a
headline. Pages without a wrapper (hosts of fewer than ``LEAST_PAGES`` different
pages) and pages whose slot does not align get the same search on their own
tree. Hosts whose pages are mostly equal to each other are copies; they keep the
slot but no template texts.

Hashes alone pick the exemplars, and one row for each different page carries
the counts, so no host is gathered. Wrappers, a few kilobytes each, are
broadcast if all of them together stay below ``BROADCAST_BYTES`` (else they are
joined, where Spark splits a hot host).

Null or empty html gives an empty text; a null or broken address the host of
its own "". Very long pages are read whole; elements nested deeper than
``MAX_DEPTH`` become siblings, as in browsers, and keep their text. Ties between
elements go to the first in page order. Repeated rows give equal rows of their
own and count once; an empty table gives an empty result. Only key, address and
html are read, so other columns may have any name.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import text_batches
from tallyspan.session import materialize

EXEMPLARS = 8
#: Parts of a host's hashes whose least and greatest are candidates for exemplars.
SLOTS = 256
LEAST_PAGES = 3
BROADCAST_BYTES = 64 << 20
#: Bytes that one picked exemplar takes in a broadcast, host included.
PICK_BYTES = 128
#: Elements nested deeper become siblings.
MAX_DEPTH = 200
#: Cells of a table that keeps all its rows.
CELLS = 4_000_000
#: Share of the text that must vary between pages before equal texts count as template.
LEAST_VARYING = 0.5
#: Share of the different pages in which a template text says the same.
CONSTANT = 0.95
#: Share of its parent's varying text that a content slot holds.
SHARE = 0.6
#: The same for an article or main element.
MARKED_SHARE = 0.3

#: Elements by their role in HTML.
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("head script style noscript template nav header footer aside form button select option textarea iframe object embed svg canvas audio video dialog menu title noembed noframes".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments "
    "respond disqus share sharing social related recommended widget popup modal overlay login pagination pager toolbar".split()
)

#: Words that say nothing of their own in a class name.
GENERIC = frozenset("box block list area section wrapper wrap container inner outer item items bar slot unit holder panel group row col column top bottom left right main site page js".split())
#: Elements that hold running text and are no container of an article.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li ul ol dl dt dd table tbody tr td th figure figcaption".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"<]*"|'[^'<]*'|["'])*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")


class Node:
    """An element, or a text (tag '#'); ``boiler`` if tag, role or class name say that it is no article."""

    __slots__ = ("boiler", "children", "key", "tag", "text")

    def __init__(self, tag: str, key: str = "", boiler: bool = False, text: str = ""):
        self.tag, self.key, self.boiler, self.text = tag, key, boiler, text
        self.children: list[Node] = []


def boiler_name(names: str) -> bool:
    """Whether a class or id says boilerplate in one of its words, with all of the word's parts."""
    for word in names.split():
        parts = set(_PART.findall(word))
        if parts & NAMES and parts <= NAMES | GENERIC:
            return True
    return False


def parse(page: str) -> Node:
    """The tree of a page; missing end tags are implied as in HTML, stray ones ignored."""
    root = Node("#root")
    stack = [root]
    skipped: dict[str, int] = {}  # open elements that are too deep to hold anything
    at, end = 0, len(page)

    def add_text(raw: str) -> None:
        text = entities.unescape(raw) if "&" in raw else raw
        if text and (text.strip() or stack[-1].children):
            stack[-1].children.append(Node("#", text=text))

    def close(names: tuple[str, ...], stops: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    while at < end:
        m = _TAG.search(page, at)
        if not m:
            add_text(page[at:])
            break
        if m.start() > at:
            add_text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if skipped.get(tag):
                skipped[tag] -= 1
                continue
            close((tag,), frozenset())
            if len(stack) < MAX_DEPTH:
                skipped.clear()
            continue
        if tag in CLOSES_P:
            close(("p",), frozenset(("table", "button", "td", "th")))
        if tag in CLOSES_SELF:
            close(CLOSES_SELF[tag], frozenset(("ul", "ol", "dl", "table")))
        attrs = {a[0].lower(): (a[1] or a[2] or a[3]).lower() for a in _ATTR.findall(m[3])} if m[3] else {}
        headline = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        named = not headline and boiler_name(f"{attrs.get('class', '')} {attrs.get('id', '')}")
        node = Node(tag, attrs.get("class", ""), tag in NEVER or attrs.get("role") in ROLES or named)
        stack[-1].children.append(node)
        if tag in VOID or m[3].endswith("/"):
            continue
        if len(stack) >= MAX_DEPTH and tag not in RAW and (not node.boiler or stack[-1].boiler):
            skipped[tag] = skipped.get(tag, 0) + 1
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        stack.append(node)
    return root


class _Alignment:
    """Simple tree matching of two trees, by shapes: subtrees of equal tags, classes and children are one shape.

    What two nodes score depends on their shapes only, so it is computed once
    for a pair of shapes, however many nodes have them; equal shapes score
    their size. Of two lists of children equal shapes at the end match each
    other in some best matching, so only what is left between is compared, by
    a table up to ``CELLS``, beyond by halves in linear memory, with equal
    shapes at the start matched first.
    """

    def __init__(self, *roots: Node):
        self.of: dict[int, int] = {}
        self.size: list[int] = []
        self.held: dict[tuple[int, int], int] = {}
        known: dict[tuple, int] = {}
        for root in roots:
            for n in reversed(nodes(root)):
                shape = (n.tag, n.key, tuple([self.of[id(c)] for c in n.children]))
                number = known.setdefault(shape, len(self.size))
                if number == len(self.size):
                    self.size.append(1 + sum(self.size[c] for c in shape[2]))
                self.of[id(n)] = number

    def score(self, a: Node, b: Node) -> int:
        """The most nodes that match in order in two subtrees."""
        if a.tag != b.tag or a.key != b.key:
            return 0
        x, y = self.of[id(a)], self.of[id(b)]
        if x == y:
            return self.size[x]
        if (x, y) not in self.held:
            self.held[x, y] = 1 + self.best(a.children, b.children)
        return self.held[x, y]

    def ends(self, xs: list[Node], ys: list[Node]) -> int:
        """How many children at the end are of equal shape."""
        n, most = 0, min(len(xs), len(ys))
        while n < most and self.of[id(xs[-1 - n])] == self.of[id(ys[-1 - n])]:
            n += 1
        return n

    def starts(self, xs: list[Node], ys: list[Node]) -> int:
        n, most = 0, min(len(xs), len(ys))
        while n < most and self.of[id(xs[n])] == self.of[id(ys[n])]:
            n += 1
        return n

    def best(self, xs: list[Node], ys: list[Node]) -> int:
        total, k = 0, self.ends(xs, ys)
        if k:
            total, xs, ys = sum(self.size[self.of[id(x)]] for x in xs[-k:]), xs[:-k], ys[:-k]
        if k := self.starts(xs, ys):
            total, xs, ys = total + sum(self.size[self.of[id(x)]] for x in xs[:k]), xs[k:], ys[k:]
        return total + (self.rows(xs, ys)[-1][-1] if xs and ys else 0)

    def rows(self, xs: list[Node], ys: list[Node], keep: bool = False) -> list[array]:
        """The last row of the table, or all with ``keep``: the best scores of beginnings of both lists."""
        shapes = [self.of[id(y)] for y in ys]
        example = dict(zip(shapes, ys, strict=True))
        above = array("l", bytes(8 * (len(ys) + 1)))
        out, weights = [above], {}
        for x in xs:
            own = self.of[id(x)]
            if own not in weights:
                known = {s: self.score(x, y) for s, y in example.items()}
                weights[own] = [known[s] for s in shapes] if any(known.values()) else None
            if weights[own] is not None:
                row, left, before = array("l", [0]), 0, 0
                for weight, up in zip(weights[own], above[1:], strict=True):
                    if up > left:
                        left = up
                    if weight and before + weight > left:
                        left = before + weight
                    row.append(left)
                    before = up
                above = row
            if keep:
                out.append(above)
            else:
                out = [above]
        return out

    def pairs(self, xs: list[Node], ys: list[Node]) -> list[tuple[Node, Node]]:
        """The children that match in a best matching; of equals those nearest to the end."""
        k = self.ends(xs, ys)
        found = list(zip(xs[len(xs) - k :], ys[len(ys) - k :], strict=True))
        xs, ys = xs[: len(xs) - k], ys[: len(ys) - k]
        if len(xs) * len(ys) > CELLS:
            return found + self.halves(xs, ys)
        table, i, j = self.rows(xs, ys, True), len(xs), len(ys)
        while i and j:
            own = self.score(xs[i - 1], ys[j - 1])
            if own and table[i][j] == table[i - 1][j - 1] + own:
                i, j = i - 1, j - 1
                found.append((xs[i], ys[j]))
            elif table[i][j] == table[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return found

    def halves(self, xs: list[Node], ys: list[Node]) -> list[tuple[Node, Node]]:
        """A best matching of long lists: the first half of one meets that beginning of the other with which both halves score most."""
        found, todo = [], [(xs, ys)]
        while todo:
            a, b = todo.pop()
            k = self.starts(a, b)
            found += zip(a[:k], b[:k], strict=True)
            a, b = a[k:], b[k:]
            if not a or not b:
                continue
            if len(a) == 1:
                scores = [self.score(a[0], y) for y in b]
                if max(scores):
                    found.append((a[0], b[scores.index(max(scores))]))
                continue
            middle = len(a) // 2
            head, tail = self.rows(a[:middle], b)[-1], self.rows(a[:middle - 1 : -1], b[::-1])[-1]
            cut = max(range(len(b) + 1), key=lambda n: head[n] + tail[len(b) - n])
            todo += [(a[:middle], b[:cut]), (a[middle:], b[cut:])]
        return found


def match(a: Node, b: Node, pairs: list[tuple[Node, Node]] | None = None) -> int:
    """Simple tree matching: the most nodes of ``a`` and ``b`` that match in order; fills ``pairs``."""
    if a.tag != b.tag or a.key != b.key:
        return 0
    own = _Alignment(a, b)
    todo = [(a, b)] if pairs is not None else []
    while todo:
        p, q = todo.pop()
        pairs.append((p, q))
        todo += own.pairs(p.children, q.children)
    return own.score(a, b)


def flat(text: str) -> str:
    return " ".join(text.split())


def checksum(text: str) -> int:
    return zlib.crc32(flat(text).encode("utf-8", "surrogatepass"))


def nodes(root: Node) -> list[Node]:
    """All nodes in page order, the root first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(reversed(n.children))
    return out


def varying(root: Node, constant: set[int]) -> dict[int, int]:
    """For each element (by id) the characters of text in it, without links, boilerplate and the ``constant`` texts."""
    out: dict[int, int] = {}

    def count(n: Node) -> int:
        if n.tag == "#":
            return 0 if id(n) in constant else len(flat(n.text))
        own = 0 if n.boiler or n.tag == "a" else sum(count(c) for c in n.children)
        out[id(n)] = own
        return own

    count(root)
    return out


def _share(n: Node) -> float:
    return MARKED_SHARE if n.tag in ("article", "main") else SHARE


def choose(root: Node, volume: dict[int, float]) -> tuple[Node, list[Node]]:
    """(the content slot, the headlines left beside the way to it)."""
    at, heads = root, []
    while at.tag != "article":
        kids = [c for c in at.children if c.tag != "#" and c.tag not in INLINE and c.tag not in TEXTUAL and volume.get(id(c), 0) > 0]
        if not kids:
            break
        best = max(kids, key=lambda c: volume[id(c)] / _share(c))
        if volume[id(best)] < _share(best) * volume[id(at)] or sum(c.tag == best.tag and c.key == best.key for c in kids) > 1:
            break
        for c in at.children:
            if c is not best and volume.get(id(c), 0) > 0:
                heads += [n for n in nodes(c) if n.tag == "h1" and volume.get(id(n), 0) > 0]
        at = best
    return at, heads


def induce(pages: list[str]) -> str | None:
    """The seed of a host from some of its pages, as JSON: a tree whose texts are the checksums most of them have there; None if they are too few.

    The seed page is the one of the fewest nodes among those that have half the
    median number at least.
    """
    trees = sorted((len(nodes(t)), n, t) for n, t in enumerate(parse(p) for p in dict.fromkeys(pages)))
    if len(trees) < LEAST_PAGES:
        return None
    middle = trees[len(trees) // 2][0]
    seed = next(t for n, _, t in trees if 2 * n >= middle)
    said: dict[int, dict[int, int]] = {id(n): {checksum(n.text): 1} for n in nodes(seed) if n.tag == "#"}
    for _, _, t in trees:
        if t is not seed:
            pairs: list[tuple[Node, Node]] = []
            match(seed, t, pairs)
            for p, q in pairs:
                if p.tag == "#":
                    own = said[id(p)]
                    own[checksum(q.text)] = own.get(checksum(q.text), 0) + 1

    def dump(n: Node) -> list:
        if n.tag == "#":
            return ["#", max(said[id(n)].items(), key=lambda x: (x[1], -x[0]))[0]]
        return [n.tag, n.key, int(n.boiler), [dump(c) for c in n.children]]

    return json.dumps(dump(seed))


class Wrapper:
    """A seed tree; once its counts are known, with template texts and a content slot."""

    def __init__(self, made: str):
        held = json.loads(made)
        tree, self.decided = (held["seed"], held) if isinstance(held, dict) else (held, None)
        self.sums: dict[int, int] = {}

        def build(x: list) -> Node:
            if x[0] == "#":
                n = Node("#")
                self.sums[id(n)] = x[1]
                return n
            n = Node(x[0], x[1], bool(x[2]))
            n.children = [build(c) for c in x[3]]
            return n

        self.root = build(tree)
        self.order = nodes(self.root)
        if self.decided:
            self.constant = {id(self.order[i]) for i in self.decided["constant"]}
            self.slot = id(self.order[self.decided["slot"]])
            self.heads = {id(self.order[i]) for i in self.decided["heads"]}

    def align(self, page: Node) -> dict[int, Node]:
        """The page's node at each node of the seed that it has."""
        pairs: list[tuple[Node, Node]] = []
        match(self.root, page, pairs)
        return {id(w): n for w, n in pairs}

    def digest(self, page: str) -> tuple[list[int], int]:
        """(for each node of the seed: a text is 0 if missing, 1 if it differs, 2 if it is equal, an element has its varying text; the length of all text)."""
        tree = parse(page)
        at = self.align(tree)
        state = {k: 2 if checksum(at[k].text) == v else 1 for k, v in self.sums.items() if k in at}
        volume = varying(tree, {id(at[k]) for k, v in state.items() if v == 2})
        return [state.get(id(w), 0) if w.tag == "#" else volume.get(id(at[id(w)]), 0) if id(w) in at else 0 for w in self.order], sum(len(flat(n.text)) for n in nodes(tree) if n.tag == "#")

    def decide(self, pages: int, total: list[int], aligned: list[int], equal: list[int], length: int) -> str:
        """The wrapper as JSON from the sums of all digests; ``length`` is the text of all pages, links included."""
        volume = {id(w): float(v) for w, v in zip(self.order, total, strict=True) if w.tag != "#"}
        slot, heads = choose(self.root, volume)
        copies = volume[id(self.root)] < LEAST_VARYING * length
        constant = [i for i, w in enumerate(self.order) if not copies and w.tag == "#" and aligned[i] >= LEAST_PAGES and equal[i] >= CONSTANT * aligned[i]]
        place = {id(w): i for i, w in enumerate(self.order)}
        seed = json.loads(self.dump())
        return json.dumps({"seed": seed, "pages": pages, "constant": constant, "slot": place[id(slot)], "heads": [place[id(h)] for h in heads]})

    def dump(self) -> str:
        def one(n: Node) -> list:
            return ["#", self.sums[id(n)]] if n.tag == "#" else [n.tag, n.key, int(n.boiler), [one(c) for c in n.children]]

        return json.dumps(one(self.root))


def main_text(page: str | None, wrapper: Wrapper | None = None) -> str:
    """The article of a page, a line for each block."""
    if not page:
        return ""
    root = parse(page)
    dropped: set[int] = set()
    regions: list[Node] = []
    if wrapper:
        at = wrapper.align(root)
        dropped = {id(at[k]) for k in wrapper.constant if k in at and checksum(at[k].text) == wrapper.sums[k]}
        if wrapper.slot in at:
            chosen = {id(at[k]) for k in (*wrapper.heads, wrapper.slot) if k in at}
            regions = [n for n in nodes(root) if id(n) in chosen]
    if not regions:
        slot, heads = choose(root, varying(root, dropped))
        chosen = {id(slot), *map(id, heads)}
        regions = [n for n in nodes(root) if id(n) in chosen]
    blocks: list[str] = []
    own: list[str] = []
    fresh = False

    def end() -> None:
        nonlocal fresh
        if own and fresh and (line := flat("".join(own))):
            blocks.append(line)
        own.clear()
        fresh = False

    def walk(n: Node) -> None:
        nonlocal fresh
        for c in n.children:
            if c.tag == "#":
                own.append(c.text)
                fresh = fresh or (id(c) not in dropped and not c.text.isspace())
            elif c.boiler:
                continue
            elif c.tag == "br":
                own.append(" ")
            elif c.tag in INLINE:
                walk(c)
            else:
                end()
                walk(c)
                end()

    for top in regions:
        walk(top)
        end()
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    """Host of an address in lower case, "" if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _source(pages: DataFrame, url: str, html: str) -> DataFrame:
    return pages.filter(F.col(html).isNotNull()).select(host_of(F.col(url)).alias("host"), F.xxhash64(html).alias("h"), F.col(html).cast("string").alias("html"))


def exemplars(src: DataFrame) -> DataFrame:
    """``(host, h, html)``: up to ``EXEMPLARS`` different pages of each host, those of the least hashes.

    The least and the greatest hash of each of ``SLOTS`` parts are a small table, whatever the host.
    """
    slots = src.groupBy("host", F.pmod(F.hash("h"), F.lit(SLOTS)).alias("slot")).agg(F.min("h").alias("a"), F.max("h").alias("b"))
    few = slots.select("host", F.explode(F.array_distinct(F.array("a", "b"))).alias("h"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy("h"))
    picked = materialize(few.withColumn("r", rank).filter(F.col("r") <= EXEMPLARS).select("host", "h"), "exemplars")
    if picked.count() * PICK_BYTES <= BROADCAST_BYTES:
        picked = F.broadcast(picked)
    return src.join(picked, ["host", "h"], "left_semi").groupBy("host", "h").agg(F.min("html").alias("html"))


def _checked_broadcast(made: DataFrame) -> DataFrame:
    size = made.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    return F.broadcast(made) if size <= BROADCAST_BYTES else made


def _held(cache: dict[str, Wrapper], made: str) -> Wrapper:
    if made not in cache:
        if len(cache) > 500:
            cache.clear()
        cache[made] = Wrapper(made)
    return cache[made]


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, wrapper)`` of the hosts that have one."""
    src = _source(pages, url, html)

    def one(k: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = induce(rows.sort_values("h")["html"].tolist())
        return pd.DataFrame({"host": [k[0]] * (made is not None), "wrapper": [made] * (made is not None)}, dtype=object)

    seeds = materialize(exemplars(src).groupBy("host").applyInPandas(one, "host string, wrapper string"), "seeds")
    joined = src.join(_checked_broadcast(seeds), "host").select("host", "h", "html", "wrapper")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, Wrapper] = {}
        for b in batches:
            made = [_held(cache, w).digest(page) for page, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            cols = [pa.array([d for d, _ in made], pa.list_(pa.int32())), pa.array([n for _, n in made], pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["host", "h", "d", "length"])

    each = joined.mapInArrow(digests, "host string, h long, d array<int>, length long").groupBy("host", "h").agg(F.first("d").alias("d"), F.first("length").alias("length"))
    each = materialize(each, "digests")
    sums = each.select("host", F.posexplode("d").alias("i", "v")).groupBy("host", "i").agg(F.sum("v").alias("total"), F.count_if(F.col("v") > 0).alias("aligned"), F.count_if(F.col("v") == 2).alias("equal"))
    tables = sums.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("i", "total", "aligned", "equal"))).alias("t"))
    sizes = each.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.sum("length").alias("length"))

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [Wrapper(w).decide(n, total, aligned, equal, length) for w, n, length, total, aligned, equal in zip(*(b.column(i).to_pylist() for i in range(1, 7)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["host", "wrapper"])

    full = seeds.join(sizes, "host").join(tables, "host").select("host", "wrapper", "pages", "length", "t.total", "t.aligned", "t.equal")
    return full.mapInArrow(decided, "host string, wrapper string")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(key, url, host, text)``: the main text of every page."""
    text_batches(pages.sparkSession)
    made = materialize(wrappers(pages, url, html), "wrappers")
    src = pages.select(F.col(key).alias(key), F.col(url).alias(url), host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("__html"))
    joined = src.join(_checked_broadcast(made), "host", "left").select(key, url, "host", "__html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, Wrapper] = {}
        for b in batches:
            out = [main_text(page, None if w is None else _held(cache, w)) for page, w in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.string())], names=[key, url, "host", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return joined.mapInArrow(run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, host string, text string")
