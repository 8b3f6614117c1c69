"""HTML extraction by wrapper induction.

Every page of a host is aligned by simple tree matching (the order-preserving
matching with most nodes) with the host's reference pages: up to ``REFERENCES``
distinct pages chosen by their hash, so that the result does not depend on file
order or splits. A page shows a reference's text if its partner of that node
holds the same text. Tasks count the pages that show it; the counts of all tasks are added up per host.
Nodes whose text is constant on at least ``share`` of the host's pages (with
``least_pages`` pages or more) become the template; the other nodes are slots
whose content varies. A slot is a node of a reference, so siblings with one
label are slots of their own: varying text is added up at the node of each
reference that its element, or the nearest matched element around, is aligned
with. From the page's root the content slot is found by going down to the one
child that holds ``DESCEND`` of a node's varying text, as far as that is a
container (``CONTAINERS`` with blocks inside), not below an ``article`` or
``main``, and not past a node that shows varying headings or text of its own on
half of the pages. The host's wrapper uses the reference whose slot holds most.

To extract a page it is aligned with that reference: the partner of the content
slot is the page's content element. Pages with an ``article`` or ``main`` keep
to those of them that lie in it (to all of them, if none does); pages without a
partner, hosts of fewer than ``least_pages`` pages, and pages that align badly
(under half of their elements, and under half of their text in the partner) are
read whole. The text is that of the blocks in the content element, without
template nodes and without furniture: navigation, headers, footers, sidebars,
notices, adverts, forms, reader comments, scripts and styles. Character
references are decoded, white space inside a block is one space, blocks are
joined by an empty line.

References and wrappers come to the pages by a join on the host; both tables
are written first, so Spark broadcasts one only when its size is below the
session's limit, and otherwise splits the rows of a hot host.

A host may hold many captures of one page, alike but for a date. A reference
that shows ``ALIKE`` of a page's text or more says nothing about what is
template, so it is not counted for that page. And where the template would
take more than half of the text of a page's content element, it does not hold
within that element: what most of a page consists of is not its frame.

Elements may be nested to any depth. Of two sibling lists with more than
``PAIRS`` pairs left between equal ends, siblings whose subtree shape is unique
in both are matched first (a longest increasing run of them), and in a gap of
still more pairs siblings are paired in order by label, which is linear but
may miss the matching with most nodes.

Defined results: a null or empty page gives an empty text; markup cut off
anywhere is read as far as it goes; pages without a host form a
host of their own; repeated rows each get their result; a tie between references
goes to the one with the smaller hash; only the id, url and html columns
are read.
"""

from __future__ import annotations

import html as entities
import json
import re
import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .url_filter import host_of

SHARE = 0.8
LEAST_PAGES = 5
ALIKE = 0.9  # of a page's text in a reference: then they are captures of one page
PAIRS = 2_500  # of siblings that are matched by a full table
SPELLED = 64  # levels of an element path that are spelled out; below, a path is a digest
HELD = 32 << 20  # characters of reference pages that a task keeps; the counts of older hosts are sent on
REFERENCES = 5  # pages of a host that all its pages are aligned with
SLOTS = 16
DESCEND = 0.8  # of a node's varying text in one child: then the content lies in that child
CONTAINERS = frozenset("html body div section center table tbody tr td main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
# Content that is not markup, up to its end tag; without one the first three run to the end of the page, as in
# browsers, and of the others nothing is skipped.
_RAW = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*+>", re.I) for x in ("script", "style", "textarea", "noscript", "template", "iframe")}
_TO_END = frozenset("script style textarea".split())
_MARKED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark math object q s samp select small span "
    "strike strong sub sup svg time tt u var wbr".split()
)
FURNITURE = frozenset("nav footer aside form button dialog menu fieldset title svg select".split())
_FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|banners?|promos?|sponsor(?:ed|s)?|sidebars?|menus?|nav|navbar|navigation|"
    r"breadcrumbs?|cookies?|consent|notices?|alerts?|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|"
    r"recommended|footers?|masthead|popups?|modals?|overlay|newsletter|subscribe|subscription|signup|login|search|pagination|"
    r"pager|widgets?|toolbar|contentinfo|complementary|site-header|page-header|topbar|header)(?:$|[\s_-])", re.I,
)
# An opening tag that ends an open element: a block ends a paragraph, an item ends an item.
HEAD = frozenset("base link meta title".split())
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table article section div main body html aside nav footer header form blockquote".split())
# Drawings and formulas hold elements of their own; these HTML elements end one that was left open.
FOREIGN = frozenset("svg math".split())
_INTEGRATION = frozenset("foreignobject annotation-xml".split())
_BREAKOUT = frozenset(
    "article aside blockquote body center dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr li main "
    "menu nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
_CHOICE = frozenset("option optgroup hr button selectedcontent".split())  # what keeps an open select open, beside inline elements


class Node:
    __slots__ = ("label", "tag", "kids", "items", "furniture", "inline", "shape", "up", "path", "level", "main", "head", "foreign", "choice")

    def __init__(self, tag: str, label: str, furniture: bool, inline: bool = False, up: "Node | None" = None):
        self.tag, self.label, self.furniture, self.inline, self.up = tag, label, furniture, inline, up
        # the path of block elements, the outermost article or main around, whether in the page's head
        self.path, self.level, self.main, self.head = (up.path, up.level, up.main, up.head) if up else ("", 0, None, 0)
        if up and not inline:
            self.level += 1
            self.path = f"{up.path}/{label}" if self.level <= SPELLED else f"#{xxhash.xxh64_hexdigest(up.path + '/' + label)}"
        if self.main is None and tag in ("article", "main"):
            self.main = self
        # where on the stack of open elements the outermost drawing, select and head around are (0: none)
        self.foreign, self.choice = (up.foreign, up.choice) if up else (0, 0)
        self.kids: list[Node] = []  # elements
        self.items: list = []  # elements and texts, in order
        self.shape = None

    def opened(self, at: int) -> None:
        """The element stands at ``at`` on the stack."""
        self.foreign = self.foreign or (at if self.tag in FOREIGN else 0)
        self.choice = self.choice or (at if self.tag == "select" else 0)
        self.head = self.head or (at if self.tag == "head" else 0)


def _attributes(text: str) -> tuple[str, str]:
    """The first class name, and all of class, id and role."""
    if "=" not in text:
        return "", ""
    name, marks = "", []
    for key, a, b, c in _MARKED.findall(text):
        value = a or b or c
        marks.append(value)
        if key.lower() == "class" and value.split():
            name = value.split()[0]
    return name, " ".join(marks)


def parse(page: str) -> Node:
    """DOM tree of a page, forgiving as browsers are: implied end tags, stray end tags, unclosed elements."""
    root = Node("#page", "#page", False)
    stack, last, unclosed = [root], 0, set()
    while m := _MARKUP.search(page, last):
        if m.start() > last:
            stack[-1].items.append(page[last : m.start()])
        last = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        closed = (m[3] or "").endswith("/")
        if tag in _RAW and not (m[1] or m[4]) and (tag in _TO_END or not closed and tag not in unclosed):
            if after := _RAW[tag].search(page, last):
                last = after.end()
                continue
            if tag in _TO_END:
                last = len(page)
                break
            unclosed.add(tag)
        if m[1] or m[4]:  # an end tag closes down to its element, if that is open
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag in INLINE and not stack[i].inline or tag == "p" and stack[i].tag in _SCOPE:
                    break
            continue
        foreign = stack[-1].foreign
        if foreign and tag in _BREAKOUT and not any(x.tag in _INTEGRATION for x in stack[foreign:]):
            del stack[foreign:]
            foreign = 0
        choice = stack[-1].choice
        if choice and tag in _CHOICE:
            if tag in ("option", "optgroup", "hr") and stack[-1].tag == "option":
                stack.pop()
        elif choice and tag not in INLINE:
            del stack[choice:]
            choice = 0
        if not foreign and tag not in HEAD and stack[-1].head:
            del stack[stack[-1].head :]
        if tag not in INLINE and not foreign and not choice:
            ends = _ENDS.get(tag, ("p",)) if tag not in ("html", "head", "body") else ()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends or stack[i].tag == "p" and tag != "td":
                    del stack[i:]
                    break
                if stack[i].tag in _SCOPE:
                    break
        name, marks = _attributes(m[3] or m[6] or "")
        inside = stack[-1].furniture
        own = tag in FURNITURE or bool(marks) and tag not in ("html", "body", "main", "article") and bool(_FURNITURE.search(marks))
        if tag == "header" and not stack[-1].main:
            own = True
        node = Node(tag, f"{tag}.{name}" if name else tag, inside or own, tag in INLINE or foreign > 0 or choice > 0, stack[-1])
        stack[-1].items.append(node)
        stack[-1].kids.append(node)
        if tag not in VOID and not closed:
            node.opened(len(stack))
            stack.append(node)
    if last < len(page):
        stack[-1].items.append(page[last:])
    return root


def _clean(parts: list[str]) -> str:
    text = "".join(parts)
    return " ".join((entities.unescape(text) if "&" in text else text).split())


def blocks(root: Node) -> Iterator[tuple[str, Node]]:
    """Text blocks in page order: text and the block's element."""
    todo: list = [root]
    parts: list[str] = []
    owner = root

    def end():
        text = _clean(parts) if parts else ""
        parts.clear()
        return text

    # a block element's content is one level of the stack; inline elements add to the block they stand in
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
            continue
        if isinstance(item, tuple):  # back in the parent
            if text := end():
                yield text, owner
            (owner,) = item
            continue
        if item.inline:
            if item.furniture and not owner.furniture:  # an advert or notice inside a line
                if item.tag != "svg":
                    parts.append(" ")
                continue
            if item.tag in ("br", "wbr", "img", "input"):
                parts.append(" ")
        else:
            if text := end():
                yield text, owner
            todo.append((owner,))
            owner = item
        todo.extend(reversed(item.items))
    if text := end():
        yield text, owner


def _shape(node: Node) -> int:
    todo = [node]
    while todo:
        top = todo[-1]
        if top.shape is None and (open_kids := [k for k in top.kids if k.shape is None]):
            todo += open_kids
            continue
        top.shape = top.shape if top.shape is not None else hash((top.label, *(k.shape for k in top.kids)))
        todo.pop()
    return node.shape


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the most node pairs with equal labels that keep order and ancestry."""
    if a.label != b.label:
        return 0, []
    total, pairs = _siblings(a.kids, b.kids)
    return total + 1, [(a, b), *pairs]


def _siblings(x: list[Node], y: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
    """The matching of two lists of siblings with their subtrees."""
    pairs: list[tuple[Node, Node]] = []
    lo, hi = 0, 0
    while lo < min(len(x), len(y)) and _shape(x[lo]) == _shape(y[lo]):
        lo += 1
    while hi < min(len(x), len(y)) - lo and _shape(x[-1 - hi]) == _shape(y[-1 - hi]):
        hi += 1
    for u, v in [*zip(x[:lo], y[:lo], strict=True), *zip(x[len(x) - hi :], y[len(y) - hi :], strict=True)]:
        pairs += _same(u, v)[1]
    x, y = x[lo : len(x) - hi], y[lo : len(y) - hi]
    if not x or not y or not {n.label for n in x} & {n.label for n in y}:
        return len(pairs), pairs
    if len(x) * len(y) > PAIRS:
        pairs += _many_siblings(x, y)
        return len(pairs), pairs
    known: dict[tuple[int, int], tuple[int, list]] = {}
    table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, u in enumerate(x):
        row, above = table[i + 1], table[i]
        for j, v in enumerate(y):
            best = above[j + 1] if above[j + 1] >= row[j] else row[j]
            if u.label == v.label:
                known[i, j] = (1, [(u, v)]) if not (u.kids and v.kids) else match(u, v)
                if above[j] + known[i, j][0] > best:
                    best = above[j] + known[i, j][0]
            row[j + 1] = best
    i, j = len(x), len(y)
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            pairs += known[i - 1, j - 1][1]
            i, j = i - 1, j - 1
    return len(pairs), pairs


def _many_siblings(x: list[Node], y: list[Node]) -> list[tuple[Node, Node]]:
    """Long lists: shapes that are unique on both sides anchor the matching; a gap without any is paired by label."""
    in_x, in_y = Counter(map(_shape, x)), Counter(map(_shape, y))
    at = {_shape(n): j for j, n in enumerate(y) if in_y[_shape(n)] == 1}
    tails, ends, before, spots = [], [], {}, {}
    for i, n in enumerate(x):
        if in_x[n.shape] == 1 and (j := at.get(n.shape)) is not None:
            k = bisect_left(tails, j)
            tails[k : k + 1], ends[k : k + 1] = [j], [i]
            before[i], spots[i] = ends[k - 1] if k else None, j
    anchors, i = [], ends[-1] if ends else None
    while i is not None:
        anchors.append((i, spots[i]))
        i = before[i]
    out: list[tuple[Node, Node]] = []
    if not anchors:
        places: dict[str, list[int]] = {}
        for j, n in enumerate(y):
            places.setdefault(n.label, []).append(j)
        j = 0
        for u in x:
            same = places.get(u.label, [])
            k = bisect_left(same, j)
            if k < len(same):
                out += match(u, y[same[k]])[1]
                j = same[k] + 1
        return out
    last = (-1, -1)
    for i, j in [*reversed(anchors), (len(x), len(y))]:
        out += _siblings(x[last[0] + 1 : i], y[last[1] + 1 : j])[1]
        if i < len(x):
            out += _same(x[i], y[j])[1]
        last = (i, j)
    return out


def _same(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Matching of two trees of one shape: node by node."""
    pairs, todo = [], [(a, b)]
    while todo:
        u, v = todo.pop()
        pairs.append((u, v))
        todo.extend(zip(u.kids, v.kids, strict=True))
    return len(pairs), pairs


def node_key(path: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{text}") - (1 << 63)


def _numbered(root: Node) -> list[Node]:
    """Elements in page order, parents first."""
    out, todo = [], [root]
    while todo:
        out.append(todo.pop())
        todo.extend(reversed(out[-1].kids))
    return out


def _is_slot(node: Node) -> bool:
    """Whether a content element may lie here."""
    held = node.up.main if node.up else None
    return held is None and not node.furniture and node.tag in CONTAINERS and any(not k.inline for k in node.kids)


class _Reference:
    """A reference page: its tree, of a node its texts and their keys, and what varies at its nodes."""

    def __init__(self, page: str):
        self.page, self.root = page, parse(page)
        self.texts: dict[int, dict[str, int]] = {}
        for text, node in blocks(self.root):
            self.texts.setdefault(id(node), {})[text] = node_key(node.path, text)
        self.nodes = _numbered(self.root)
        self.number = {id(n): i for i, n in enumerate(self.nodes)}
        self.mass = [0] * len(self.nodes)  # varying text aligned with a node itself
        self.held: dict[int, int] = {}  # pages with varying headings or text of its own right in a node

    def add(self, varying: list[tuple[str, Node]], partner: dict[int, int]) -> None:
        held: set[int] = set()
        for text, node in varying:
            at = node
            while id(at) not in partner:
                at = at.up
            i = self.number[partner[id(at)]]
            self.mass[i] += len(text)
            if at is node:
                mine = self.nodes[i]
                if mine.tag in HEADINGS and mine.up:
                    held.add(self.number[id(mine.up)])
                elif _is_slot(mine):
                    held.add(i)
        for i in held:
            self.held[i] = self.held.get(i, 0) + 1

    def slots(self) -> Iterator[tuple[int, int, int, int]]:
        """Of every slot with varying text: number, the slot around, its text and the pages that hold it back."""
        total = list(self.mass)
        for i in range(len(total) - 1, 0, -1):
            total[self.number[id(self.nodes[i].up)]] += total[i]
        for i, node in enumerate(self.nodes):
            if total[i] and (not i or _is_slot(node)):
                yield i, (self.number[id(node.up)] if i else -1), total[i], self.held.get(i, 0)


class _Host:
    """A host's reference pages and what the task's pages aligned with them showed."""

    def __init__(self, references: list[str]):
        self.references, self.pages = [_Reference(x) for x in references], 0
        self.size = sum(map(len, references)) + 1000
        self.counts: dict[int, int] = {}  # of a key: the pages that show it

    def align(self, page: str) -> None:
        self.pages += 1
        root = parse(page)
        found = list(blocks(root))
        size = sum(len(text) for text, node in found if not node.furniture)
        shown: set[int] = set()
        constant: set[int] = set()  # blocks that another page has at the same place
        partners = []
        for ref in self.references:
            partner = {id(b): id(a) for a, b in match(ref.root, root)[1]}
            partners.append(partner)
            keys = [ref.texts.get(partner.get(id(node)), {}).get(text) for text, node in found]
            if ref.page != page:
                alike = sum(len(text) for (text, node), key in zip(found, keys) if key is not None and not node.furniture)
                if alike > ALIKE * size:  # another capture of this page
                    continue
                constant |= {i for i, key in enumerate(keys) if key is not None}
            shown |= {key for key in keys if key is not None}
        varying = [x for i, x in enumerate(found) if i not in constant and not x[1].furniture and not x[1].head]
        for ref, partner in zip(self.references, partners, strict=True):
            ref.add(varying, partner)
        for key in shown:  # a page counts once, however often it repeats a text on one path
            self.counts[key] = self.counts.get(key, 0) + 1

    def rows(self, host: str) -> Iterator[tuple[str, int, int, int, int, int]]:
        """Pages (``ref`` -2), pages of a template key (-1), and of each reference's slots: the slot around, text, pages."""
        yield host, -2, 0, 0, self.pages, 0
        for key, count in self.counts.items():
            yield host, -1, key, 0, count, 0
        for r, ref in enumerate(self.references):
            for slot, around, size, held in ref.slots():
                yield host, r, slot, around, held, size


COUNTS = "host string, ref int, key long, around long, pages long, mass long"


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[str, _Host] = {}
    unpack = zstandard.ZstdDecompressor().decompress

    def sent(hosts):
        rows = [r for host, seen in hosts for r in seen.rows(host)]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in COUNTS.split(", ")])

    sys.setrecursionlimit(1 << 20)  # trees may be deep; calls of Python functions need no machine stack
    held = 0
    for batch in batches:
        for host, page, packed in zip(batch.column("host"), batch.column("html"), batch.column("packed"), strict=True):
            host = host.as_py()
            seen = kept.pop(host, None)
            if seen is None:
                seen = _Host(json.loads(unpack(packed.as_py())))
                held += seen.size
            kept[host] = seen  # the latest used come last
            seen.align(page.as_py() or "")
            while held > HELD and len(kept) > 1:
                oldest = next(iter(kept))
                held -= kept[oldest].size
                yield sent([(oldest, kept.pop(oldest))])
    yield sent(kept.items())


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor().compress
    for batch in batches:
        packed = [pack(json.dumps(x).encode()) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(packed, pa.binary())], names=["host", "packed"])


def references(pages: DataFrame) -> DataFrame:
    """Per host its reference pages: the distinct pages with the least hashes, one of each of ``SLOTS`` hash classes.

    Both aggregates are bounded (a hash per host and class, then at most ``SLOTS`` per host).
    """
    hashed = pages.select("host", F.coalesce("html", F.lit("")).alias("html")).withColumn("hash", F.xxhash64("html"))
    least = hashed.groupBy("host", F.pmod("hash", F.lit(SLOTS)).alias("slot")).agg(F.min("hash").alias("hash"))
    few = F.slice(F.sort_array(F.collect_list("hash")), 1, REFERENCES)
    chosen = cut(least.groupBy("host").agg(few.alias("few")).select("host", F.explode("few").alias("hash")), "wrapper-chosen")
    texts = hashed.join(chosen, ["host", "hash"]).groupBy("host", "hash").agg(F.min("html").alias("html"))
    lists = texts.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("hash", "html"))).alias("list"))
    return cut(lists.select("host", F.col("list.html").alias("html")).mapInArrow(_pack, "host string, packed binary"), "wrapper-references")


def descend(slots: list[tuple[int, int, int, int]], pages: int) -> tuple[int, int]:
    """Content slot and its text, from slots (number, slot around, text, pages that hold it back) in page order."""
    at = text = held = -1
    for slot, around, size, back in slots:
        if at < 0 or around == at and 2 * held <= pages and size >= DESCEND * text:
            at, text, held = slot, size, back
    return at, text


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host the reference whose content slot holds most: that page alone, packed, and the slot."""
    pack, unpack = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        slots, packed = [], []
        for chains, of, pages in zip(batch.column("chains").to_pylist(), batch.column("of").to_pylist(), batch.column("packed"), strict=True):
            texts = json.loads(unpack(pages.as_py()))
            best = max(
                ((text, -c["ref"], slot) for c in chains
                 for slot, text in [descend([(x["key"], x["around"], x["mass"], x["pages"]) for x in c["chain"]], of)]),
                default=(0, 0, 0),
            )
            slots.append(best[2])
            packed.append(pack(texts[-best[1]].encode()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array(slots, pa.int64()), pa.array(packed, pa.binary()), batch.column("template")],
            names=["host", "slot", "packed", "template"],
        )


def induce(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Wrappers of ``host, html`` pages: host, content slot, the reference that it is a node of, and the keys of its template's texts."""
    refs = references(pages)
    rows = pages.join(refs, "host").select("host", "html", "packed").mapInArrow(_align, COUNTS)
    total = cut(rows.groupBy("host", "ref", "key", "around").agg(F.sum("pages").alias("pages"), F.sum("mass").alias("mass")), "wrapper-counts")
    hosts = total.filter("ref = -2").select("host", F.col("pages").alias("of")).filter(F.col("of") >= least_pages)
    constant = total.filter("ref = -1").join(hosts, "host").filter(F.col("pages") >= F.col("of") * share)
    template = constant.groupBy("host").agg(F.collect_list("key").alias("template"))
    # slots with over half of a reference's varying text lie in each other: at most as many as the page is deep
    slots = total.filter("ref >= 0")
    whole = slots.filter("key = 0").select("host", "ref", F.col("mass").alias("whole"))
    nested = slots.join(whole, ["host", "ref"]).filter("2 * mass > whole")
    chain = F.sort_array(F.collect_list(F.struct("key", "around", "mass", "pages"))).alias("chain")
    chains = nested.groupBy("host", "ref").agg(chain).groupBy("host").agg(F.collect_list(F.struct("ref", "chain")).alias("chains"))
    joined = hosts.join(chains, "host").join(template, "host", "left").join(refs, "host")
    return joined.select("host", "of", "chains", "template", "packed").mapInArrow(_choose, "host string, slot long, packed binary, template array<long>")


class Wrapper:
    """A host's reference page, its content slot and the keys of its template's texts."""

    def __init__(self, page: str, slot: int, template: frozenset):
        self.root, self.template = parse(page), template
        self.slot = _numbered(self.root)[slot]
        self.size = len(page) + 1000

    def content(self, root: Node) -> tuple[Node | None, bool]:
        """The page's partner of the content slot, and whether half of the page's elements have partners."""
        n, pairs = match(self.root, root)
        at = next((b for a, b in pairs if a is self.slot), None)
        return at, 2 * n >= len(_numbered(root))


def extract(page: str | None, wrapper: Wrapper | None = None) -> str:
    """Main text of one page, given its host's wrapper."""
    root = parse(page or "")
    found = [(text, node) for text, node in blocks(root) if not node.furniture and not node.head]
    region = [x for x in found if x[1].main] or found
    template = wrapper.template if wrapper else frozenset()
    if wrapper and found:
        element, aligned = wrapper.content(root)
        within = {id(n) for n in _numbered(element)} if element else ()
        inside = [x for x in found if id(x[1]) in within]
        if region is not found:
            region = [x for x in inside if x[1].main] or region
        elif inside and (aligned or 2 * sum(len(text) for text, _ in inside) >= sum(len(text) for text, _ in found)):
            region = inside
    size = sum(len(text) for text, _ in region)
    varying = [(text, node) for text, node in region if node_key(node.path, text) not in template] if template else region
    if 2 * sum(len(text) for text, _ in varying) < size:
        varying = region
    return "\n\n".join(text for text, _ in varying)


def _extract(schema: pa.Schema):
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        sys.setrecursionlimit(1 << 20)
        kept: dict[str, Wrapper] = {}
        held = 0
        for batch in batches:
            texts = []
            for host, page, slot, packed, template in zip(*(batch.column(c) for c in ("host", "html", "slot", "packed", "template")), strict=True):
                host, wrapper = host.as_py(), None
                if packed.is_valid:
                    if (wrapper := kept.pop(host, None)) is None:
                        wrapper = Wrapper(unpack(packed.as_py()).decode(), slot.as_py(), frozenset(template.as_py() or ()))
                        held += wrapper.size
                    kept[host] = wrapper  # the latest used come last
                    while held > HELD and len(kept) > 1:
                        held -= kept.pop(next(iter(kept))).size
                texts.append(extract(page.as_py(), wrapper))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], schema=schema)

    return run


def html_extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **options) -> DataFrame:
    """One row per page: id, url, text."""
    host = F.coalesce(host_of(url_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    wrappers = cut(induce(rows.select("host", "html"), **options), "wrappers")
    joined = rows.join(wrappers, "host", "left").select("id", "url", "host", "html", "slot", "packed", "template")
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    out = joined.mapInArrow(_extract(schema), "id long, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
