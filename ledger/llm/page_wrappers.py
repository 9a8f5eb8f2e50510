"""Extract main texts from pages by wrappers: union-free regular expressions inferred from the pages of each host.

A page becomes a tree of block elements and text runs; comments, scripts, styles and formatting tags leave none.  Its token stream is
written as an expression in which every kind of child occurs once: a kind that occurs again folds the span between into a
repeated group, whose members are optional where a turn lacks them.  Two expressions are aligned child list by child list: equal
kinds are aligned in turn, a mismatch in tags makes an optional part, or a repeated group where the kind turns up elsewhere, and a mismatch
in text makes a slot.  Aligning is free of order in what it accepts, so each task aligns the pages of a host that it reads, and the
partial expressions of a host are aligned in levels of ``FAN`` until one is left: no task meets more than ``FAN`` of them, however many
pages the host has.  An expression holds one node per path of kinds, so its size follows the layouts of the host, not its pages.

The wrapper of a host names the slots of the main text.  Parts whose tag, class, id or role says menu, header, footer, sidebar, notice,
advert, form or comments are out.  Of the rest, ``article`` or ``main`` elements are taken where there are any, else the part in
which most of the unlinked text is.  Text that stays the same on ``CONSTANT`` or more different pages, while other text beside it varies, belongs to the template;
headings are kept.  Wrappers go to the pages by a broadcast if they are below a checked size, else by a join that Spark splits
where a host is large.

Defined results: null and empty pages have an empty text; null urls and urls without ``://`` form one host; malformed markup is closed as its
elements imply; unclosed comments and scripts last to the end; elements nested deeper than ``DEPTH`` count as formatting; repeated rows are rows
of their own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import cut, lower_ascii, named

FAN = 32
DEPTH = 100
#: Different kinds of one tag below one parent; beyond that they count as one kind.
KINDS = 32
CONSTANT = 3
#: Wrappers up to this size are broadcast.
BROADCAST_BYTES = 64 << 20

# Element names of HTML by how they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FORMATTING = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr label".split())
HIDDEN = frozenset("script style noscript template iframe object svg math canvas audio video select textarea datalist".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: An opening tag ends an open element of these names, unless an element of the second list lies between.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: Block elements that end an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split())
#: Elements that are never main text.
OUT = frozenset("head title nav header footer aside form menu dialog button fieldset search".split())
#: Words of class, id and role that say the same.
OUT_WORDS = re.compile(
    r"(?:^|[^a-z])(?:nav|navbar|navigation|menu|menubar|header|masthead|footer|sidebar|aside|complementary|contentinfo|banner|notice|notices|notification|alert|"
    r"cookie|cookies|consent|gdpr|ad|ads|adv|advert|adverts|advertisement|advertisements|adsense|sponsor|sponsored|promo|promotion|popup|modal|overlay|"
    r"newsletter|subscribe|subscription|signup|login|search|form|share|sharing|social|breadcrumb|breadcrumbs|pagination|pager|related|"
    r"recommended|comment|comments|commentlist|disqus|respond|replies|discussion|widget|toolbar|skip)(?:[^a-z]|$)")
MAIN = frozenset(["article", "main"])

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*+>?)"
    r"|<[!?/][^>]*+>?", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Classes that say what stands beside or inside an element, not what it is.
BESIDE = re.compile(r"(?:has|with|no|without|is|not|hide|show)[-_]")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

TEXT = "#"


@lru_cache(10_000)
def _kind(name: str, rest: str) -> str:
    """The kind of an element: its tag, and class, id and role without numbers."""
    words = []
    if "=" in rest:
        for found in ATTRIBUTE.finditer(rest):
            words += CAMEL.sub("-", found[2] or found[3] or found[4] or "").lower().split()
    return " ".join([name, *sorted({re.sub(r"\d+", "", w) for w in words})])


def _out(kind: str) -> int:
    """Whether a kind is never main text: 2 if its tag says so, 1 if only class, id or role do, else 0."""
    name, *words = kind.split(" ")
    if name in OUT:
        return 2
    return int(name not in ("html", "body") and any(OUT_WORDS.search(w) and not BESIDE.match(w) for w in words))


def texts_of(html: str) -> Iterator[tuple[tuple[str, ...], str, float]]:
    """Text blocks of a page in order: path of kinds, text, share of it that is linked.

    White space in a block is one blank; a block ends where a block element begins or ends.
    """
    names: list[str] = []
    kinds: list[str] = []
    block: list[str] = []
    linked: list[str] = []
    links = hidden = hidden_in = 0

    def close() -> Iterator[tuple[tuple[str, ...], str, float]]:
        text = " ".join("".join(block).split())
        if text:
            yield tuple(kinds), text, min(1.0, sum(map(len, linked)) / len(text))
        block.clear()
        linked.clear()

    def pop(count: int) -> None:
        if count:
            del names[-count:], kinds[-count:]

    at, size = 0, len(html)
    while at < size:
        found = TOKEN.search(html, at)
        stop = found.start() if found else size
        if stop > at and not hidden:
            piece = unescape(html[at:stop])
            block.append(piece)
            if links:
                linked.append(piece)
        if not found:
            break
        at = found.end()
        if not found["name"]:
            continue
        name, opens = found["name"].lower(), not found["close"]
        if opens and name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            inside, at = html[at:end.start() if end else size], end.end() if end else size
            if name == "title":
                yield from close()
                kinds.append("title")
                block.append(unescape(inside))
                yield from close()
                kinds.pop()
            continue
        if name in HIDDEN:
            hidden_in = hidden_in if hidden else len(names)
            hidden = max(0, hidden + (1 if opens and not found["rest"].endswith("/>") else 0 if opens else -1))
            continue
        if hidden and (opens or name not in names[:hidden_in]):
            continue
        if name in FORMATTING:
            if name == "br":
                block.append(" ")
            elif name == "a":
                links = 1 if opens else 0
            continue
        yield from close()
        links = 0
        if not opens:
            for k in range(len(names) - 1, -1, -1):
                if names[k] == name:
                    pop(len(names) - k)
                    break
            hidden = 0
            continue
        if name in ENDS_PARAGRAPH and "p" in names:
            pop(len(names) - max(k for k, n in enumerate(names) if n == "p"))
        if name in ENDS:
            ended, walls = ENDS[name]
            k, last = len(names) - 1, None
            while k >= 0 and names[k] not in walls:
                if names[k] in ended:
                    last = k
                k -= 1
            if last is not None:
                pop(len(names) - last)
        if name not in VOID and len(names) < DEPTH:
            names.append(name), kinds.append(_kind(name, found["rest"]))
    yield from close()


class Node:
    """One part of an expression: how often it occurs, its child parts in order, and what is known of its text.

    ``groups`` numbers the repeated group of each child, if any; a child in fewer turns of the parent than ``turns`` is optional.
    """
    __slots__ = ("turns", "children", "groups", "slot", "unlinked", "linked", "out", "pages")

    def __init__(self, out: int = 0):
        self.turns, self.pages, self.out = 0, 0, out
        self.children: dict[str, Node] = {}
        self.groups: dict[str, int] = {}
        #: Digest of the text where it never differed, None for a slot; -1 before any text.
        self.slot: int | None = -1
        self.unlinked = self.linked = 0.0

    def parts(self) -> list[tuple]:
        return [self.turns, self.pages, self.out, self.slot, self.unlinked, self.linked, self.groups, [(k, c.parts()) for k, c in self.children.items()]]

    @classmethod
    def of(cls, parts: list) -> Node:
        node = cls(parts[2])
        node.turns, node.pages, _, node.slot, node.unlinked, node.linked, node.groups, kids = parts
        node.children = {k: cls.of(c) for k, c in kids}
        return node


def _fold(order: list[str]) -> tuple[list[str], dict[str, int]]:
    """Kinds in order of first occurrence, and the repeated group of each kind that lies in a span between equal kinds."""
    last = {k: i for i, k in enumerate(order)}
    first: dict[str, int] = {}
    for i, k in enumerate(order):
        first.setdefault(k, i)
    groups, number, i = {}, 0, 0
    while i < len(order):
        end = j = last[order[i]]
        if end > i:
            j = i
            while j <= end:
                end = max(end, last[order[j]])
                j += 1
            number += 1
            for k in order[i:end + 1]:
                groups[k] = number
        i = end + 1
    return list(first), groups


def _aligned_order(a: list[str], b: list[str]) -> list[str]:
    """Both lists in one: common kinds are matched in order, what only one has comes in between; kinds that cross occur twice."""
    if a == b:
        return a
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            size[i][j] = size[i + 1][j + 1] + 1 if a[i] == b[j] else max(size[i + 1][j], size[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append(a[i])
            i, j = i + 1, j + 1
        elif size[i + 1][j] >= size[i][j + 1]:
            out.append(a[i])
            i += 1
        else:
            out.append(b[j])
            j += 1
    return out + a[i:] + b[j:]


def _spread(order: list[str], groups: dict[str, int]) -> list[str]:
    """A child list with each repeated group written twice, so that folding finds it again."""
    out, i = [], 0
    while i < len(order):
        g, j = groups.get(order[i]), i + 1
        while g and j < len(order) and groups.get(order[j]) == g:
            j += 1
        out += order[i:j] * (2 if g else 1)
        i = j
    return out


def align(a: Node, b: Node) -> Node:
    """The expression that accepts what ``a`` and ``b`` accept; ``a`` is changed and returned."""
    a.turns += b.turns
    a.pages += b.pages
    a.slot = b.slot if a.slot == -1 else a.slot if b.slot in (-1, a.slot) else None
    a.unlinked += b.unlinked
    a.linked += b.linked
    mine, theirs = list(a.children), list(b.children)
    for kind, child in b.children.items():
        a.children[kind] = align(a.children[kind], child) if kind in a.children else child
    if mine != theirs or a.groups != b.groups:
        order, groups = _fold(_aligned_order(_spread(mine, a.groups), _spread(theirs, b.groups)))
        a.children, a.groups = {k: a.children[k] for k in order}, groups
    tags: dict[str, list[str]] = {}
    if len(a.children) > KINDS:
        for kind in a.children:
            tags.setdefault(kind.split(" ", 1)[0], []).append(kind)
    for tag, kinds in tags.items():
        if len(kinds) > KINDS:
            _generalise(a, tag, kinds)
    return a


def _generalise(node: Node, tag: str, kinds: list[str]) -> None:
    """Too many kinds of one tag count as one kind, the tag followed by ``*``, in one repeated group."""
    to = f"{tag} *"
    whole = Node()
    for kind in kinds:
        whole = align(whole, node.children[kind])
    whole.out = min(node.children[kind].out for kind in kinds)
    order, groups = _fold([to if k in kinds else k for k in _spread(list(node.children), node.groups)])
    node.children = {k: whole if k == to else node.children[k] for k in order}
    node.groups = groups


def expression(html: str) -> Node:
    """The expression of one page."""
    root = Node()
    root.turns = root.pages = 1
    orders: dict[int, list[str]] = {}
    nodes = [root]
    before: tuple[str, ...] = ()
    for path, text, linked in texts_of(html):
        same = 0
        while same < min(len(path), len(before)) and path[same] == before[same]:
            same += 1
        # The same path again is another turn of the innermost element.
        same = min(same, len(path) - 1) if path == before and path else same
        del nodes[same + 1:]
        for kind in path[same:]:
            parent = nodes[-1]
            orders.setdefault(id(parent), []).append(kind)
            child = parent.children.get(kind)
            if child is None:
                child = parent.children[kind] = Node(_out(kind))
            child.turns += 1
            nodes.append(child)
        slot = nodes[-1].children.get(TEXT)
        if slot is None:
            slot = nodes[-1].children[TEXT] = Node()
        orders.setdefault(id(nodes[-1]), []).append(TEXT)
        digest = zlib.crc32(text.encode("utf-8", "surrogatepass"))
        slot.slot = digest if slot.slot in (-1, digest) else None
        slot.turns += 1
        slot.unlinked += len(text) * (1 - linked)
        slot.linked += len(text) * linked
        before = path
    stack = [root]
    while stack:
        node = stack.pop()
        node.pages = 1
        order, node.groups = _fold(orders.get(id(node), []))
        node.children = {k: node.children[k] for k in order}
        stack.extend(node.children.values())
    return _narrow(root)


def _narrow(node: Node) -> Node:
    """Apply the bound on kinds to every part."""
    stack = [node]
    while stack:
        part = stack.pop()
        if len(part.children) > KINDS:
            align(part, Node())
        stack.extend(part.children.values())
    return node


def _unlinked(node: Node) -> float:
    """Unlinked text of a part."""
    return sum(c.unlinked if k == TEXT else _unlinked(c) for k, c in node.children.items())


def _holds_main(node: Node) -> bool:
    return any(k.split(" ", 1)[0] in MAIN and not c.out or _holds_main(c) for k, c in node.children.items())


def main_slots(root: Node) -> set[tuple[str, ...]]:
    """Paths of the slots that hold main text."""
    regions, best = [], (0.0, ())
    whole = _unlinked(root)

    def is_out(node: Node) -> bool:
        # A class alone does not take out the part that holds the main element and most of the text.
        return node.out == 2 or node.out == 1 and not (_holds_main(node) and 2 * _unlinked(node) > whole)

    def weigh(node: Node, path: tuple[str, ...]) -> None:
        """``regions`` gets the outermost article and main elements."""
        for k, c in node.children.items():
            if k == TEXT or is_out(c):
                continue
            if k.split(" ", 1)[0] in MAIN:
                regions.append(((*path, k), total(c)))
            else:
                weigh(c, (*path, k))

    def total(node: Node) -> float:
        return sum(c.unlinked if k == TEXT else 0.0 if is_out(c) else total(c) for k, c in node.children.items())

    def own(node: Node) -> float:
        """Text of the part without its child elements that are parts of their own."""
        return sum(max(0.0, c.unlinked - c.linked) for k, c in node.children.items() if k == TEXT)

    def inner(node: Node, path: tuple[str, ...]) -> None:
        """The smallest part with most of the text: paragraphs count for the part that holds them."""
        nonlocal best
        held = own(node) + sum(own(c) + 0.5 * total(c) - 0.5 * own(c) for k, c in node.children.items() if k != TEXT and not is_out(c))
        if held > best[0]:
            best = (held, path)
        for k, c in node.children.items():
            if k != TEXT and not is_out(c):
                inner(c, (*path, k))

    weigh(root, ())
    chosen = [path for path, size in regions if size > 0]
    if not chosen:
        inner(root, ())
        chosen = [best[1]]
    kept: set[tuple[str, ...]] = set()

    def collect(node: Node, path: tuple[str, ...], found: list[tuple[tuple[str, ...], Node]]) -> None:
        for k, c in node.children.items():
            if k == TEXT:
                found.append((path, c))
            elif not is_out(c):
                collect(c, (*path, k), found)

    for region in chosen:
        node, found = root, []
        for k in region:
            node = node.children[k]
        collect(node, region, found)
        varied = sum(c.unlinked for _, c in found if c.slot is None)
        for path, c in found:
            heading = bool(path) and re.match(r"h[1-6]\b", path[-1])
            fixed = c.slot is not None and c.pages >= CONSTANT and not heading and varied > c.unlinked + c.linked
            if not fixed:
                kept.add(path)
    return kept


def _general(path: tuple[str, ...], root: Node) -> tuple[str, ...]:
    """The path in the expression that accepts ``path`` of a page."""
    out, node = [], root
    for kind in path:
        if kind not in node.children:
            kind = f"{kind.split(' ', 1)[0]} *"
            if kind not in node.children:
                return (*out, kind)
        out.append(kind)
        node = node.children[kind]
    return tuple(out)


def extract(html: str, root: Node, kept: set[tuple[str, ...]]) -> str:
    """Main text of one page by the expression of its host."""
    return " ".join(text for path, text, _ in texts_of(html) if _general(path, root) in kept)


def _host(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return lower_ascii(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")))


def _pack(node: Node) -> bytes:
    return zlib.compress(pickle.dumps(node.parts(), protocol=5), 1)


def _unpack(blob: bytes) -> Node:
    return Node.of(pickle.loads(zlib.decompress(blob)))


WRAPPER = pa.schema([("host", pa.string()), ("part", pa.int64()), ("wrapper", pa.binary())])


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The aligned expression of each host of a partition.  Equal pages are aligned once: they vary nothing."""
    hosts: dict[str, Node] = {}
    seen: set[tuple[str, bytes | None]] = set()
    part = 0
    for batch in batches:
        for host, html, key, number in zip(*(batch.column(k) for k in range(4)), strict=True):
            host, part = host.as_py(), number.as_py()
            if (host, key.as_py()) in seen:
                continue
            seen.add((host, key.as_py()))
            page = expression(html.as_py() or "")
            hosts[host] = align(hosts[host], page) if host in hosts else page
    if hosts:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(hosts), pa.string()), pa.array([part] * len(hosts), pa.int64()),
             pa.array([_pack(n) for n in hosts.values()], pa.binary())], schema=WRAPPER)


def _join(batch: pa.Table) -> pa.Table:
    """One level: the partial expressions of a host and group become one."""
    whole = None
    for blob in batch.column("wrapper").to_pylist():
        whole = align(whole, _unpack(blob)) if whole is not None else _unpack(blob)
    return pa.table({"host": batch.column("host")[:1], "part": batch.column("part")[:1], "wrapper": [_pack(whole)]}, schema=WRAPPER)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """One row per host: host, wrapper.  ``pages`` has host and html."""
    schema = "host string, part bigint, wrapper binary"
    rows = pages.select("host", "html", F.xxhash64("html").alias("key"), F.spark_partition_id().cast("long").alias("part"))
    parts = cut(rows.mapInArrow(_partials, schema), "wrapper-parts")
    left = pages.rdd.getNumPartitions()
    while left > 1:
        left = -(-left // FAN)
        group = F.floor(F.col("part") / FAN).cast("long")
        parts = parts.withColumn("part", group).groupBy("host", "part").applyInArrow(_join, schema)
    return cut(parts.select("host", "wrapper"), "wrappers")


def _extracted(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[Node, set]] = {}
        for batch in batches:
            texts = []
            for html, host, blob in zip(*(batch.column(k) for k in (2, 3, 4)), strict=True):
                host = host.as_py()
                if host not in known:
                    if len(known) >= 1000:
                        known.clear()
                    root = _unpack(blob.as_py())
                    known[host] = root, main_slots(root)
                texts.append(extract(html.as_py() or "", *known[host]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])
    return run


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(named("page_id").alias("page_id"), named("url").alias("url"), named("html").alias("html"))
    rows = rows.withColumn("host", _host(F.col("url")))
    wrappers = infer_wrappers(rows)
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    side = F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers
    kind = rows.schema["page_id"].dataType.simpleString()
    found = rows.join(side, "host").select("page_id", "url", "html", "host", "wrapper")
    out = found.mapInArrow(_extracted(kind), f"page_id {kind}, url {rows.schema['url'].dataType.simpleString()}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
