"""Main text of web pages by wrapper induction.

1. Every page becomes a tree of blocks: containers and the block elements in them,
   inline markup read as text, like siblings folded into one (a text of any number
   of paragraphs has one shape).  Forms and what markup names as menu, header,
   footer, sidebar, notice, advert or comments carry a mark.
2. Pages of one shape and host are summed in Spark: for every slot (a block that
   holds text) the least and the greatest digest of its text, how many different
   pages hold it, its letters and those inside links.
3. The shapes of a host are aligned by simple tree matching: the largest set of
   node pairs with equal labels that keeps order and parents.  Matched nodes are
   one node of the host's wrapper, the others join it as optional nodes.  A host
   of many shapes is aligned in rounds of bounded groups.
4. In the wrapper, a slot whose text is the same on all pages is template, one
   whose letters are mostly links is a menu, marked ones are neither.  The rest
   vary: the content lies under the node that holds most of their letters (an
   article or main element where there is one).
5. Each shape learns which of its slots are content, and a second pass reads them
   from every whole page.

A host with one page has a wrapper of that page alone: marks, links and weight
decide.  All statistics are sums, least and greatest values, so the partition of
pages over tasks has no effect.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, python_tasks, staged

#: A slot is template only if at least this many different pages of its host hold it, and this
#: share of them.
MIN_PAGES, MIN_SHARE = 3, 0.5
#: A slot with this share of its letters inside links is a menu.
LINK_SHARE = 0.6
#: The content region goes down while one child holds this share of what varies.
REGION_SHARE = 0.7
#: Shapes of one host that one task aligns at a time.
GROUP = 400

# Elements of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style template noscript iframe object embed canvas svg math audio video map head title "
                   "noembed noframes applet".split())
FORM = frozenset("form input select option optgroup button textarea fieldset legend datalist output progress meter "
                 "dialog menu".split())
APART = frozenset("nav aside footer".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption "
                           "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search "
                           "section summary table ul".split())
#: What an element's start ends, up to the given containers.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
          "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
          "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}
#: Words of class, id and role that mark a part that is no content.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored "
                  "cookie cookies consent gdpr notice alert nav navbar navigation menu menubar breadcrumb breadcrumbs "
                  "sidebar sidebars aside complementary footer footnav contentinfo header masthead topbar comment "
                  "comments disqus reply replies respond newsletter subscribe subscription signup login popup modal "
                  "overlay toolbar share sharing social related recommended pagination pager search searchform widget "
                  "widgets skip".split())
#: Marks that an article or main element inside sheds: layouts are named for what they hold too.
SOFT = frozenset("form header sidebar sidebars widget widgets notice alert banner search toolbar".split())
MAIN = frozenset(["article", "main"])
#: Elements whose siblings of the same label are folded wherever they stand.
PHRASES = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote figure figcaption table tr hr address".split())
#: Elements that the content region may lie in.
REGIONS = frozenset("div section main article td tr tbody table center body #page form header".split())
#: Blocks nested deeper than this open no further container; their text is kept.
DEPTH = 150

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/><]*)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+)(>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/><]*)([^>]*)(>|\Z)", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I) for tag in RAW}
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Node:
    """A container, or a slot (kind ``#text``) with the blocks of text found there."""
    __slots__ = ("kind", "mark", "children", "blocks")

    def __init__(self, kind: str, mark: str):
        self.kind, self.mark, self.children, self.blocks = kind, mark, [], []


class Block:
    __slots__ = ("order", "pieces", "links")

    def __init__(self, order: int):
        self.order, self.pieces, self.links = order, [], []

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def _names(attributes: str) -> list[str]:
    found = []
    for m in _NAMES.finditer(attributes):
        found += (m[1] or m[2] or m[3] or "").split()
    return found


def _mark(tag: str, names: list[str], inside_main: bool) -> str:
    """The word that marks an element as no content; empty for none."""
    if tag in APART or tag in FORM or tag in UNSEEN or tag == "header" and not inside_main:
        return tag
    for name in names:
        for w in _PARTS.findall(name):
            if w.lower() in MARKS and not (inside_main and w.lower() == "header"):
                return w.lower()
    return ""


def parse(source: str) -> Node:
    """The tree of blocks of one page, unfolded."""
    root = Node("#page", "")
    # open elements: (tag, node, or None for inline ones, mark, inside article or main)
    stack: list[tuple[str, Node | None, str, bool]] = [("#page", root, "", False)]
    nodes = [root]
    now: Block | None = None
    anchors = at = count = 0

    def text(raw: str) -> None:
        nonlocal now, count
        if now is None:
            if not raw or raw.isspace():
                return
            now, slot = Block(count), Node("#text", stack[-1][2])
            count += 1
            slot.blocks.append(now)
            nodes[-1].children.append(slot)
        piece = html.unescape(raw) if "&" in raw else raw
        now.pieces.append(piece)
        if anchors:
            now.links.append(piece)

    def close(depth: int) -> None:
        nonlocal now, anchors
        while len(stack) > depth:
            tag, node, _, _ = stack.pop()
            if node is not None:
                nodes.pop()
                now = None
            elif tag == "a":
                anchors -= 1

    def last(tags, barriers=()) -> int:
        """The depth of the innermost open element of ``tags``; 0 without one this side of ``barriers``."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                return depth
            if stack[depth][0] in barriers:
                return 0
        return 0

    while at < len(source):
        begin = source.find("<", at)
        if begin < 0:
            text(source[at:])
            break
        m = _TOKEN.match(source, begin)
        if m is None:  # a sign that begins no markup
            text(source[at:begin + 1])
            at = begin + 1
            continue
        text(source[at:begin])
        at = m.end()
        slash, tag, attributes, end = m.group(1, 2, 3, 4) if m[2] else m.group(5, 6, 7, 8)
        if not tag or not end:
            continue
        tag = tag.lower()
        if slash:
            depth = last((tag,))
            if depth and tag in INLINE and any(node is not None for _, node, _, _ in stack[depth + 1:]):
                anchors -= tag == "a" and stack[depth][1] is None  # blocks inside it go on
                if stack[depth][1] is None:
                    del stack[depth]
            elif depth:
                close(depth)
            continue
        if tag in RAW:
            found = _RAW_END[tag].search(source, at)
            at = found.end() if found else len(source)
        elif tag == "br":
            text(" ")
        elif tag in VOID or tag in ("html", "body"):
            now = None if tag == "hr" else now
        else:
            if tag in ENDS_PARAGRAPH and (depth := last(("p",), ("table", "button", "object"))):
                close(depth)
            elif tag in CLOSES:
                ended, within = CLOSES[tag]
                while depth := last(ended, within):
                    close(depth)
            _, _, mark, inside = stack[-1]
            names = _names(attributes) if "=" in attributes else []
            main = tag in MAIN or "main" in names or "articleBody" in names
            if main and mark in SOFT:
                mark = ""
            if attributes and _HIDDEN.search(attributes):
                mark = mark or "hidden"
            if tag in INLINE:
                if mark == stack[-1][2]:
                    stack.append((tag, None, mark, inside))
                    anchors += tag == "a"
                    continue
            else:
                own = _mark(tag, names, inside)
                mark = mark or ("" if main and own in SOFT else own)
            now = None
            if len(nodes) > DEPTH:
                stack.append((tag, None, mark, inside or main))
                anchors += tag == "a"
                continue
            label = tag if not names else tag + "." + ".".join(sorted({re.sub(r"\d+", "0", n) for n in names}))
            node = Node(label, mark)
            nodes[-1].children.append(node)
            nodes.append(node)
            stack.append((tag, node, mark, inside or main))
    return root


def _tag(kind: str) -> str:
    return kind.split(".", 1)[0]


def _weight(a: Node, b: Node) -> int:
    """Simple tree matching: the pairs of the largest match of two trees with equal roots."""
    return 1 + (_matched(a.children, b.children)[0] if a.children and b.children else 0)


def _matched(a: list[Node], b: list[Node]) -> tuple[int, list[tuple[int, int]]]:
    """Weight and pairs of the largest match of two lists of trees that keeps their order."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    took = {}
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            top = max(best[i + 1][j], best[i][j + 1])
            if a[i].kind == b[j].kind and a[i].mark == b[j].mark:
                both = best[i + 1][j + 1] + _weight(a[i], b[j])
                if both >= top:
                    top = both
                    took[i, j] = True
            best[i][j] = top
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if (i, j) in took:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return best[0][0], pairs


def absorb(a: Node, b: Node) -> None:
    """Merges tree ``b`` into ``a`` (equal roots): matched nodes become one, the others of ``b``
    stand where order puts them."""
    a.blocks += b.blocks
    if [(c.kind, c.mark) for c in a.children] == [(c.kind, c.mark) for c in b.children]:
        pairs = [(k, k) for k in range(len(a.children))]
    else:
        pairs = _matched(a.children, b.children)[1]
    merged, i, j = [], 0, 0
    for p, q in [*pairs, (len(a.children), len(b.children))]:
        merged += a.children[i:p] + b.children[j:q]
        if p < len(a.children):
            absorb(a.children[p], b.children[q])
            merged.append(a.children[p])
        i, j = p + 1, q + 1
    a.children = merged


def shape(node: Node) -> list:
    """Label, mark and children, without text."""
    return [node.kind, node.mark, [shape(c) for c in node.children]]


def fold(node: Node) -> Node:
    """Folds like siblings, leaves out what holds no text.

    Paragraphs, headings, lists and other phrases of one label are one node wherever they stand,
    named elements of one label if they are neighbours, unnamed containers if they are neighbours
    of one shape.
    """
    out: list[Node] = []
    phrases: dict[tuple[str, str], Node] = {}
    for child in node.children:
        if child.kind != "#text":
            fold(child)
            if not child.children:
                continue
        key = child.kind, child.mark
        if child.kind == "#text" or _tag(child.kind) in PHRASES:
            if key in phrases:
                absorb(phrases[key], child)
                continue
            phrases[key] = child
        elif out and (out[-1].kind, out[-1].mark) == key and ("." in child.kind or shape(out[-1]) == shape(child)):
            absorb(out[-1], child)
            continue
        out.append(child)
    node.children = out
    return node


def slots_of(node: Node) -> list[Node]:
    return [node] if node.kind == "#text" else [s for c in node.children for s in slots_of(c)]


class Wrapper:
    """A tree whose slots are numbered, with (pages, least and greatest digest, letters, letters
    in links) of each slot and the number of different pages."""

    def __init__(self, root: Node, pages: int, stats: list[list[int]]):
        self.root, self.pages, self.stats = root, pages, stats

    @staticmethod
    def of(tree: list, pages: int, stats: list) -> "Wrapper":
        """From a tree as ``shape`` gives it; its slots are numbered in its own order."""
        def node(t) -> Node:
            n = Node(t[0], t[1])
            n.children = [node(c) for c in t[2]]
            return n

        root = node(tree)
        for k, slot in enumerate(slots_of(root)):
            slot.blocks = [k]
        return Wrapper(root, pages, [list(s) for s in stats])

    @staticmethod
    def loads(text: str) -> "Wrapper":
        tree, pages, stats = json.loads(text)
        return Wrapper.of(tree, pages, stats)

    def dumps(self) -> str:
        return json.dumps([shape(self.root), self.pages, self.stats], separators=(",", ":"), ensure_ascii=False)

    @staticmethod
    def aligned(wrappers: list["Wrapper"]) -> tuple["Wrapper", list[list[int]]]:
        """One wrapper for all, and for each of them the new numbers of its slots."""
        stats, base = [], []
        root = None
        for w in wrappers:
            base.append(len(stats))
            for slot in slots_of(w.root):
                slot.blocks = [k + base[-1] for k in slot.blocks]
            stats += w.stats
            if root is None:
                root = w.root
            else:
                absorb(root, w.root)
        number, summed = {}, []
        for new, slot in enumerate(slots_of(root)):
            for k in slot.blocks:
                number[k] = new
            of = [stats[k] for k in slot.blocks]
            summed.append([sum(s[0] for s in of), min(s[1] for s in of), max(s[2] for s in of),
                           sum(s[3] for s in of), sum(s[4] for s in of)])
            slot.blocks = [new]
        out = Wrapper(root, sum(w.pages for w in wrappers), summed)
        return out, [[number[b + k] for k in range(len(w.stats))] for b, w in zip(base, wrappers)]

    def content(self) -> list[bool]:
        """Which slots are content."""
        varies = []
        for slot in slots_of(self.root):
            n, lo, hi, letters, linked = self.stats[slot.blocks[0]]
            template = lo == hi and n >= MIN_PAGES and n >= MIN_SHARE * self.pages
            varies.append(not slot.mark and not template and linked < LINK_SHARE * letters)

        def weight(node: Node) -> int:
            return sum(self.stats[s.blocks[0]][3] for s in slots_of(node) if varies[s.blocks[0]])

        kept = [False] * len(varies)
        node, total = self.root, weight(self.root)
        while True:
            mains = [c for c in _topmost(node, MAIN) if weight(c)]
            if mains and sum(map(weight, mains)) >= total / 2:
                region = mains
                if len(mains) == 1 and _tag(mains[0].kind) == "main" and mains[0] is not node:
                    node, total = mains[0], weight(mains[0])
                    continue
                break
            heavy = max(node.children, key=weight, default=None)
            if heavy is None or _tag(heavy.kind) not in REGIONS or weight(heavy) < REGION_SHARE * total or not total:
                region = [node]
                break
            for c in node.children:  # a title stands before the text it belongs to
                if _tag(c.kind) == "h1":
                    for s in slots_of(c):
                        kept[s.blocks[0]] = varies[s.blocks[0]]
            node, total = heavy, weight(heavy)
        for part in region:
            for s in slots_of(part):
                kept[s.blocks[0]] = varies[s.blocks[0]]
        return kept


def _topmost(node: Node, tags) -> list[Node]:
    """The outermost unmarked descendants of these tags."""
    out = []
    for c in node.children:
        if not c.mark and _tag(c.kind) in tags:
            out.append(c)
        else:
            out += _topmost(c, tags)
    return out


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def read_page(source: str | None) -> tuple[str, list[list[Block]]]:
    """The shape of a page as JSON, and the blocks of each of its slots."""
    root = fold(parse(source or ""))
    return (json.dumps(shape(root), separators=(",", ":"), ensure_ascii=False),
            [slot.blocks for slot in slots_of(root)])


def _shape_id(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), _HOST, 1))
    return pages.withColumn("host", host)


def page_shapes(pages: DataFrame) -> DataFrame:
    """(host, shape_id, tree, page, slots) of every page; ``tree`` once a task for each shape,
    ``page`` a digest of all its slots, ``slots`` (digest, letters, letters in links)."""
    python_tasks(pages.sparkSession)

    def run(batches):
        sent: set[str] = set()
        for batch in batches:
            rows = []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                tree, blocks = read_page(source)
                key = _shape_id(tree)
                texts = [[b.text() for b in sorted(of, key=lambda b: b.order)] for of in blocks]
                slots = [{"digest": _digest("\n".join(t)), "letters": sum(map(len, t)),
                          "linked": sum(len("".join(b.links)) for b in of)} for t, of in zip(texts, blocks)]
                rows.append((host, key, None if key in sent else tree,
                             _digest(key + str([s["digest"] for s in slots])), slots))
                sent.add(key)
                if len(sent) > 100_000:
                    sent.clear()
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in rows], kind)

    slot = pa.struct([("digest", pa.int64()), ("letters", pa.int64()), ("linked", pa.int64())])
    kind = pa.schema([("host", pa.string()), ("shape_id", pa.string()), ("tree", pa.string()), ("page", pa.int64()),
                      ("slots", pa.list_(slot))])
    return _hosted(pages).select("host", F.col("html").cast("string").alias("html")).mapInArrow(
        run, "host string, shape_id string, tree string, page long, "
             "slots array<struct<digest: long, letters: long, linked: long>>")


def shape_statistics(pages: DataFrame) -> DataFrame:
    """(host, id, wrapper): each shape of each host, with the sums over its different pages."""
    found = staged(page_shapes(pages), "page-shapes")
    different = found.groupBy("host", "shape_id", "page").agg(F.first("slots").alias("slots"))
    counts = different.groupBy("host", "shape_id").agg(F.count(F.lit(1)).alias("pages"))
    slots = (different.select("host", "shape_id", F.posexplode("slots").alias("at", "s"))
             .groupBy("host", "shape_id", "at")
             .agg(F.count(F.lit(1)).alias("n"), F.min("s.digest").alias("lo"), F.max("s.digest").alias("hi"),
                  F.sum("s.letters").alias("letters"), F.sum("s.linked").alias("linked"))
             .groupBy("host", "shape_id")
             .agg(F.array_sort(F.collect_list(F.struct("at", F.array("n", "lo", "hi", "letters", "linked").alias("v")))).alias("stats")))
    trees = found.where("tree is not null").groupBy("host", "shape_id").agg(F.max("tree").alias("tree"))
    # a tree may have been sent for another host by the same task
    trees = found.select("host", "shape_id").distinct().join(
        trees.groupBy("shape_id").agg(F.max("tree").alias("tree")), "shape_id")
    stats = F.coalesce(F.to_json(F.col("stats.v")), F.lit("[]"))
    wrapper = F.concat(F.lit("["), "tree", F.lit(","), F.col("pages").cast("string"), F.lit(","), stats, F.lit("]"))
    return trees.join(counts, ["host", "shape_id"]).join(slots, ["host", "shape_id"], "left").select(
        "host", F.col("shape_id").alias("id"), wrapper.alias("wrapper"))


def host_wrappers(pages: DataFrame, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(host, id, wrapper) with one wrapper per host, and (host, shape_id, id, slots): the number
    that each slot of each shape has in it.

    A round aligns up to about ``group`` wrappers of a host in one task; hosts of more shapes take
    log_group(shapes) rounds.
    """
    now = staged(shape_statistics(pages), "shapes")
    where = None

    def align(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        parts = [Wrapper.loads(w) for w in frame["wrapper"]]
        order = sorted(range(len(parts)), key=lambda k: (-parts[k].pages, frame["id"].iloc[k]))
        whole, numbers = Wrapper.aligned([parts[k] for k in order])
        ids = [frame["id"].iloc[k] for k in order]
        return pd.DataFrame({"host": frame["host"].iloc[0], "id": ids, "into": ids[0], "slots": numbers,
                             "wrapper": [whole.dumps()] + [None] * (len(ids) - 1)})

    while True:
        many = now.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        parted = now.join(many, "host").withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / F.lit(group))))
        done = staged(parted.select("host", "part", "id", "wrapper").groupBy("host", "part").applyInPandas(
            align, "host string, id string, into string, slots array<int>, wrapper string"), "aligned")
        step = done.select("host", "id", "into", F.col("slots").alias("to"))
        if where is None:
            where = step.select("host", F.col("id").alias("shape_id"), F.col("into").alias("id"), F.col("to").alias("slots"))
        else:
            where = where.join(step, ["host", "id"]).select(
                "host", "shape_id", F.col("into").alias("id"),
                F.transform("slots", lambda k: F.get(F.col("to"), k)).alias("slots"))
        where = staged(where, "slot-numbers")
        now = done.where("wrapper is not null").select("host", F.col("into").alias("id"), "wrapper")
        if now.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return now, where


def content_slots(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """(host, shape_id, content): for each shape of each host whether its slots are content."""
    wrappers, where = host_wrappers(pages, group)

    def decide(batches: Iterator[pd.DataFrame]):
        for frame in batches:
            yield pd.DataFrame({"host": frame["host"], "id": frame["id"],
                                "flags": [Wrapper.loads(w).content() for w in frame["wrapper"]]})

    flags = wrappers.mapInPandas(decide, "host string, id string, flags array<boolean>")
    return where.join(flags, ["host", "id"]).select(
        "host", "shape_id", F.transform("slots", lambda k: F.get(F.col("flags"), k)).alias("content"))


def extract_text(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html).

    Null and empty pages, and pages without content, have an empty text; pages without a host (or
    url) share one; repeated rows give equal rows; an empty table gives no rows; other columns are
    not read.  Character references are decoded, white space in a block is one space, blocks are
    joined in page order by one.
    """
    pages = pages.select("page_id", "url", "html")
    content = staged(content_slots(pages, group), "content-slots")

    def run(batches):
        for batch in batches:
            keys, found = [], []
            for source in batch.column("html").to_pylist():
                tree, blocks = read_page(source)
                keys.append(_shape_id(tree))
                order = sorted((b.order, k, t) for k, of in enumerate(blocks) for b in of if (t := b.text()))
                found.append([{"slot": k, "text": t} for _, k, t in order])
            names = ["page_id", "url", "host"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(keys, pa.string()), pa.array(found, blocks_kind)],
                [*names, "shape_id", "blocks"])

    blocks_kind = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))
    hosted = _hosted(pages).withColumn("html", F.col("html").cast("string"))
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    read = hosted.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, host string, shape_id string, "
                                  "blocks array<struct<slot: int, text: string>>")
    joined = read.join(bounded_broadcast(content, content.count()), ["host", "shape_id"], "left")
    kept = F.filter("blocks", lambda b: F.coalesce(F.get(F.col("content"), b["slot"]), F.lit(False)))
    return joined.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), " ").alias("text"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its code points, as ``extract_text``."""
    return extract_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))
