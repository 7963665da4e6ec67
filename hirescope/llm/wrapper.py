"""Main text of web pages by wrapper induction.

1. A few pages of each host are parsed and their DOM trees merged by simple
   tree matching into the host's wrapper: a tree of slots, in which a run of
   equal siblings is one repeated slot.
2. Every page is aligned with its host's wrapper, which gives each text block
   the slot it stands in.
3. Over all pages of a host, a text that recurs in the same slot on most
   pages that differ from each other is part of the template; what varies is
   content.

Elements whose tag, role, class or id says what they are (menus, footers,
adverts, forms, comments, ...) are no content wherever they stand, and where a
page marks its article, only the article is.
"""

from __future__ import annotations

import heapq
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import map_texts, materialise, text_batches

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
                  r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("html body address article aside blockquote button caption center dd details dialog div dl dt "
                  "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr legend li main menu nav "
                  "ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: No content wherever they stand.
DROPPED_TAGS = frozenset("aside audio button canvas datalist dialog embed fieldset footer form head iframe input "
                         "label legend map menu nav noscript object option script select style svg template "
                         "textarea title video".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                          "search toolbar".split())
DROPPED_NAMES = frozenset("ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs "
                          "comment comments commentlist consent cookie cookies copyright disqus footer gdpr login "
                          "masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted "
                          "related recommended replies respond reply search share sharing sidebar signup social "
                          "sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
ARTICLE = frozenset(["article", "main"])
#: What the start of an element closes, up to the nearest element of the second set.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
           "option": ({"option"}, {"select"})}
DEPTH = 64


class Node:
    """A block element; deeper than DEPTH, text belongs to the ancestor there."""

    __slots__ = ("label", "kids", "slot")

    def __init__(self, label: str):
        self.label, self.kids, self.slot = label, [], -1


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v[1:-1] if v[:1] in "\"'" and v else v) for k, v in _ATTR.findall(raw)}


def _dropped(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in DROPPED_TAGS or (tag == "header" and not in_article):
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if attrs.get("role", "").lower() in DROPPED_ROLES or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    if tag in ARTICLE or tag in ("html", "body"):
        return False
    return not DROPPED_NAMES.isdisjoint(_WORDS.findall((attrs.get("class", "") + " " + attrs.get("id", "")).lower()))


def parse(source: str) -> tuple[Node, list[tuple[Node, bool, bool, str]]]:
    """DOM of the block elements, and the text blocks in page order: the
    element they stand in, whether inside an article, whether mostly links."""
    root = Node("#")
    # (tag, node, is block, is dropped, is article, is link)
    stack: list[tuple[str, Node, bool, bool, bool, bool]] = [("#", root, True, False, False, False)]
    dropped = article = link = 0
    out: list[tuple[Node, bool, bool, str]] = []
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append((stack[-1][1], article > 0, 2 * linked > len(text), text))
            pieces.clear()
            linked = 0

    def pop_to(size: int) -> None:
        nonlocal dropped, article, link
        while len(stack) > size:
            if stack[-1][2]:
                flush()
            _, _, _, d, a, k = stack.pop()
            dropped -= d
            article -= a
            link -= k

    at, n = 0, len(source)
    while at < n:
        m = _TAG.search(source, at)
        end = m.start() if m else n
        if end > at and not dropped:
            pieces.append(source[at:end])
            if link:
                linked += end - at
        if not m:
            break
        at = m.end()
        close, name, raw = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not name:
            continue
        tag = name.lower()
        if close:
            block = tag in BLOCK
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
                if not block and stack[i][2]:
                    break
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            at = stop.end() if stop else n
            continue
        if tag == "br":
            if not dropped:
                pieces.append(" ")
            continue
        if tag in IMPLIED:
            closes, until = IMPLIED[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in until:
                    break
                if stack[i][0] in closes:
                    pop_to(i)
        block = tag in BLOCK
        if block:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    pop_to(i)
                    break
                if stack[i][2]:
                    break
            flush()
        if tag in VOID or raw.endswith("/") and not block:
            continue
        attrs = _attributes(raw) if raw.strip() else {}
        drop = _dropped(tag, attrs, article > 0)
        node = stack[-1][1]
        if block and not dropped and len(stack) < DEPTH:
            names = ".".join(sorted(set(_WORDS.findall(attrs.get("class", "").lower()))))
            child = Node(f"{tag}.{names}" if names else tag)
            node.kids.append(child)
            node = child
        is_article = not drop and (tag in ARTICLE or attrs.get("role", "").lower() in ("main", "article"))
        stack.append((tag, node, block, drop, is_article, tag == "a"))
        dropped += drop
        article += is_article
        link += tag == "a"
    pop_to(1)
    flush()
    return root, out


def _runs(kids: list[Node]) -> list[list[Node]]:
    """Children with equal siblings in a row taken together."""
    out: list[list[Node]] = []
    for kid in kids:
        if out and out[-1][0].label == kid.label:
            out[-1].append(kid)
        else:
            out.append([kid])
    return out


def match_children(kids: list[Node], slots: list[Node]) -> tuple[int, list[tuple[list[Node], Node | None]]]:
    """Simple tree matching of two ordered lists of subtrees: the most nodes
    that match, in order, and for each run of ``kids`` its slot."""
    runs = _runs(kids)
    a, b = len(runs), len(slots)
    if not a or not b:
        return 0, [(r, None) for r in runs]
    weight = [[tree_match(r[0], s) if r[0].label == s.label else 0 for s in slots] for r in runs]
    best = [[0] * (b + 1) for _ in range(a + 1)]
    for i in range(1, a + 1):
        row, above, w = best[i], best[i - 1], weight[i - 1]
        for j in range(1, b + 1):
            row[j] = max(above[j], row[j - 1], above[j - 1] + w[j - 1] if w[j - 1] else 0)
    pairs: list[tuple[list[Node], Node | None]] = []
    i, j = a, b
    while i:
        if j and weight[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weight[i - 1][j - 1]:
            pairs.append((runs[i - 1], slots[j - 1]))
            i, j = i - 1, j - 1
        elif j and best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs.append((runs[i - 1], None))
            i -= 1
    return best[a][b], pairs[::-1]


def tree_match(node: Node, slot: Node) -> int:
    """Nodes in the largest order-keeping match of two trees of equal root."""
    if not node.kids or not slot.kids:
        return 1
    return 1 + match_children(node.kids, slot.kids)[0]


def merge(wrapper: Node, page: Node) -> None:
    """Widen the wrapper by what the page has beyond it."""
    _, pairs = match_children(page.kids, wrapper.kids)
    at = 0
    for run, slot in pairs:
        if slot is None:
            slot = Node(run[0].label)
            wrapper.kids.insert(at, slot)
            at += 1
        else:
            at = next(i for i, s in enumerate(wrapper.kids) if s is slot) + 1
        for node in run:
            merge(slot, node)


def align(page: Node, wrapper: Node) -> None:
    """Give the page's nodes the numbers of their slots."""
    page.slot = wrapper.slot
    for run, slot in match_children(page.kids, wrapper.kids)[1]:
        if slot is not None:
            for node in run:
                align(node, slot)


def _pack(node: Node) -> list:
    return [node.label, [_pack(k) for k in node.kids]]


def _unpack(data: list, number: Iterator[int]) -> Node:
    node = Node(data[0])
    node.slot = next(number)
    node.kids = [_unpack(k, number) for k in data[1]]
    return node


def wrapper_of(pages: list[str]) -> str:
    """The wrapper of some pages of one host, as JSON."""
    root = Node("#")
    for page in pages:
        merge(root, parse(page)[0])
    return json.dumps(_pack(root))


def load_wrapper(data: str) -> Node:
    count = iter(range(1 << 30))
    return _unpack(json.loads(data), count)


def _least(per_host: int, limit: int = 64 << 20):
    """Per task, the pages of least hash of each host."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {}
        size = 0

        def out():
            rows = [(h, -x, p) for h, heap in kept.items() for x, p in heap]
            cols = list(zip(*rows)) if rows else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                               pa.array(cols[2], pa.string())], names=["host", "h", "html"])
        for hosts, hashes, pages in text_batches(batches, (0, 1, 2), 2, 8 << 20):
            for host, h, page in zip(hosts, hashes, pages):
                heap = kept.setdefault(host, [])
                item = (-h, page)
                if item in heap:  # a copy teaches nothing
                    continue
                if len(heap) < per_host:
                    heapq.heappush(heap, item)
                    size += len(page)
                elif item > heap[0]:
                    size += len(page) - len(heapq.heappushpop(heap, item)[1])
            if size > limit:
                yield out()
                kept, size = {}, 0
        yield out()
    return run


def _induce(per_host: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[str, dict] = {}
        for batch in batches:
            for host, h, page in zip(*(c.to_pylist() for c in batch.columns)):
                have = by.setdefault(host, {})
                have[h] = page
                if len(have) > 4 * per_host:
                    by[host] = dict(sorted(have.items())[:per_host])
        hosts = sorted(by)
        made = [wrapper_of([p for _, p in sorted(by[h].items())[:per_host]]) for h in hosts]
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(made, pa.string())],
                                         names=["host", "wrapper"])
    return run


_BLOCKS = "blocks array<struct<slot:int,text:string>>"


def _blocks():
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))
    known: dict[str, Node] = {}

    def one(page: str | None, data: str | None) -> list[dict]:
        if not page:
            return []
        root, blocks = parse(page)
        if data:
            if len(known) > 200:
                known.clear()
            if data not in known:
                known[data] = load_wrapper(data)
            align(root, known[data])
        if any(inside for _, inside, _, _ in blocks):
            blocks = [b for b in blocks if b[1]]
        else:
            blocks = [b for b in blocks if not b[2]]
        return [{"slot": node.slot, "text": text} for node, _, _, text in blocks]

    return lambda pages, wrappers: [pa.array([one(p, w) for p, w in zip(pages, wrappers)], kind)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            per_host: int = 8, most: float = 0.5, least_pages: int = 3, salts: int = 16) -> DataFrame:
    """Main text of every page: ``page_id, url, text``, blocks joined by a
    line feed, empty if there is none.

    A host's wrapper is induced from the ``per_host`` pages of least hash; the
    template is judged over all pages: a block goes if its text stands in the
    same slot on at least ``least_pages`` pages and on the share ``most`` of
    the host's, copies of a page counted once.  Hosts of any size are dealt
    over ``salts`` groups wherever pages meet their host's data.

    Null or empty html gives an empty text; null urls share one host; null
    ids and repeated rows are kept; other columns of ``pages`` are not read.
    """
    url = F.col(url_col).cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][-+.a-zA-Z0-9]*://([^/?#]*)", 1)), F.lit(""))
    text = F.col(html_col).cast("string")
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host.alias("host"),
                       F.xxhash64(text).alias("h"), text.alias("html"))
    sample = src.where(F.length("html") > 0).select("host", "h", "html").mapInArrow(
        _least(per_host), "host string, h long, html string")
    wrappers = materialise(sample.repartition("host").mapInArrow(_induce(per_host), "host string, wrapper string"))
    salted = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = (src.withColumn("salt", F.pmod("h", F.lit(salts)).cast("int")).join(salted, ["host", "salt"], "left"))
    cut = materialise(
        map_texts(met, "html", ["page_id", "url", "host", "salt"], _BLOCKS, _blocks, extra=("wrapper",), limit=2 << 20)
        .select("row.*", "blocks"))
    # Distinct pages by content, so that copies don't make their own text a template.
    signed = cut.select("host", F.xxhash64(F.col("blocks.text")).alias("page"), "blocks").where(F.size("blocks") > 0)
    total = signed.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(F.sum("one").alias("pages"))
    recurring = (signed.select("host", "page", F.explode("blocks").alias("b"))
                 .select("host", F.col("b.slot").alias("slot"), F.xxhash64("b.text").alias("t"), "page")
                 .where("slot >= 0").distinct().groupBy("host", "slot", "t").agg(F.count(F.lit(1)).alias("n")))
    # Written, so that the planner knows its size and need not shuffle the texts to meet a small table.
    template = materialise(recurring.where(F.col("n") >= least_pages).join(total, "host")
                           .where(F.col("n") >= F.col("pages") * most)
                           .groupBy("host").agg(F.collect_list(F.xxhash64("slot", "t")).alias("template")))
    joined = cut.join(template.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))),
                      ["host", "salt"], "left")
    varying = F.filter("blocks", lambda b: F.col("template").isNull() | (b["slot"] < 0) | ~F.array_contains(
        "template", F.xxhash64(b["slot"], F.xxhash64(b["text"]))))
    return joined.select("page_id", "url", F.array_join(F.transform(varying, lambda b: b["text"]), "\n").alias("text"))
