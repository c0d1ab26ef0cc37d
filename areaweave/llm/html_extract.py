"""Main text of web pages, with site templates removed.

A page becomes a tree once, in the task that reads it.  What is no text, such as scripts and styles, is left
out.  Every subtree that could belong to the site's template is hashed, menus, headers and footers
among them; Spark counts the hashes per host over different texts beside them, and subtrees that
recur beside many are deleted.  Copies of one article count once, paragraphs and headings of an
article element are never template, and neither is elsewhere what holds over half of the text, so
an article that a host repeats stays.

Menus, sidebars, notices, adverts, forms, comments and the like need not recur.  What the counts leave of
them goes by its tag, role, class or id, which is a weaker sign: it says nothing where it only tells of a
state ("has-sidebar") or names a section of an article, and an element that holds the article, the main element
or, without being a list of links, most of the text stays whatever it is called.  Comments stay comments.

Of what is left, the text is that of the article element (the longest, if there are several), else
of the main element, else of the body without blocks that are mostly links.  Character references are decoded,
white space in a block becomes one space, blocks are joined by one space in page order.

Null and empty pages give an empty text; a null URL is a host of its own.  Every input row gives
one output row, repeated ids included.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areaweave.llm.common import drop_stored, new_folder, partitions_for, pick, stored

#: A subtree is template where it stands under so many different articles of a host, and so large a share of them.
LEAST_ARTICLES = 5
LEAST_SHARE = 0.05
#: Characters of the pages in a chunk, about.
CHUNK_CHARS = 4_000_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
#: Elements that hold no text of the page.
DROPPED = frozenset("head button select option template svg canvas object audio video map script style textarea title "
                    "noscript iframe noembed noframes".split())
#: Elements beside the main text; with a main element in them, they are not.
BESIDE = frozenset("nav footer aside menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of a class or id that mark boilerplate, those that mark readers' comments, and those by which it tells of a state.
MARKS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs header masthead topbar banner footer colophon sidebar "
    "aside widget widgets notice notices cookie cookies consent gdpr alert alerts ad ads advert adverts advertisement "
    "advertising sponsor sponsored sponsors promo promotion promoted discussion share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login popup modal overlay pagination pager toolbar skip "
    "copyright legal disclaimer".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
STATES = frozenset("has have with no not without is open closed enabled disabled on off".split())
#: Elements whose id names a section of an article.
SECTIONS = frozenset("section h1 h2 h3 h4 h5 h6 p dl dt".split())
CLOSED_BY = {  # an open element that a start tag ends
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th"}}
SCOPES = frozenset("article main body html table ul ol dl section div td th".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/a-zA-Z][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPLIT = re.compile(r"[^a-z0-9]+")


#: Why an element may be boilerplate: not at all, by its class, by its tag, as a comment.
PLAIN, MARKED, ASIDE, COMMENT = range(4)


class Element:
    __slots__ = ("tag", "parent", "children", "dropped", "role", "kind")

    def __init__(self, tag: str, parent: Element | None, kind: int = PLAIN, role: str = ""):
        self.tag, self.parent, self.children, self.role, self.kind = tag, parent, [], role, kind
        self.dropped = tag in DROPPED


def _marked(value: str) -> int:
    """What a class or id says: names of several words say nothing if they tell of a state."""
    kind = PLAIN
    for name in value.split():
        words = SPLIT.split(name)
        if STATES.isdisjoint(words):
            if not COMMENTS.isdisjoint(words):
                return COMMENT
            if not MARKS.isdisjoint(words):
                kind = MARKED
    return kind


def _boilerplate(tag: str, attributes: str, inside: bool) -> tuple[int, str]:
    """Why an element may be boilerplate, and its role; ``inside`` an article, a header is the article's own."""
    kind, role = ASIDE if tag in BESIDE else MARKED if tag in ("form", "fieldset") or (tag == "header" and not inside) else PLAIN, ""
    if attributes and "=" in attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            value, name = (a or b or c).lower(), name.lower()
            if name == "role":
                role = value
                kind = max(kind, MARKED if value in ROLES else PLAIN)
                continue
            found = _marked(value)
            if tag in ("html", "body", "main") or (tag == "article" and found != COMMENT):
                continue
            if found == MARKED and name == "id" and inside and tag in SECTIONS:
                continue
            kind = max(kind, found)
    return kind, role


def _judge(root: Element) -> None:
    """Elements that hold the article, the main element or most of the text are not boilerplate, whatever they are called."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if not isinstance(c, str) and not c.dropped]
    # Characters, those in links, and whether there is an article or a main element.
    sums: dict[int, list] = {}
    for node in reversed(order):
        own = [0, 0, node.tag == "article" and node.kind != COMMENT, node.tag == "main" or node.role == "main"]
        for c in node.children:
            if isinstance(c, str):
                own[0] += len(c.strip())
            elif not c.dropped:
                own = [x + y for x, y in zip(own, sums[id(c)])]
        if node.tag == "a":
            own[1] = own[0]
        sums[id(node)] = own
    total = sums[id(root)][0]
    for node in order:
        size, linked, articles, mains = sums[id(node)]
        inner = mains - (node.tag == "main" or node.role == "main")
        most = 2 * size > total and 2 * linked <= size
        if (node.kind == MARKED and (articles or inner or most)) or (node.kind == ASIDE and inner):
            node.kind = PLAIN


def parse(page: str) -> Element:
    """The tree of a page: children are elements and strings, with references decoded."""
    root = Element("#root", None)
    at, here, end = 0, root, len(page)
    position = 0
    while position < end:
        match = TOKEN.search(page, position)
        if match is None:
            here.children.append(html.unescape(page[at:]))
            return root
        if match.start() > at:
            here.children.append(html.unescape(page[at:match.start()]))
        at = position = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag = tag.lower()
        if match[1]:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            elif tag == "br":
                here.children.append(Element("br", here))
            continue
        if tag == "p" or tag not in INLINE:  # a block ends an open paragraph
            node = here
            while node is not root and node.tag not in SCOPES and node.tag != "p":
                node = node.parent
            if node.tag == "p" and tag != "br" and tag not in ("img", "wbr", "input", "button", "script", "style"):
                here = node.parent
        if tag in CLOSED_BY:
            node = here
            while node.tag in INLINE or node.tag == "p":
                node = node.parent
            if node.tag in CLOSED_BY[tag]:
                here = node.parent
        inside, node = False, here
        while node is not root and not inside:
            inside, node = node.tag == "article", node.parent
        kind, role = _boilerplate(tag, match[3] or "", inside)
        element = Element(tag, here, kind, role)
        here.children.append(element)
        if tag in RAW:
            close = re.compile(f"</{tag}\\b[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = position = close.end() if close else end
        elif tag not in VOID and not (match[3] or "").endswith("/"):
            here = element
    if at < end:
        here.children.append(html.unescape(page[at:]))
    return root


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def extract(page: str | None) -> tuple[list[dict], list[dict], int]:
    """Blocks of text, each with the hashes of the subtrees around it; what ``beside`` tells of them."""
    root = parse(page or "")
    _judge(root)
    blocks: list[list] = []  # text, characters in links, containers, article, main, body, whether in boilerplate
    parts: list[str] = []
    linked = 0
    open_: list[int] = []  # numbers of containers
    members: list[list[int]] = []  # blocks of each container
    tags: list[str] = []
    numbers = [0, 0, 0]  # articles, mains and bodies so far
    place = (-1, -1, -1)
    depth = 0  # of elements that may be boilerplate

    def close() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            for c in open_:
                members[c].append(len(blocks))
            blocks.append([text, linked, list(open_), *place, depth > 0])
        parts, linked = [], 0

    stack: list = [("in", root, False)]
    while stack:
        what, node, link = stack.pop()
        if what == "text":
            parts.append(node)
            linked += len(node.strip()) if link else 0
        elif what == "out":
            close()
            candidate, place, depth = node
            if candidate:
                open_.pop()
        else:
            scope = (0 if node.tag == "article" else 1 if node.tag == "main" or node.role == "main"
                     else 2 if node.tag == "body" else None)
            outer = scope is not None and place[scope] < 0
            # Paragraphs and headings of an article are its text; any other block may be template.
            candidate = node.tag not in INLINE and not outer and node.tag not in ("#root", "html", "br") and (
                place[0] < 0 or depth > 0 or node.kind > PLAIN
                or node.tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"))
            if node.tag not in INLINE or outer:
                close()
                stack.append(("out", (candidate, place, depth), False))
            depth += node.kind > PLAIN
            if outer:
                place = (*place[:scope], numbers[scope], *place[scope + 1:])
                numbers[scope] += 1
            if candidate:
                open_.append(len(members))
                members.append([])
                tags.append(node.tag)
            link = link or node.tag == "a"
            for c in reversed(node.children):
                if isinstance(c, str):
                    stack.append(("text", c, link))
                elif not c.dropped and not (c.kind and c.tag in INLINE):
                    stack.append(("in", c, link))
    close()
    hashes = [_digest(tag + "\0" + "\0".join(blocks[i][0] for i in held)) for tag, held in zip(tags, members, strict=True)]
    found = [{"text": b[0], "linked": b[1], "around": sorted({hashes[c] for c in b[2]}), "article": b[3], "main": b[4],
              "body": b[5], "aside": b[6]} for b in blocks]
    return found, *beside(found)


def beside(blocks: list[dict]) -> tuple[list[dict], int]:
    """Subtrees that may be template, each with a digest of the longest text outside it; the article's digest."""
    inner = [b for b in blocks if not b["aside"]]
    own = any(not b["around"] and b["article"] >= 0 for b in inner)
    mains = ({i for i, b in enumerate(blocks) if b["main"] >= 0 and not b["aside"]}
             or {i for i, b in enumerate(blocks) if not b["aside"]})
    rank = sorted(range(len(blocks)), reverse=True, key=lambda i: (
        not blocks[i]["aside"], not blocks[i]["around"], blocks[i]["main"] >= 0, len(blocks[i]["text"])))
    total = sum(len(blocks[i]["text"]) for i in mains)
    members: dict[int, set[int]] = {}
    for i, b in enumerate(blocks):
        for h in b["around"]:
            members.setdefault(h, set()).add(i)
    found = []
    for h, held in members.items():
        context = next((i for i in rank if i not in held), None)
        # Outside articles, what holds over half of the text is not a template around it.
        if context is not None and (own or 2 * sum(len(blocks[i]["text"]) for i in held & mains) <= total):
            found.append({"hash": h, "context": _digest(blocks[context]["text"])})
    return found, _digest(blocks[rank[0]]["text"] if rank else "")


def main_text(blocks: list[dict]) -> str:
    """Text of the longest article, else of the longest main element, else of the body without blocks that are mostly links."""
    blocks = [b for b in blocks if not b["aside"]]
    for scope in ("article", "main"):
        texts: dict[int, list[str]] = {}
        for b in blocks:
            if b[scope] >= 0:
                texts.setdefault(b[scope], []).append(b["text"])
        if texts:
            return " ".join(max(texts.values(), key=lambda t: sum(map(len, t))))
    body = [b for b in blocks if b["body"] >= 0] or blocks
    return " ".join(b["text"] for b in body if 2 * b["linked"] <= len(b["text"]))


BLOCK = pa.struct([("text", pa.string()), ("linked", pa.int64()), ("around", pa.list_(pa.int64())), ("article", pa.int64()),
                   ("main", pa.int64()), ("body", pa.int64()), ("aside", pa.bool_())])
SUBTREE = pa.struct([("hash", pa.int64()), ("context", pa.int64())])
SUBTREES = "array<struct<hash long, context long>>"


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages side by side in chunks: their columns as arrays."""
    from pyspark import TaskContext

    task, nth, size, kinds = TaskContext.get().partitionId(), 0, 0, None
    names = ["page_id", "url", "identity", "text", "blocks", "subtrees"]
    columns: list[list] = [[] for _ in names]

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([f"{task}-{nth}"]), *[pa.array([c], pa.list_(k)) for c, k in zip(columns, kinds, strict=True)]], ["chunk", *names])

    for batch in batches:
        kinds = [batch.schema.field("page_id").type, pa.string(), pa.int64(), pa.string(), pa.list_(BLOCK), pa.list_(SUBTREE)]
        for page_id, url, page in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
            page = page.as_py()
            found, around, identity = extract(page)
            row = (page_id.as_py(), url.as_py(), identity, None if around else main_text(found), found if around else [], around)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            size += len(page or "")
            if size >= CHUNK_CHARS:
                yield flush()
                columns, size, nth = [[] for _ in names], 0, nth + 1
    if columns[0]:
        yield flush()


def _left(batch: pa.RecordBatch, row: int) -> Iterator[tuple[int, list[dict]]]:
    """A chunk's pages with blocks, less those in subtrees that are gone."""
    gone = {x["nth"]: set(x["gone"]) for x in batch.column("gone")[row].as_py() or ()}
    for nth, found in enumerate(batch.column("blocks")[row].values):
        if len(found):
            out = gone.get(nth, set())
            yield nth, [b for b in found.as_py() if out.isdisjoint(b["around"])]


def _beside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``beside`` tells of what is left of the pages."""
    for batch in batches:
        for row in range(batch.num_rows):
            left = [(nth, beside(blocks)[0]) for nth, blocks in _left(batch, row)]
            urls = batch.column("url")[row].values
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("chunk").slice(row, 1).to_pylist() * len(left), pa.string()),
                 pa.array([nth for nth, _ in left], pa.int32()), urls.take(pa.array([nth for nth, _ in left], pa.int32())),
                 pa.array([subtrees for _, subtrees in left], pa.list_(SUBTREE))], ["chunk", "nth", "url", "subtrees"])


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            texts = batch.column("text")[row].as_py()
            for nth, blocks in _left(batch, row):
                texts[nth] = main_text(blocks)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id")[row].values, batch.column("url")[row].values, pa.array(texts, pa.string())],
                ["page_id", "url", "text"])


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
                  least_articles: int = LEAST_ARTICLES, least_share: float = LEAST_SHARE) -> DataFrame:
    """page_id, url, text of every row.

    Counts go round by round: what is deleted no longer stands beside the rest, and no longer counts as it.
    """
    rows = pick(pages, page_id=id_column, url=url_column, html=html_column)
    kind = rows.schema["page_id"].dataType.simpleString()
    # A table bucketed by chunk: what is gone is dealt to the blocks, which are written once and stay where they are.
    name, spark = f"areaweave_pages_{uuid.uuid4().hex}", pages.sparkSession
    (rows.mapInArrow(_parsed, f"chunk string, page_id array<{kind}>, url array<string>, identity array<bigint>, text array<string>, "
                     "blocks array<array<struct<text string, linked long, around array<bigint>, article long, main long, body long, "
                     f"aside boolean>>>, subtrees array<{SUBTREES}>").write
     .bucketBy(partitions_for(pages, html_column, 30, least=8), "chunk")
     .option("path", new_folder(spark, "pages")).option("compression", "zstd").saveAsTable(name))
    chunks = spark.table(name)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)", 1)).alias("host")
    parsed = chunks.select("chunk", F.posexplode(F.arrays_zip("url", "identity", "subtrees")).alias("nth", "page"))
    parsed = parsed.select("chunk", "nth", "page.*")
    articles = parsed.select(host, "identity").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    left, gone = parsed.select("chunk", "nth", host, "subtrees"), None

    def dealt(columns: list[str]) -> DataFrame:
        if gone is None:
            return chunks.select(*columns, F.lit(None).cast("array<struct<nth int, gone array<bigint>>>").alias("gone"))
        own = gone.groupBy("chunk").agg(F.collect_list(F.struct("nth", "gone")).alias("gone"))
        return chunks.select("chunk", *columns).join(own, "chunk", "left")

    # What is gone no longer stands beside the rest, so that is counted again.
    while True:
        around = left.select("host", F.explode("subtrees").alias("s")).select("host", "s.hash", "s.context")
        often = around.distinct().groupBy("host", "hash").agg(F.count("*").alias("n")).join(articles, "host")
        often = often.where((F.col("n") >= least_articles) & (F.col("n") >= least_share * F.col("articles")))
        often = stored(often.select("host", "hash"), "often")
        if not often.head(1):
            drop_stored(often)
            break
        deleted = left.select("chunk", "nth", "host", F.explode("subtrees.hash").alias("hash"))
        deleted = deleted.join(often, ["host", "hash"], "left_semi").select("chunk", "nth", "hash")
        if gone is not None:
            deleted = deleted.union(gone.select("chunk", "nth", F.explode("gone").alias("hash")))
        before = [often] if gone is None else [often, left, gone]
        gone = stored(deleted.groupBy("chunk", "nth").agg(F.collect_set("hash").alias("gone")), "gone", compression="zstd")
        left = stored(dealt(["url", "blocks"]).mapInArrow(_beside, f"chunk string, nth int, url string, subtrees {SUBTREES}")
                      .select("chunk", "nth", host, "subtrees"), "left", compression="zstd")
        for frame in before:
            drop_stored(frame)
    return dealt(["page_id", "url", "text", "blocks"]).mapInArrow(_texts, f"page_id {kind}, url string, text string")
