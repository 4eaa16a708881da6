"""Main text of web pages: site templates and page furniture go, the article's blocks stay.

Pages are read tag by tag into a tree. The subtree of each container outside paragraphs is hashed with its
tags, marks and text; Spark counts, per host, the pages on which a hash recurs, and subtrees that recur
on many pages of their host are template and deleted. Furniture (menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts) is known by element and by class, id or role; a class word deletes no
article or main element and no wrapper of one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reviewlake.llm.batches import column, cut, fresh, map_texts, without
from reviewlake.llm.url_rules import url_host

#: A subtree is template if it recurs on at least so many pages of its host, and on at least this share of them.
MIN_PAGES, MIN_SHARE = 5, 0.05
#: At most so many template hashes are sent to every task; more are joined to the pages instead.
BROADCAST_TEMPLATES = 500_000

#: HTML's elements without content, with raw text, and of block layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
            "thead tr ul".split())
#: Elements that end an open element of the listed kinds (the start tag of the key closes them).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: Furniture by element, and by a word of class, id or role.
FURNITURE = set("script style noscript template nav aside footer form button select textarea iframe svg canvas object audio video dialog menu head title input".split())
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|notification|alert|newsletter|subscribe|subscription|sidebar|"
    r"side-?bar|menu|nav|navbar|navigation|breadcrumbs?|footer|comments?|replies|reply|disqus|respond|share|sharing|social|related|recommended|popup|modal|"
    r"widget|login|signup|search|searchbox|pagination|pager|toolbar|skip|contentinfo|complementary|hidden)(?:$|[\s_-])", re.I)
#: Furniture outside an article only: inside, a header holds its title.
OUTER = re.compile(r"(?:^|[\s_-])(?:header|masthead|topbar|logo)(?:$|[\s_-])", re.I)
#: What a class has or lacks is not what its element is: the rest of the class name behind these words counts for nothing.
MODIFIED = re.compile(r"(?:^|(?<=[\s_-]))(?:with|without|has|have|no|non)[_-]\S*", re.I)
#: Elements that hold articles go by these words only, and only if the page has an article elsewhere (comments and teasers may be articles).
APART = re.compile(r"(?:^|[\s_-])(?:comments?|replies|reply|disqus|respond|related|recommended)(?:$|[\s_-])", re.I)
#: Elements whose subtrees may be template.
CONTAINERS = set("div section ul ol dl table header center figure details fieldset tr li dd dt".split())

#: A quote opens a value only behind an equals sign; elsewhere, as in ``title=it's``, it is a character like any other.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)", re.S)
#: A last tag that is cut off, perhaps inside a quoted value.
_OPEN_TAG = re.compile(r"</?[a-zA-Z][^>]*\Z")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
#: What a form around a whole page holds, and a form of the page does not.
FRAME = set("h1 nav".split())
#: Elements that the search for an open item, its list or an open paragraph may stop at; all others are skipped at once.
_ANCHORS = set("p article body button table ul ol menu dl select".split()) | set(CLOSES)


class _Node:
    __slots__ = ("tag", "marks", "parent", "parts", "article", "hash", "gone", "marked", "main", "holds", "frames", "anchor")

    def __init__(self, tag: str, marks: str, parent: _Node | None) -> None:
        self.tag, self.marks, self.parent, self.parts = tag, marks, parent, []
        self.main = tag in ("article", "main") or "main" in marks.split()
        self.article = self.main or (parent is not None and parent.article)
        self.holds = False  # an article or main part, at any depth
        plain = _plain(marks)
        self.marked = bool(plain) and not self.main and bool(MARKS.search(plain) or (not self.article and OUTER.search(plain)))
        self.gone = self.marked or tag in FURNITURE or _HIDDEN in marks or (tag == "header" and not self.article)
        self.hash = 0
        self.frames = False  # a page's own parts, at any depth
        self.anchor = parent if parent is None or parent.tag in _ANCHORS else parent.anchor
        if self.main:
            up = parent
            while up is not None and not up.holds:
                up.holds = True
                up = up.parent
        if tag in FRAME:
            up = parent
            while up is not None and not up.frames:
                up.frames = True
                up = up.parent


#: Stands among the marks for the attribute ``hidden``.
_HIDDEN = "[hidden]"


def _plain(marks: str) -> str:
    """The marks without modified words."""
    return MODIFIED.sub("", marks) if marks else marks


def _spare_articles(root: _Node) -> None:
    """Takes back that elements which hold an article or main part are furniture by a class word (see ``APART``), and that a form
    around an article or around a page's own parts is a form."""
    nodes = list(_walk(root)) if root.holds or root.frames else []
    apart = {id(n) for n in nodes if n.marked and n.holds and APART.search(_plain(n.marks))}
    elsewhere = False
    for node in nodes if apart else ():
        if node.tag == "article" and not elsewhere:
            up = node
            while up is not None and id(up) not in apart:
                up = up.parent
            elsewhere = up is None
    for node in nodes:
        shell = node.tag == "form" and (node.holds or node.frames)
        spared = node.marked and node.holds and not (elsewhere and id(node) in apart)
        if shell or spared:
            by_element = (node.tag in FURNITURE and not shell) or (node.tag == "header" and not node.article)
            node.gone = by_element or _HIDDEN in node.marks or (node.marked and not spared)


def _attributes(text: str) -> str:
    found = []
    for name, a, b, c in _ATTR.findall(text):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            found.append(_HIDDEN)
        elif name in ("class", "id", "role"):
            found.append(value)
    return " ".join(f for f in found if f)


def _open_anchor(node: _Node | None, wanted, stop) -> _Node | None:
    """The nearest open element from ``node`` up whose tag is in ``wanted``, unless one in ``stop`` stands before it."""
    up = node if node is None or node.tag in _ANCHORS else node.anchor
    while up is not None and up.tag not in wanted:
        if up.tag in stop:
            return None
        up = up.anchor
    return up


def parse(page: str) -> _Node:
    """The page's tree: nodes hold text pieces and child nodes. Unclosed and misplaced tags are mended as
    browsers do in the common cases: implied ends, void elements, stray end tags; a cut last tag is dropped."""
    root = _Node("html", "", None)
    node, at, n = root, 0, len(page)
    opened: dict[str, int] = {}  # open elements per tag, so that a stray end tag costs nothing

    def close(to: _Node) -> _Node:
        up = node
        while up is not to:
            opened[up.tag] -= 1
            up = up.parent
        return to

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            rest = page[at:]
            cut_tag = _OPEN_TAG.search(rest)
            node.parts.append(rest[:cut_tag.start()] if cut_tag else rest)
            break
        if m.start() > at:
            node.parts.append(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        if page[at - 1] != ">":  # cut off inside the tag
            break
        tag = tag.lower()
        if m.group(1):
            if opened.get(tag):
                up = node
                while up.tag != tag:
                    up = up.parent
                node = close(up.parent)
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCK and opened.get("p"):
            up = _open_anchor(node, ("p",), ("article", "body", "button", "td", "th", "table"))
            if up is not None:
                node = close(up.parent)
        if tag in CLOSES and any(opened.get(t) for t in CLOSES[tag]):
            up = _open_anchor(node, CLOSES[tag], _SCOPE[tag])
            while up is not None and up.tag in CLOSES[tag]:
                node = close(up.parent)
                up = node
        child = _Node(tag, _attributes(m.group(3)) if "=" in m.group(3) or "hidden" in m.group(3) else "", node)
        node.parts.append(child)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = n if end is None else page.find(">", end.start()) + 1 or n
            continue
        if not m.group(3).endswith("/") or tag in BLOCK:
            node = child
            opened[tag] = opened.get(tag, 0) + 1
    _spare_articles(root)
    return root


def _walk(root: _Node) -> Iterator[_Node]:
    """All nodes, children before parents, without recursion."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(p for p in node.parts if not isinstance(p, str))
    return reversed(order)


def hash_subtrees(root: _Node) -> None:
    for node in _walk(root):
        inner = [p.strip() if isinstance(p, str) else f"\x00{p.hash:x}" for p in node.parts]
        node.hash = xxhash.xxh64_intdigest("\x01".join([node.tag, node.marks, *[i for i in inner if i]]).encode("utf-8", "surrogatepass"))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _may_be_template(node: _Node) -> bool:
    """Containers, but in an article no single rows: only its lists, tables and sections."""
    return node.tag in CONTAINERS and not (node.article and node.tag in ("li", "tr", "dd", "dt"))


def blocks(root: _Node, template: set[int] | None = None) -> list[str]:
    """The text blocks that stay, in page order: of the articles (or main part) if there are any, else of the page."""
    whole = not any(node.article for node in _walk(root))
    found: list[str] = []
    pieces: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            found.append(text)
        pieces.clear()

    stack: list[tuple] = [(root, iter(root.parts))]
    while stack:
        node, rest = stack[-1]
        part = next(rest, None)
        if part is None:
            stack.pop()
            if node.tag in BLOCK:
                flush()
        elif isinstance(part, str):
            if whole or node.article:
                pieces.append(part)
        elif part.tag == "br":
            pieces.append(" ")
        elif part.gone or (template and _may_be_template(part) and _signed(part.hash) in template):
            if part.tag in BLOCK:
                flush()
        else:
            if part.tag in BLOCK:
                flush()
            stack.append((part, iter(part.parts)))
    flush()
    return found


def _candidates(root: _Node) -> tuple[set[int], int]:
    """Hashes of the subtrees that may be template, and the page's mark: the hash of all its blocks.

    Copies of a page have one mark, so that copies do not make their common text template; pages that share
    only some blocks, however long, have marks of their own. In an article
    only lists, tables and sections count, not its single rows."""
    hash_subtrees(root)
    out = set()
    for node in _walk(root):
        if not node.gone and _may_be_template(node):
            out.add(_signed(node.hash))
    text = "\n".join(blocks(root))
    return out, _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))


def site_templates(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(host, subtree): subtrees that recur on many pages of their host (``MIN_PAGES``, ``MIN_SHARE``).

    Pages of a host are counted by the hash of their text, so that copies count once. The distinct rows are
    pre-aggregated by Spark before the shuffle, so that a host with a third of all pages is no hot key.
    """
    rows = pages.select(url_host(column(url_col).cast("string")).alias("host"), column(html_col).cast("string").alias("html"))
    schema = StructType([StructField("host", StringType()), StructField("mark", LongType()), StructField("subtree", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, marks, trees = [], [], []
            for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found, mark = _candidates(parse(page or ""))
                found.add(0)  # stands for the page itself
                hosts += [host] * len(found)
                marks += [mark] * len(found)
                trees += found
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(marks, pa.int64()), pa.array(trees, pa.int64())], names=schema.names)

    counts = rows.mapInArrow(run, schema).distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    counts = cut(counts.where(F.col("n") >= MIN_PAGES))
    whole = counts.where("subtree = 0").select("host", F.col("n").alias("whole"))
    return counts.where("subtree <> 0").join(whole, "host").where(F.col("n") >= MIN_SHARE * F.col("whole")).select("host", "subtree")


def extract_text(pages: DataFrame, html_col: str = "html", url_col: str = "url", keep: list[str] | None = None,
                 broadcast_limit: int = BROADCAST_TEMPLATES) -> DataFrame:
    """Adds ``text`` (blocks joined by a line feed) and ``n_chars`` (its code points).

    Null and empty pages give an empty text. White space inside a block, ``br`` too, becomes one space;
    character references are decoded. Pages without an article or main element keep all that is neither
    furniture nor template. Copies get equal texts on equal hosts; rows stay as they are. Input columns
    named like an output give way to it. Templates are sent to the tasks up to ``broadcast_limit`` (their
    number is counted first); beyond it they are joined to the pages by host and page hash.
    """
    templates = cut(site_templates(pages, html_col, url_col))
    out = [StructField("text", StringType()), StructField("n_chars", LongType())]
    kept = [c for c in without(pages, ["text", "n_chars"]) if keep is None or c in keep]
    host, page = url_host(column(url_col).cast("string")), F.coalesce(column(html_col).cast("string"), F.lit(""))
    if templates.count() <= broadcast_limit:
        by_host: dict[str, set[int]] = {}
        for r in templates.collect():
            by_host.setdefault(r["host"], set()).add(r["subtree"])
        shared = pages.sparkSession.sparkContext.broadcast(by_host)
        rows = pages.withColumn(fresh(pages, "__page"), F.concat(host, F.lit("/"), page))  # a host holds no slash
        return map_texts(rows, fresh(pages, "__page"), _extractor(lambda sign: shared.value.get(sign)), out, kept)
    keyed = pages.select(*[column(c).alias(f"c{i}") for i, c in enumerate(pages.columns)], host.alias("__host"), page.alias("__html"),
                         F.xxhash64(page).alias("__key"))
    schema = StructType([StructField("__host", StringType()), StructField("__key", LongType()), StructField("subtree", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, k, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                trees = list(_candidates(parse(t))[0])
                yield pa.RecordBatch.from_arrays([pa.array([h] * len(trees), pa.string()), pa.array([k] * len(trees), pa.int64()), pa.array(trees, pa.int64())], names=schema.names)

    found = keyed.select("__host", "__key", "__html").mapInArrow(run, schema).distinct()
    found = found.join(templates.withColumnRenamed("host", "__host"), ["__host", "subtree"])
    hits = found.groupBy("__host", "__key").agg(F.array_join(F.collect_list(F.col("subtree").cast("string")), ",").alias("__hits"))
    rows = keyed.join(hits, ["__host", "__key"], "left")
    rows = rows.withColumn("__page", F.concat(F.coalesce("__hits", F.lit("")), F.lit("/"), F.col("__html")))
    rows = rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(pages.columns)], "__page")
    return map_texts(rows, "__page", _extractor(lambda sign: {int(x) for x in sign.split(",") if x}), out, kept)


def _extractor(templates_of):
    """Reads ``sign/page``: what names the page's templates, and the page."""

    def setup():
        def run(texts: list) -> list:
            done = []
            for t in texts:
                sign, _, page = t.partition("/")
                done.append(_text(page, templates_of(sign)))
            return [pa.array(done, pa.string()), pa.array([len(t) for t in done], pa.int64())]

        return run

    return setup


def _text(page: str, template: set[int] | None) -> str:
    root = parse(page)
    if template:
        hash_subtrees(root)
    return "\n".join(blocks(root, template))
