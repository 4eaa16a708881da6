"""Landed review pages to review rows.

The crawlers read fields out of live pages with a browser. Here landed
HTML (``page_id, url, html``) is parsed by native functions inside the
scan stage: the review container is cut out, split into blocks, and each
block's text is taken with its tags removed. The patterns are a per-site
rule; none needs look-around, so they read the same in Java and RE2.

A pattern cannot find the end of an element that holds its like. Where a
rule says ``Element``, the tags of that kind become a list of tokens and
the running depth over it finds the matching end (``element``) or the
direct items of a list (``list_items``), so nested lists and boxes lose
nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.casts import ten_point_to_five
from reviewlake.functions.dates import first_token, relative_to_date_text
from reviewlake.functions.files import decode_name
from reviewlake.functions.tags import clean_tags, tags_literal
from reviewlake.functions.text import has_reviewer, strip_ws


@dataclass(frozen=True)
class Element:
    """An element by its opening tag (a pattern without groups) and the kinds of tags that nest in it (``ul|ol``)."""

    opening: str
    tags: str


@dataclass(frozen=True)
class SiteRule:
    container: str | Element = "(?s)<article[^>]*>(.*)</article>"   # group 1: the review list; a list element's direct items are its reviews
    block_split: str = "<p[^>]*>"                          # one review per piece after the first
    title: str = "(?s)<h1[^>]*>(.*?)</h1>"
    context: str | Element | None = None        # group 1: the review text; the whole block when None
    fields: tuple = ()                # (column, pattern with group 1 or Element) read inside each block
    tag_area: str | None = None       # group 1: the part of a block holding the tags
    tag: str = "(?s)<em[^>]*>(.*?)</em>"   # group 1: one tag inside the tag area


DEFAULT_RULE = SiteRule()
TAG = "<[^>]*>"
# Ends of blocks and line breaks: the text before and after them is not one word.
BREAK = "(?i)<(?:br|/p|/div|/li|/tr|/h[1-6])(?:\\s[^>]*|/)?>"
# The named character references that review pages use (HTML).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"), ("&middot;", "\u00b7"),
            ("&copy;", "\u00a9"), ("&hellip;", "\u2026"), ("&ndash;", "\u2013"), ("&mdash;", "\u2014")]


def domain_of(url) -> F.Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)


def decode_entities(c) -> F.Column:
    """Numeric and the common named character references as characters; ``&amp;`` last, so that nothing decodes twice.

    Numeric ones are found per text and replaced piece by piece: the text between references is split off,
    each reference becomes its character, and the two lists are joined in turn.
    """
    for name, char in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(char))
    pattern = "&#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"
    code = lambda r: F.when(F.lower(F.substring(r, 3, 1)) == "x", F.conv(F.regexp_extract(r, "([0-9a-fA-F]+);", 1), 16, 10)).otherwise(
        F.regexp_extract(r, "([0-9]+);", 1)).cast("int")
    # one UTF-8 character from its code point, byte by byte
    def char_of(n):
        def byte(x):
            return F.lpad(F.hex(x.cast("bigint")), 2, "0")

        tail = lambda shift: byte(F.lit(0x80) + F.shiftright(n, shift).bitwiseAND(0x3F))
        spelled = (F.when(n < 0x80, byte(n)).when(n < 0x800, F.concat(byte(F.lit(0xC0) + F.shiftright(n, 6)), tail(0)))
                   .when(n < 0x10000, F.concat(byte(F.lit(0xE0) + F.shiftright(n, 12)), tail(6), tail(0)))
                   .otherwise(F.concat(byte(F.lit(0xF0) + F.shiftright(n, 18)), tail(12), tail(6), tail(0))))
        valid = (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(spelled), "UTF-8")).otherwise(F.lit("\ufffd"))

    found = F.regexp_extract_all(c, F.lit(pattern), 0)
    chars = F.concat(F.transform(found, lambda r: char_of(code(r))), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(F.split(c, pattern, -1), chars, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.replace(F.when(c.contains("&#"), joined).otherwise(c), F.lit("&amp;"), F.lit("&"))


def strip_tags(c) -> F.Column:
    """Markup to text: breaks and block ends become line feeds, other tags go, character references are decoded."""
    plain = F.regexp_replace(F.regexp_replace(c, BREAK, "\n"), TAG, "")
    return strip_ws(F.when(plain.contains("&"), decode_entities(plain)).otherwise(plain))


COMMENT = "(?s)<!--.*?-->"
#: Stands for the start of a direct item while a list is cut; no landed text holds it (it is taken out first).
_MARK = "\u0001"


def _is_closing(token) -> F.Column:
    return F.substring(token, 1, 2) == "</"


def element(html, spec: Element) -> F.Column:
    """Inner HTML of the first element that ``spec`` opens, up to its own end tag; without one to the end of the text, "" where there is none.

    The depth runs over the tags of the element's kind only; it starts at 1 behind the opening tag and the element ends
    where it reaches 0.
    """
    at = F.regexp_instr(html, F.lit(f"(?s){spec.opening}"))
    rest = F.substring(html, at + F.length(F.regexp_extract(html, f"(?s){spec.opening}", 0)), F.length(html))
    pattern = f"(?i)</?(?:{spec.tags})(?:\\s[^>]*|/)?>"

    def cut(r):
        tokens, pieces = F.regexp_extract_all(r, F.lit(pattern), 0), F.split(r, pattern, -1)
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("read"))
        step = lambda acc, t: F.when(acc["depth"] == 0, acc).otherwise(F.struct(
            (acc["depth"] + F.when(_is_closing(t), -1).when(t.endswith("/>"), 0).otherwise(1)).alias("depth"), (acc["read"] + 1).alias("read")))
        # pieces in front of the token that ends the element, with the tokens between them; all of them if nothing ends it
        whole = F.aggregate(tokens, start, step, lambda acc: F.when(acc["depth"] == 0, acc["read"]).otherwise(acc["read"] + 1))
        return F.transform(F.array(whole), lambda n: F.array_join(F.zip_with(
            F.slice(pieces, 1, n), F.slice(tokens, 1, n - 1), lambda p, t: F.concat(p, F.coalesce(t, F.lit("")))), ""))[0]

    return F.when(at > 0, F.transform(F.array(rest), cut)[0]).otherwise(F.lit(""))


def list_items(inner, item: str, tags: str) -> F.Column:
    """The direct items of a list's inner HTML as an array; what stands before the first is its element 0.

    ``item`` is the pattern of an item's opening tag, ``tags`` the kinds of lists. An item begins where such a tag stands at depth 0.
    """
    pattern = f"(?s){item}|(?i:</?(?:{tags})(?:\\s[^>]*|/)?>)"
    list_tag = f"(?i)^</?(?:{tags})(?:\\s[^>]*|/)?>$"

    def cut(html):
        tokens, pieces = F.regexp_extract_all(html, F.lit(pattern), 0), F.split(html, pattern, -1)
        start = F.struct(F.lit(0).alias("depth"), F.expr("cast(array() as array<boolean>)").alias("begins"))

        def step(acc, t):
            change = F.when(~t.rlike(list_tag), 0).when(_is_closing(t), -1).when(t.endswith("/>"), 0).otherwise(1)
            begins = (acc["depth"] == 0) & ~t.rlike(list_tag)
            return F.struct(F.greatest(acc["depth"] + change, F.lit(0)).alias("depth"), F.concat(acc["begins"], F.array(begins)).alias("begins"))

        marked = lambda begins: F.zip_with(tokens, begins, lambda t, b: F.when(b, F.lit(_MARK)).otherwise(t))
        joined = F.aggregate(tokens, start, step, lambda acc: F.array_join(F.zip_with(
            pieces, marked(acc["begins"]), lambda p, t: F.concat(p, F.coalesce(t, F.lit("")))), ""))
        return F.split(joined, _MARK, -1)

    return F.transform(F.array(F.translate(inner, _MARK, "")), cut)[0]


def _part(html, spec: str | Element) -> F.Column:
    return element(html, spec) if isinstance(spec, Element) else F.regexp_extract(html, spec, 1)


def _field(block, spec: str | Element):
    v = strip_tags(_part(block, spec))
    return F.when(F.length(v) > 0, v)


def extract_reviews(pages: DataFrame, rule: SiteRule = DEFAULT_RULE) -> DataFrame:
    """One row per non-blank review block: page_id, domain, title, pos, context,
    n_chars, then the rule's fields and, with a tag area, ``tags`` (array)."""
    if isinstance(rule.container, Element):
        body = list_items(element(F.regexp_replace("html", COMMENT, ""), rule.container), rule.block_split, rule.container.tags)
    else:
        body = F.split(F.regexp_extract("html", rule.container, 1), rule.block_split)
    blocks = pages.select(
        "page_id",
        domain_of(F.col("url")).alias("domain"),
        strip_tags(F.regexp_extract("html", rule.title, 1)).alias("title"),
        F.posexplode(body).alias("pos", "block"),
    )
    block = F.col("block")
    text = strip_tags(_part(block, rule.context)) if rule.context else strip_tags(block)
    extra = [_field(block, rx).alias(name) for name, rx in rule.fields]
    if rule.tag_area:
        area = F.regexp_extract(block, rule.tag_area, 1)
        extra.append(F.transform(F.regexp_extract_all(area, F.lit(rule.tag), 1), strip_tags).alias("tags"))
    return (
        blocks.where(F.col("pos") > 0)
        # exploded as a list of one, so that the text is made once for the test, the column and its length
        .select("page_id", "domain", "title", F.col("pos").cast("int").alias("pos"), F.explode(F.array(text)).alias("context"),
                *extra)
        .where(F.length("context") > 0)
        .withColumn("n_chars", F.length("context"))
    )


# The markup of one site's review list, named as in the
# crawler's selectors (list item "type01 oneContentTag"; classes user-id,
# story-txt, story-point, story-date, story-recommend with <em> tags).
MEGABOX_RULE = SiteRule(
    container='(?s)<div class="movie-idv-story">(.*)</div>',
    block_split='<li class="type01 oneContentTag"[^>]*>',
    context='(?s)<div class="story-txt"[^>]*>(.*?)</div>',
    fields=(
        ("id", '(?s)<div class="user-id"[^>]*>(.*?)</div>'),
        ("rating", '(?s)<div class="story-point"[^>]*>\\s*<span[^>]*>(.*?)</span>'),
        ("date_text", '(?s)<div class="story-date"[^>]*>\\s*<div[^>]*>\\s*<span[^>]*>(.*?)</span>'),
    ),
    tag_area='(?s)<div class="story-recommend"[^>]*>(.*?)</div>',
)


def megabox_review_rows(pages: DataFrame, as_of) -> DataFrame:
    """S16 for one site: landed review pages to rows in its landed CSV
    layout (id, context, star, review_date, recommend_tags).

    Ten-point ratings are halved (C21), relative days are resolved at the
    crawl time ``as_of`` (C19), collapsed tags are dropped (F13) and blocks
    without a reviewer id are skipped (F14).
    """
    rows = extract_reviews(pages, MEGABOX_RULE).where(has_reviewer("id"))
    return rows.select(
        "page_id", "id", "context",
        ten_point_to_five("rating").cast("string").alias("star"),
        relative_to_date_text("date_text", as_of).alias("review_date"),
        tags_literal(clean_tags("tags")).alias("recommend_tags"),
    )


# The markup of the other sites' review lists, named as in the
# crawlers' selectors. Lists and texts are read to their own closing tag.
CINE_EXPERT_RULE = SiteRule(
    container=Element('<ul class="expert_rating"[^>]*>', "ul|ol"),
    block_split="<li[^>]*>",
    context='(?s)<div class="comment_area"[^>]*>.*?</a>\\s*<span[^>]*>(.*?)</span>',
    fields=(
        ("name", '(?s)<div class="comment_area"[^>]*>\\s*<a[^>]*>\\s*<span[^>]*>(.*?)</span>'),
        ("star", '(?s)<div class="star_area"[^>]*>\\s*<span[^>]*>(.*?)</span>'),
    ),
)
CINE_NETIZEN_RULE = SiteRule(
    container=Element('<ul class="reply_box"[^>]*>', "ul|ol"),
    block_split="<li[^>]*>",
    context=Element('<div class="comment(?: ellipsis_3)?"[^>]*>', "div"),
    fields=(
        ("name", '(?s)class="id"[^>]*>(.*?)</'),
        ("date", '(?s)class="date"[^>]*>(.*?)</'),
        ("star", '(?s)^\\s*(?:<div[^>]*>.*?</div>\\s*){2}<div[^>]*>\\s*<span[^>]*>(.*?)</span>'),
    ),
)
# A review is a list item that begins with a box; the writer's list inside it does not.
CGV_RULE = SiteRule(
    container='(?s)id="movie_point_list_container"[^>]*>(.*)</ul>',
    block_split="<li[^>]*>\\s*<div[^>]*>",
    context="(?s)<p[^>]*>(.*?)</p>",
    fields=(
        ("id", "(?s)<ul[^>]*>\\s*<li[^>]*>(.*?)</li>"),
        ("date", "(?s)<ul[^>]*>\\s*<li[^>]*>.*?</li>\\s*<li[^>]*>\\s*<span[^>]*>(.*?)</span>"),
    ),
)
WATCHA_RULE = SiteRule(
    container="(?s)<body[^>]*>(.*)</body>",
    block_split='<div class="GvYMMD2G sCUeLl5F"[^>]*>',
    context='(?s)<div class="tCqzOhhS Jgl_VtOt _4_jash0F"[^>]*>\\s*<a[^>]*>\\s*<div[^>]*>\\s*<div[^>]*>(.*?)</div>',
    fields=(
        ("id", '(?s)<div class="TfbnQJp1 qfFKTvc9"[^>]*>(.*?)</div>'),
        ("star", '(?s)<div class="H7gLZE2m KYbG4TeN"[^>]*>\\s*<span[^>]*>(.*?)</span>'),
    ),
)


def cine_review_rows(pages: DataFrame) -> DataFrame:
    """One site's page to rows of both its lists in its landed layout (who, name, context, star, date).

    Experts have no date and their star as shown; netizens' ten-point stars
    are halved (D25) and their date is its first word (C23). Rows without a
    name are skipped (F14).
    """
    expert = extract_reviews(pages, CINE_EXPERT_RULE).select(
        "page_id", F.lit("expert").alias("who"), "name", "context", "star", F.lit(None).cast("string").alias("date"))
    netizen = extract_reviews(pages, CINE_NETIZEN_RULE).select(
        "page_id", F.lit("netizen").alias("who"), "name", "context", ten_point_to_five("star").cast("string").alias("star"),
        first_token("date").alias("date"))
    return expert.unionByName(netizen).where(has_reviewer("name"))


def cgv_review_rows(pages: DataFrame) -> DataFrame:
    """Rows in the landed layout (id, context, date)."""
    return extract_reviews(pages, CGV_RULE).where(has_reviewer("id")).select("page_id", "id", "context", "date")


def watcha_review_rows(pages: DataFrame) -> DataFrame:
    """Rows in the landed layout (id, star, context); an unrated review has the star text ``None``."""
    rows = extract_reviews(pages, WATCHA_RULE).where(has_reviewer("id"))
    return rows.select("page_id", "id", F.coalesce("star", F.lit("None")).alias("star"), "context")


@dataclass(frozen=True)
class SearchRule:
    block_split: str                  # one search hit per piece after the first
    title: str                        # group 1: the hit's title
    year: str                         # group 1: the hit's opening year
    image: str = "<img"               # present when the hit shows an image
    query_param: str = "query"        # the search term in the page URL


# The markup of one site's search results, named as in the
# crawler's selectors (hit "li.zK9dEEA5", title attribute of its link,
# year before "・" in "div.qz_zPMlN.RiDHrQhO").
WATCHA_SEARCH_RULE = SearchRule(
    block_split='<li class="zK9dEEA5"[^>]*>',
    title='<a[^>]*title="([^"]*)"',
    year='(?s)<div class="qz_zPMlN RiDHrQhO"[^>]*>\\s*(\\d{4})\\s*・',
)


def search_hits(pages: DataFrame, rule: SearchRule = WATCHA_SEARCH_RULE) -> DataFrame:
    """J5 input: landed search-result pages to one row per hit (movieNm =
    the search term, hit_id, title, open_year, position, has_image), the
    shape ``operators.matching.candidate_match`` reads."""
    term = decode_name(F.regexp_extract("url", f"[?&]{rule.query_param}=([^&#]*)", 1))
    hits = pages.select("page_id", term.alias("movieNm"),
                        F.posexplode(F.split("html", rule.block_split)).alias("pos", "block"))
    block = F.col("block")
    return hits.where(F.col("pos") > 0).select(
        "movieNm",
        F.concat_ws("-", "page_id", "pos").alias("hit_id"),
        F.regexp_extract(block, rule.title, 1).alias("title"),
        F.regexp_extract(block, rule.year, 1).alias("open_year"),
        F.col("pos").cast("int").alias("position"),
        block.contains(rule.image).alias("has_image"),
    )
