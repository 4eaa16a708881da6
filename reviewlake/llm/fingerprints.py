"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests. Spark functions only.

A sketch has three rows of cells; a digest falls into one cell of each row, and a cell keeps the count, the
xor of its digests and the xor of their check sums. Sketches of two versions subtract cell by cell: what
both have cancels, and cells left with one digest ("pure") give it up, which empties its other cells and
makes further cells pure. The digests peeled this way are the paragraphs that differ. A difference too
large for the sketch leaves cells behind; the size of what is left in the cells tells how many sketches of the same
form, each for its share of the digests, the next attempt needs. Shares that fail again are cut further until all peel.

A pair of versions is one row: sketches are small arrays, subtracted and peeled by higher-order functions, so the
attempts move nothing between tasks; only the few shares that fail twice are written out and tried again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.batches import column, cut

#: Cells of a row of a sketch, which has three (a power of two).
BASE_ROW = 8
#: A paragraph is a line's stretch up to a sentence end (of any script), or up to a place that its own characters
#: define, so that places behind an edit are found again; without either it ends after so many characters.
LONGEST = 128
_SENTENCE = r"""[.!?\u2026]["'\u201d\u2019)\]]*(?:[ \t\r]+|(?![^\n]))|[\u3002\uff01\uff1f\uff0e\uff61\u0964\u0965\u061f\u06d4\u1362\u0589\u104b\u17d4\u0f0d][\u201d\u2019\u300d\u300f\uff09 \t]*"""
#: Spaces and signs before some letters, some common characters of scripts without spaces, and rare ones inside long codes.
_PLACE = (r"[ \t,:=&/|](?=[bmpwBMPW07\u03ba\u03c4\u0432\u043f\u0441\u05d4\u0627\u0915\u0938\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\uadf8\uc774])"
          r"|[;{}\u3001\uff0c\uff1b\u7684\u662f\u3092\u304c]|[7Q](?=[0-9A-Za-z+/_-]{12})")
#: Most characters begin none of these ends; one look at them spares a try of every alternative.
_NO_END = r"(?![a-zA-PR-Z0-689\u00c0-\u024f\u0370-\u0588\uac00-\ud7a3])"
PARAGRAPH = rf"[^\n]{{0,{LONGEST - 1}}}?{_NO_END}(?:{_SENTENCE}|{_PLACE})|[^\n]{{1,{LONGEST}}}"
#: Passes over the cells in one attempt; what is not peeled by then is tried again with more cells.
PASSES = 5
#: Differing digests that one sketch is meant for in a further attempt, and digests of a pair that are cut into shares at once:
#: a pair is cut into blocks, a block into chunks and a chunk into shares, so that a digest is looked at a bounded number of times.
SHARE, CHUNK, BLOCK = 5, 64, 4096
#: Rows that are sorted together to find their successors, and the most such groups there are (their first rows are broadcast by digest).
GROUP_ROWS, MOST_GROUPS = 512, 200_000


def paragraph_digests(text: Column) -> Column:
    """Sorted distinct 64-bit digests of the paragraphs; an empty text has none, a blank line is none."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), 0), lambda p: F.xxhash64(p))))


def _check(key: Column, seed: int) -> Column:
    """The check sum of a digest in the stored sketch (``seed`` 0) or in the attempt ``seed``."""
    return F.xxhash64(key, F.lit(seed)) if seed else F.xxhash64(key, F.lit("check"))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _place(key: Column, check: Column, seed: int, r: int) -> Column:
    """The cell of a digest in row ``r`` of a sketch. Further attempts differ in ``seed`` and take it from bits of the check sum, so that they hash once."""
    own = F.shiftrightunsigned(check, 8 * r) if seed else F.xxhash64(key, F.lit(0), F.lit(r))
    return (F.pmod(own, F.lit(BASE_ROW)) + r * BASE_ROW).cast("int")


def _add(cell: Column, hit: Column, sign: int = 1) -> Column:
    n = cell["n"] + hit["n"] if sign > 0 else cell["n"] - hit["n"]
    return F.struct(n.alias("n"), cell["k"].bitwiseXOR(hit["k"]).alias("k"), cell["c"].bitwiseXOR(hit["c"]).alias("c"))


def _cells(hits: Column) -> Column:
    """The sketch of ``hits`` (see ``_hits``): what falls into a cell is summed there, with its sign."""
    slots = lambda r: F.array(*[F.lit(r * BASE_ROW + i) for i in range(BASE_ROW)])
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))
    row = lambda all_hits, r: F.transform(slots(r), lambda i: F.aggregate(
        F.filter(all_hits, lambda h: h[f"at{r}"] == i), zero, lambda a, h: _add(a, h)))
    return _let(hits, lambda all_hits: F.concat(*[row(all_hits, r) for r in range(3)]))


def _hits(digests: Column, seed: int, sign: int = 1) -> Column:
    checked = F.transform(digests, lambda k: F.struct(k.alias("k"), _check(k, seed).alias("c")))
    return F.transform(checked, lambda h: F.struct(F.lit(sign).alias("n"), h["k"].alias("k"), h["c"].alias("c"),
                                                   *[_place(h["k"], h["c"], seed, r).alias(f"at{r}") for r in range(3)]))


def sketch(digests: Column, seed: int) -> Column:
    """Array of (n, k, c) with 3 x ``BASE_ROW`` cells."""
    return _cells(_hits(digests, seed))


def difference_sketch(first: Column, second: Column, seed: int) -> Column:
    """``subtract`` of the sketches of two digest arrays, made at once."""
    return _cells(F.concat(_hits(first, seed), _hits(second, seed, -1)))


def base_sketch(digests: Column) -> Column:
    """The stored sketch."""
    return sketch(digests, 0)


def sketch_text(cells: Column) -> Column:
    """A sketch as text: count, key and check of each cell in hex."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(".", F.hex(c["n"].cast("long")), F.hex(c["k"]), F.hex(c["c"]))), "-")


def subtract(first: Column, second: Column) -> Column:
    """Cell by cell difference of two sketches."""
    return F.zip_with(first, second, lambda a, b: _add(a, b, -1))


def _full(cell: Column) -> Column:
    return (cell["n"] != 0) | (cell["k"] != 0) | (cell["c"] != 0)


_GOT = "struct(cast(array() as array<bigint>) as lost, cast(array() as array<bigint>) as gained)"


def _joined(all_got: Column) -> Column:
    """A list of ``got`` as one."""
    return F.struct(*[F.flatten(all_got[c]).alias(c) for c in ("lost", "gained")])


def peel(cells: Column, seed: int) -> Column:
    """(left, got) of a difference of sketches: whether cells remain, and the digests of the first version only (lost) and the second only (gained).

    In each pass all pure cells hand their digests, each once, to their three cells with the opposite sign; passes end when no cell is left or none
    is pure. A row of cells holds the check sums of all digests that differ: where those just found make up its sum, nothing is left and nothing is handed on.
    """

    def one_pass(state: Column, _: Column) -> Column:
        pure = lambda sign: F.array_distinct(F.transform(
            F.filter(state["cells"], lambda c: (c["n"] == sign) & (c["c"] == _check(c["k"], seed))), lambda c: c["k"]))
        after = lambda cells, got, left, more: F.struct(cells.alias("cells"), got.alias("got"), left.alias("left"), more.alias("more"))
        yes, no = F.lit(True), F.lit(False)

        def handed(found: Column, got: Column) -> Column:
            row = lambda hits, r: F.transform(F.slice(state["cells"], r * BASE_ROW + 1, BASE_ROW), lambda c, i: F.aggregate(
                F.filter(hits, lambda p: p[f"at{r}"] == i + r * BASE_ROW), c, lambda a, p: _add(a, p, -1)))
            cells = _let(F.concat(_hits(found["lost"], seed), _hits(found["gained"], seed, -1)), lambda hits: F.concat(*[row(hits, r) for r in range(3)]))
            return after(cells, got, yes, yes)

        def taken(found: Column) -> Column:
            zero = F.lit(0).cast("long")
            sums = [F.aggregate(found[c], zero, lambda a, k: a.bitwiseXOR(_check(k, seed))) for c in ("lost", "gained")]
            total = F.aggregate(F.slice(state["cells"], 1, BASE_ROW), zero, lambda a, c: a.bitwiseXOR(c["c"]))
            got = F.struct(*[F.concat(state["got"][c], found[c]).alias(c) for c in ("lost", "gained")])
            return (F.when(F.size(found["lost"]) + F.size(found["gained"]) == 0, after(state["cells"], state["got"], F.exists(state["cells"], _full), no))
                    .when(sums[0].bitwiseXOR(sums[1]) == total, after(state["cells"], got, no, no))
                    .otherwise(handed(found, got)))

        return F.when(state["left"] & state["more"], _let(F.struct(pure(1).alias("lost"), pure(-1).alias("gained")), taken)).otherwise(state)

    # ``cells`` is named once, as it is made anew wherever it is named; whether any is full is asked where no digest is found
    start = F.struct(cells.alias("cells"), F.expr(_GOT).alias("got"), F.lit(True).alias("left"), F.lit(True).alias("more"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(PASSES)), start, one_pass, lambda s: F.struct(s["left"].alias("left"), s["got"].alias("got")))


def _parts(n: Column) -> Column:
    """``n`` as a number of parts: a whole number, at least 1."""
    return F.greatest(F.ceil(n).cast("long"), F.lit(1).cast("long"))


def _among(digests: Column, shift: int, parts: Column, part: Column) -> Column:
    """The digests of one of ``parts`` parts, told apart by the digests' own bits from ``shift`` on."""
    return F.filter(digests, lambda k: F.pmod(F.shiftrightunsigned(k, shift), parts) == part)


def difference(first: Column, second: Column, base: Column, attempt: int = 1) -> Column:
    """(got, failed) of two digest arrays whose subtracted sketch ``base`` did not peel.

    The squares of the counts in ``base`` sum up to about the number of differing digests per row; there is one
    sketch for every ``SHARE`` of them (as many as both arrays hold at most). ``failed`` has the (first, second) of the shares that did
    not peel. Each attempt takes its shares by other bits and its cells by another seed.
    """
    squares = F.aggregate(base, F.lit(0), lambda a, c: a + F.least(c["n"] * c["n"], F.lit(1 << 20))) / 3
    all_digests = F.size(first) + F.size(second)

    def parts(a: Column, b: Column, shift: int, n: Column, body) -> Column:
        """``body`` of each of ``n`` parts of (a, b), told apart by the digests' bits from ``shift`` on, put together.

        Each part gives lists of its own, joined once a level: a value that grows from part to part would be copied for each.
        """
        each = _let(n, lambda m: F.transform(F.sequence(F.lit(0).cast("long"), m - 1), lambda i: _let(
            F.struct(_among(a, shift, m, i).alias("a"), _among(b, shift, m, i).alias("b")), lambda part: body(part["a"], part["b"]))))
        return _let(each, lambda rs: F.struct(_joined(F.transform(rs, lambda r: r["got"])).alias("got"),
                                              F.flatten(F.transform(rs, lambda r: r["failed"])).alias("failed")))

    def share(a: Column, b: Column) -> Column:
        none = F.expr("cast(array() as array<struct<first: array<bigint>, second: array<bigint>>>)")
        return _let(peel(difference_sketch(a, b, attempt), attempt), lambda r: F.when(
            r["left"], F.struct(F.expr(_GOT).alias("got"), F.array(F.struct(a.alias("first"), b.alias("second"))).alias("failed")))
            .otherwise(F.struct(r["got"].alias("got"), none.alias("failed"))))

    def chunk(a: Column, b: Column, rate: Column) -> Column:
        size = (F.size(a) + F.size(b)).cast("double")
        shares = F.greatest(_parts(F.least(rate * size, size) / SHARE), F.lit(2).cast("long"))
        return parts(a, b, 8 * attempt % 40, shares, share)

    def block(a: Column, b: Column, rate: Column) -> Column:
        return parts(a, b, 43, _parts((F.size(a) + F.size(b)) / CHUNK), lambda a, b: chunk(a, b, rate))

    return _let(squares / all_digests, lambda rate: parts(first, second, 50, _parts(all_digests / BLOCK), lambda a, b: block(a, b, rate)))


def compare(first: Column, second: Column, first_sketch: Column, second_sketch: Column) -> Column:
    """(got, failed) of two versions: their sketches subtracted and peeled, then with more cells where that fails."""
    none = F.expr("cast(array() as array<struct<first: array<bigint>, second: array<bigint>>>)")
    return _let(subtract(first_sketch, second_sketch), lambda base: _let(peel(base, 0), lambda r: F.when(
        r["left"], difference(first, second, base)).otherwise(F.struct(r["got"].alias("got"), none.alias("failed")))))


def _counted(got: Column, digests: bool) -> list[Column]:
    sides = ("gained", "lost")
    return [F.size(got[c]).alias(f"n_{c}") for c in sides] + [got[c].alias(c) for c in sides if digests]


def retry(failed: DataFrame, keys: list[str], digests: bool) -> DataFrame:
    """(keys, n_gained, n_lost[, gained, lost]) over the shares of ``failed`` (keys, first, second), attempt after attempt until all peel.

    ``keys`` name the pair a share belongs to; a pair's shares are summed. The loop sees only whether shares remain.
    """
    done, attempt = None, 2
    rest = failed
    while True:
        base = difference_sketch(F.col("first"), F.col("second"), attempt)
        tried = cut(rest.repartition(*keys).select(*keys, F.size("first").alias("_n"), _let(base, lambda c: difference(F.col("first"), F.col("second"), c, attempt)).alias("r")))
        part = tried.select(*keys, *_counted(F.col("r.got"), digests))
        done = part if done is None else done.unionByName(part)
        rest = tried.select(*keys, F.explode("r.failed").alias("f")).select(*keys, "f.first", "f.second")
        if rest.isEmpty():
            break
        attempt += 1
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("gained", "lost")] if digests else []  # as long as the text's own digests
    return done.groupBy(*keys).agg(F.sum("n_gained").alias("n_gained"), F.sum("n_lost").alias("n_lost"), *lists)


def likeness(size_a: Column, size_b: Column, differing: Column) -> Column:
    """Jaccard likeness of two digest sets from their sizes and the number of differing digests; 1 if both are empty."""
    union = (size_a + size_b + differing) / 2
    return F.when(union > 0, (union - differing) / union).otherwise(F.lit(1.0))


def _scale(rows: DataFrame, order: str) -> tuple[Column, float, float, int]:
    """(the order's values on a line, its least and largest, the number of rows). Values that the line cannot tell apart stay together.

    Numbers, dates and times lie by their size; text and bytes by the six bytes behind what the least and the largest have in
    common, so ids with a common beginning spread as well.
    """
    kind = rows.schema[order].dataType.simpleString()
    value = column(order)
    if kind in ("string", "binary") or kind.startswith(("char", "varchar")):
        raw = value.cast("binary")
        least, largest, n = rows.agg(F.hex(F.min(raw)), F.hex(F.max(raw)), F.count(F.lit(1))).first()
        same = 0
        while least and largest and same < min(len(least), len(largest)) and least[same:same + 2] == largest[same:same + 2]:
            same += 2
        digits = F.rpad(F.substring(F.hex(raw), same + 1, 12), 12, "0")
        return F.conv(digits, 16, 10).cast("double"), 0.0, float(1 << 48), n
    line = F.unix_micros(value).cast("double") if kind == "timestamp" else F.unix_date(value).cast("double") if kind == "date" else value.cast("double")
    least, largest, n = rows.agg(F.min(line), F.max(line), F.count(F.lit(1))).first()
    return line, least or 0.0, largest or 0.0, n


def _chain(groups: DataFrame) -> DataFrame:
    """(bucket, after): for each row of ``groups`` (bucket, first, second) the hashes of the first row of the next lower bucket; the lowest is followed by the highest.

    At most ``MOST_GROUPS`` narrow rows; they are sorted in ranges, and one row a range names the next range's first.
    """
    rows = cut(groups.repartitionByRange(F.col("bucket").desc()).sortWithinPartitions(F.col("bucket").desc()).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(F.col("bucket").desc())
    whole = Window.orderBy("part")
    heads = rows.withColumn("at", F.row_number().over(inside)).where("at = 1").select("part", F.struct("first", "second").alias("head"))
    heads = heads.select("part", F.coalesce(F.lead("head").over(whole), F.first("head").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("turn"))
    return rows.withColumn("after", F.lead(F.struct("first", "second")).over(inside)).join(heads, "part").select(
        "bucket", F.coalesce("after", "turn").alias("after"))


def with_next(rows: DataFrame, order: str, tie: str, carry: list[str], derive=None) -> DataFrame:
    """Adds ``next_<c>`` for each column of ``carry``: its value in the row of the next lower ``order`` (of any type that sorts).

    The last row's next is the first; nulls come last; rows of equal order follow ``tie`` (a long). Rows are
    sorted in groups of neighbours, so no task sees the whole table and ids may be dense, sparse or hashed; rows of
    equal order (but null) share a group. ``derive`` adds columns to rows; it runs once a row. Also adds ``bucket`` and ``place``, which
    together identify a row.
    """
    derive = derive or (lambda df: df)
    line, least, largest, n = _scale(rows, order)
    groups = min(max(n // GROUP_ROWS, 1), MOST_GROUPS)
    width = (largest - least) / groups or 1.0
    # nulls lie below all values, in groups by their tie
    nulls = F.lit(-1) - F.floor((F.lit(float(1 << 63)) - column(tie).cast("double")) / (float(1 << 64) / groups)).cast("long")
    number = F.when(column(order).isNull(), nulls).otherwise(F.floor((line - least) / width).cast("long"))
    hashes = [F.xxhash64(F.lit(i), column(order), column(tie)).alias(name) for i, name in enumerate(("first", "second"))]
    placed = rows.withColumn("bucket", number)
    rank = F.struct(column(order).isNotNull().alias("some"), column(order).alias("value"), column(tie).alias("tie"))
    tops = placed.select("bucket", rank.alias("rank"), *hashes).groupBy("bucket").agg(F.max_by(F.struct("first", "second"), "rank").alias("h")).select("bucket", "h.*")
    chain = cut(_chain(tops))
    packed = F.struct(*[column(c).alias(c) for c in carry])
    # the first rows of the groups, found again by their hashes: sixteen bytes a group to every task
    wanted = F.broadcast(chain.select("after.*").distinct())
    firsts = derive(placed.select("*", *hashes).join(wanted, ["first", "second"], "left_semi"))
    edges = chain.select("bucket", "after.first", "after.second").join(
        firsts.groupBy("first", "second").agg(F.any_value(packed).alias("edge")), ["first", "second"]).select("bucket", "edge")
    w = Window.partitionBy("bucket").orderBy(column(order).desc_nulls_last(), column(tie).desc())
    # derived behind the shuffle, which carries the rows as they are
    df = derive(placed.withColumn("place", F.row_number().over(w))).withColumn("following", F.lead(packed).over(w))
    df = df.join(edges, "bucket", "left")
    kept = [c for c in df.columns if c not in ("following", "edge", "bucket", "place")]
    return df.select(*[column(c) for c in kept], "bucket", "place", *[F.coalesce(F.col("following"), F.col("edge"))[c].alias(f"next_{c}") for c in carry])


def fingerprint_versions(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", digests: bool = True) -> DataFrame:
    """Fingerprints of every text and of an edited version, and their likeness.

    Edited: the last floor(n/2) code points give way to the first as many (or all) of the next text by
    descending id (see ``with_next``; a table of one row follows itself). Returns the id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and, with ``digests``, the peeled
    ``edited_gained`` / ``edited_lost``. Null texts count as empty; the likeness of two empty texts is 1, of
    an empty and another 0. Equal texts have equal fingerprints. Ids may be of any type that sorts; rows of equal id stay
    separate rows. Other columns are ignored. The text is shuffled once; what is kept is narrow.
    """
    rows = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = with_next(rows, "id", "tie", ["text", "digests", "own"],
                     lambda df: df.withColumn("digests", paragraph_digests(F.col("text"))).withColumn("own", base_sketch(F.col("digests"))))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    one = F.explode(F.array(F.struct(F.unhex(F.sha2("edited", 256)).alias("edited_sha"), paragraph_digests(F.col("edited")).alias("edited_digests"))))
    both = ("digests", "next_digests", "own", "next_own")
    rows = rows.select("bucket", "place", "id", F.length("text").cast("long").alias("n_chars"), *both, edited.alias("edited"))
    rows = rows.select("bucket", "place", "id", "n_chars", *both, one.alias("e"))  # exploded as a list of one: made once
    rows = rows.select("*", F.explode(F.array(base_sketch(F.col("e.edited_digests")))).alias("edited"))
    found = F.explode(F.array(F.struct(compare(F.col("digests"), F.col("e.edited_digests"), F.col("own"), F.col("edited")).alias("edited"),
                                       compare(F.col("digests"), F.col("next_digests"), F.col("own"), F.col("next_own")).alias("next"))))
    sizes = [F.size(c).alias(n) for c, n in (("digests", "n_own"), ("e.edited_digests", "n_edited"), ("next_digests", "n_next"))]
    rows = rows.select("bucket", "place", "id", "n_chars", "e.edited_sha", "own", "edited", *sizes, found.alias("f"))
    versions = ("edited", "next")
    counts = [c.alias(f"{v}_{name}") for v in versions for c, name in zip(_counted(F.col(f"f.{v}.got"), digests and v == "edited"), ("n_gained", "n_lost", "gained", "lost"), strict=False)]
    rows = cut(rows.select("bucket", "place", "id", "n_chars", "edited_sha", "own", "edited", "n_own", "n_edited", "n_next", *counts,
                           *[F.col(f"f.{v}.failed").alias(f"{v}_failed") for v in versions]))
    sides = F.array(*[F.struct(F.lit(v).alias("version"), F.col(f"{v}_failed").alias("failed")) for v in versions])
    failed = rows.where("size(edited_failed) + size(next_failed) > 0").select("bucket", "place", F.explode(sides).alias("s")).select(
        "bucket", "place", "s.version", F.explode("s.failed").alias("f")).select("bucket", "place", "version", "f.first", "f.second")
    more = retry(failed, ["bucket", "place", "version"], digests)
    of = lambda v, c: F.max(F.when(F.col("version") == v, F.col(c)))
    extra = [c for c in more.columns if c not in ("bucket", "place", "version")]
    more = more.groupBy("bucket", "place").agg(*[of(v, c).alias(f"{v}_{c}_more") for v in versions for c in extra])
    done = rows.join(more, ["bucket", "place"], "left")
    count = lambda v: sum((F.col(f"{v}_{c}") + F.coalesce(F.col(f"{v}_{c}_more"), F.lit(0)) for c in ("n_gained", "n_lost")), F.lit(0))
    near = lambda v: likeness(F.col("n_own"), F.col(f"n_{v}"), count(v)).alias(f"near_{v}")
    none = F.expr("cast(array() as array<bigint>)")
    lists = [F.array_sort(F.concat(f"edited_{c}", F.coalesce(F.col(f"edited_{c}_more"), none))).alias(f"edited_{c}") for c in ("gained", "lost")] if digests else []
    return done.select("id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), sketch_text(F.col("own")).alias("fingerprint"),
                       sketch_text(F.col("edited")).alias("edited_fingerprint"), near("edited"), near("next"), *lists)
