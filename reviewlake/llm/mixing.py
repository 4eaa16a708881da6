"""Mixing sources to target weights by entropy balancing.

Every source gets a target of words. Among all document rates between 0 and ``most`` that meet the targets, those
nearest to one copy each (in relative entropy) are exponentially tilted: rate = min(most, exp(lambda * size)), one
lambda a source. The lambdas solve a convex dual, here by Newton steps on the logarithm of the words taken, kept inside a
bracket. A rate depends on source and size only, so the steps run on the table of (source, size, documents), not
on the documents, and sums are taken in decimals: reruns agree to the last bit. Rates become whole copies per
(source, size) by hashed rounding, the difference to the target is paid back from large sizes to small ones, and
the documents of a size that get one copy more are the first ones in the order of their ids' hashes.

Everything is DataFrame expressions; per step only whether a source is still open reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.batches import column, cut

#: A source is solved when its expected words are this near to its target (share of the target).
TOLERANCE = 1e-9
#: Sizes per source and power of two that may pay back rounding differences.
PAYBACK_SIZES = 32
#: Steps halve the bracket at worst; so many halvings reach the precision of a double.
_MOST_STEPS = 200


def word_count(text: Column) -> Column:
    """Number of words (runs of anything but spaces and tab to carriage return); null counts 0."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """A string that sorts sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _sorted_numbers(sources: DataFrame) -> DataFrame:
    """``sources`` (key, ...) with ``place``: 0, 1, ... in the order of key, by range partitions and their offsets."""
    rows = cut(sources.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id()))
    before = rows.groupBy("part").count().withColumn("before", F.sum("count").over(Window.orderBy("part")) - F.col("count"))  # one row a partition
    inside = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    return rows.withColumn("inside", inside).join(before.select("part", "before"), "part").select(
        *sources.columns, (F.col("before") + F.col("inside") - 1).alias("place"))


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``sources`` (key, words, ...) with ``target``: shares of ``share`` times all words by weight, at most ``most`` times the source's words.

    What a source cannot take is shared out again by weight among those below their limit until none is above it.
    """
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    rows = cut(_sorted_numbers(sources).withColumn("weight", F.element_at(pattern, (F.col("place") % len(weights) + 1).cast("int"))))
    limit = F.col("words") * float(most)
    total = rows.agg(F.sum("words")).first()[0] or 0
    full, level = -1, 0.0
    while total:
        above = limit <= F.lit(level) * F.col("weight")
        n, held, free = rows.agg(F.count_if(above), F.sum(F.when(above, limit).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if n == full or not free:
            break
        full, level = n, (share * total - held) / free
    return rows.withColumn("target", F.least(limit, F.lit(level) * F.col("weight")) if total else F.lit(0.0))


def _rate(size: Column, lam: Column, most: float) -> Column:
    return F.when(size == 0, F.lit(1.0)).otherwise(F.least(F.lit(float(most)), F.exp(lam * size)))


def _exact(words: Column) -> Column:
    """Sums of this do not depend on the order of the rows."""
    return F.sum(words.cast("decimal(38, 6)")).cast("double")


def solve_tilts(cells: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """``sources`` (key, words, smallest, target, ...) with ``lam``, the dual solution on ``cells`` (key, size, n).

    Newton on log(words taken) = log(target) per source, all sources in one aggregate a step; a step that leaves the
    bracket of the solution is replaced by the bracket's middle, so the loop ends.
    """
    safe = lambda c: F.nullif(c, F.lit(0.0))
    ratio = F.col("target") / safe(F.col("words").cast("double"))
    top = F.lit(math.log(most)) / F.col("smallest")  # here every document is at the limit
    state = sources.withColumn("lam", F.when(ratio >= most * (1 - 1e-12), top * 2).otherwise(0.0)).withColumn(
        "lo", F.when(ratio < 1, F.log(ratio) / F.col("smallest")).otherwise(0.0)).withColumn("hi", F.when(ratio > 1, top).otherwise(0.0)).withColumn(
        "open", (F.col("words") > 0) & (F.col("target") > 0) & (ratio < most * (1 - 1e-12)) & (ratio != 1)).fillna(False, ["open"])
    state = state.withColumn("lam", F.when((F.col("target") <= 0) & (F.col("words") > 0), F.lit(float("-inf"))).otherwise(F.col("lam")))
    state = cut(state)
    for _ in range(_MOST_STEPS):
        if state.where("open").isEmpty():
            break
        rows = cells.join(state.where("open").select("key", "lam"), "key")
        rate = _rate(F.col("size"), F.col("lam"), most)
        words = F.col("n") * F.col("size") * rate
        step = rows.groupBy("key").agg(_exact(words).alias("g"), _exact(F.when(rate < most, words * F.col("size")).otherwise(0.0)).alias("d"))
        moved = state.join(step, "key", "left")
        lam, g, d = F.col("lam"), F.col("g"), F.col("d")
        lo, hi = F.when(g < F.col("target"), lam).otherwise(F.col("lo")), F.when(g > F.col("target"), lam).otherwise(F.col("hi"))
        newton = lam + F.log(F.col("target") / safe(g)) * g / safe(d)
        middle = (lo + hi) / 2
        new = F.when((newton > lo) & (newton < hi), newton).otherwise(middle)
        near = (F.abs(g - F.col("target")) <= TOLERANCE * F.col("target")) | (middle <= lo) | (middle >= hi)
        state = cut(moved.select(*[c for c in state.columns if c not in ("lam", "lo", "hi", "open")],
                                 F.when(F.col("open") & ~near, new).otherwise(lam).alias("lam"), F.when(F.col("open"), lo).otherwise(F.col("lo")).alias("lo"),
                                 F.when(F.col("open"), hi).otherwise(F.col("hi")).alias("hi"), (F.col("open") & ~near).alias("open")))
    return state.drop("lo", "hi", "open")


def _cell_copies(cells: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """(key, size, n, rate, words, target, copies): whole copies of all documents of a source and size."""
    rows = cells.join(sources, "key").withColumn("rate", _rate(F.col("size"), F.col("lam"), most))
    chance = F.pmod(F.xxhash64("key", "size"), F.lit(1 << 30)) / float(1 << 30)
    limit = F.floor(F.col("n") * float(most)).cast("long")
    rows = rows.withColumn("limit", limit).withColumn("copies", F.least(F.col("limit"), F.floor(F.col("n") * F.col("rate") + chance).cast("long")))
    rows = cut(rows.select("key", "size", "n", "rate", "words", "target", "limit", "copies"))
    missing = rows.groupBy("key").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("missing"))
    order = Window.partitionBy("key", F.floor(F.log2("size"))).orderBy(F.desc("n"), F.desc("size"))
    some = rows.where("size > 0").withColumn("r", F.row_number().over(order)).where(F.col("r") <= PAYBACK_SIZES)
    lists = some.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("size", "copies", "limit")), asc=False).alias("cells")).join(missing, "key")

    def pay(acc: Column, c: Column) -> Column:
        fix = F.greatest(-c["copies"], F.least(c["limit"] - c["copies"], F.round(acc["missing"] / c["size"]).cast("long")))
        return F.struct((acc["missing"] - fix * c["size"]).alias("missing"), F.concat(acc["fixes"], F.array(F.struct(c["size"].alias("size"), fix.alias("fix")))).alias("fixes"))

    start = F.struct(F.col("missing"), F.expr("cast(array() as array<struct<size: bigint, fix: bigint>>)").alias("fixes"))
    fixes = lists.select("key", F.explode(F.aggregate("cells", start, pay, lambda acc: acc["fixes"])).alias("f")).select("key", "f.*").where("fix <> 0")
    return rows.join(fixes, ["key", "size"], "left").withColumn("copies", F.col("copies") + F.coalesce("fix", F.lit(0))).drop("fix", "limit")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, id_col: str = "doc_id",
                source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, source_size, target, taken, copies, rate, source.

    ``size`` counts words, ``source_size`` the source's, ``target`` the words that the mix should take of the source
    (``weights`` are repeated over the sources by code point, null last), ``copies`` says how often the
    mix takes the document, ``taken`` is copies times size, ``rate`` the tilted rate. A null text has size 0; documents of
    size 0 have rate 1. A null source is a source. A null id is an id; rows of equal id, source and size are
    alike, each is a document. Other columns are ignored; an empty table gives an empty table.

    A source of any share is fine: documents meet by (source, size, hash bucket of the id), and there are about as many
    buckets as the square root of the documents.
    """
    docs = docs.select(column(id_col).alias("id"), _source_key(column(source_col)).alias("key"), word_count(column(text_col)).alias("size"))
    units = cut(docs.groupBy("id", "key", "size").agg(F.count("*").alias("m")))
    cells = cut(units.groupBy("key", "size").agg(F.sum("m").alias("n")))
    sources = cells.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest"))
    sources = solve_tilts(cells, source_targets(sources, weights, share, most), most)
    done = _cell_copies(cells, sources, most)
    buckets = math.isqrt(units.count()) + 1
    units = units.withColumn("h", F.xxhash64("id")).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    base, extra = F.floor(F.col("copies") / F.col("n")).cast("long"), (F.col("copies") % F.col("n"))
    earlier = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = units.groupBy("key", "size", "bucket").agg(F.sum("m").alias("inside")).withColumn("before", F.coalesce(F.sum("inside").over(earlier), F.lit(0)))
    places = places.join(done, ["key", "size"]).select("key", "size", "bucket", "before", "words", "target", "rate", base.alias("base"), extra.alias("extra"))
    earlier = Window.partitionBy("key", "size", "bucket").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = units.withColumn("passed", F.coalesce(F.sum("m").over(earlier), F.lit(0))).join(places, ["key", "size", "bucket"])
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    copies = F.col("base") + (F.col("before") + F.col("passed") + F.col("i") <= F.col("extra")).cast("long")
    source = F.when(F.col("key") != "1", F.expr("substr(key, 2)"))
    return rows.select("id", "size", F.col("words").alias("source_size"), "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "rate",
                       source.alias("source"))
