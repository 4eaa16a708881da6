"""URL rules by a sort-merge range join on reversed hosts. Spark functions only.

A host becomes a key of its labels in reverse, each closed by a separator, so that a host and all its
subdomains are one interval of keys and intervals nest or are apart. Rule hosts open and close intervals;
hosts and interval ends are sorted together and swept: what is active at a key is the stack of nested rule
hosts that the last interval end before it left. The stack's rules whose path begins the url's path apply,
the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.batches import column, fresh

#: Behind each label: sorts below every character of a host. Behind a key: sorts above all that continue it.
_SEP, _END = "\u0001", "\U0010FFFF"
#: Hosts (with the interval ends) that one sorted block holds, about.
BLOCK_HOSTS = 100_000
#: What a url gets that no rule fits.
DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by the separator."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), _SEP), F.lit(_SEP))


def _ancestors(host: Column) -> Column:
    """The host itself and the hosts above it."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _interval_ends(rules: DataFrame) -> DataFrame:
    """(key, stack): the rules active from each interval's start on, and again from behind its end on.

    The stack at a start holds the rules of the host and of all hosts above it; behind an end, those above
    only. Ends are written only where an interval closes, so the last one at or before a key is in force.
    """
    by_host = rules.groupBy("host").agg(F.collect_list(F.struct("host", "path", "verdict")).alias("own"))
    above = by_host.select("host", F.explode(_ancestors(F.col("host"))).alias("above"))
    held = above.join(by_host.select(F.col("host").alias("above"), "own"), "above")
    stacks = held.groupBy("host").agg(F.flatten(F.collect_list("own")).alias("stack"),
                                      F.flatten(F.collect_list(F.when(F.col("above") != F.col("host"), F.col("own")))).alias("outer"))
    key = host_key(F.col("host"))
    return stacks.select(F.explode(F.array(F.struct(key.alias("key"), F.col("stack").alias("stack")),
                                           F.struct(F.concat(key, F.lit(_END)).alias("key"), F.col("outer").alias("stack")))).alias("e")).select("e.*")


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``hosts`` (host, distinct) -> (host, stack) by the sorted sweep.

    Hosts are dealt by their last label and, where that has many hosts, into further blocks by hash; each
    block sweeps its hosts with the interval ends of its last label, which are copied to every block.
    """
    top = lambda h: F.element_at(F.split(h, r"\.", -1), -1)
    hosts = hosts.select("host", host_key(F.col("host")).alias("key"), top(F.col("host")).alias("top"))
    sizes = hosts.groupBy("top").agg(F.ceil(F.count("*") / BLOCK_HOSTS).cast("int").alias("blocks"))
    dealt = hosts.join(sizes, "top").select("top", F.pmod(F.xxhash64("host"), "blocks").cast("int").alias("block"), "key", "host", F.lit(1).alias("point"))
    ends = _interval_ends(rules).withColumn("top", F.substring_index("key", _SEP, 1)).join(sizes, "top")
    ends = ends.select("top", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "key", "stack", F.lit(0).alias("point"))
    line = dealt.withColumn("stack", F.lit(None).cast(ends.schema["stack"].dataType)).unionByName(ends.withColumn("host", F.lit(None).cast("string")))
    sweep = Window.partitionBy("top", "block").orderBy("key", "point").rowsBetween(Window.unboundedPreceding, 0)
    swept = line.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
    return swept.where("point = 1").select("host", "stack")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (host and path of the rule that decides, else null) and ``verdict``.

    ``rules``: (host, path, verdict). A rule fits its host and all subdomains where the url's path starts
    with the rule's. The longest rule (host and path together) wins, then the one of the longer host; of
    equal rules with different verdicts ``block`` wins. A null url or one without ``://`` has an empty host and
    path, which no rule fits; neither does a rule with a null host or path. Urls without a fitting rule get
    ``default``. Rows stay as they are, repeated ones too; input columns named like an output give way to it.
    Distinct hosts are swept, so a host that holds most urls is one row there; the join back splits it.
    """
    names = ["host", "path", "rule", "verdict"]
    url = fresh(pages, "__url")
    kept = [c for c in pages.columns if c.lower() not in names]
    rows = pages.select(*[column(c) for c in kept], column(url_col).cast("string").alias(url))
    rows = rows.select(*[column(c) for c in kept], url_host(column(url)).alias("host"), url_path(column(url)).alias("path"))
    rules = rules.select(F.lower("host").alias("host"), "path", "verdict").where("host is not null and path is not null").distinct()
    stack = fresh(pages, "__stack")
    active = active_rules(rows.select("host").distinct(), rules).where(F.size("stack") > 0).withColumnRenamed("stack", stack)
    rows = rows.join(active, "host", "left")
    fits = F.filter(column(stack), lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        (F.length(r["host"]) + F.length(r["path"])).alias("size"), F.length(r["host"]).alias("host_size"), (r["verdict"] == "block").alias("blocks"),
        F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict"))))
    chosen = fresh(pages, "__best")
    rows = rows.withColumn(chosen, best)
    return rows.select(*[column(c) for c in kept], "host", "path", F.col(f"{chosen}.rule").alias("rule"),
                       F.coalesce(F.col(f"{chosen}.verdict"), F.lit(default)).alias("verdict"))
