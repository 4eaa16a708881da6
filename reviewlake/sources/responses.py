"""API responses whose shape drifts.

The strict reader fails on a response without its list, the lenient one passes it over in silence, and both
turn a field of another type into null. Here a response is read as VARIANT: each one is judged (``status``), its
entries are taken wherever they can be, and every field that is lost is counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.sources import schemas
from reviewlake.sources.files import _show_day

#: status: entries read; an empty list; no list; one entry without a list around it; a list of another type; no JSON.
STATUSES = ("ok", "empty", "absent", "single", "mistyped", "unparsed")


def read_responses(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Landed responses, one row each: ``file_name``, ``raw`` and ``response`` (VARIANT, null where the text is no JSON).

    ``multi_line``: one response per file; false: one per line.
    """
    raw = spark.read.option("wholetext", str(multi_line).lower()).text(path)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]*)$", 1).alias("file_name"), F.col("value").alias("raw"),
                      F.try_parse_json("value").alias("response"))


def _kind(v: Column) -> Column:
    """Type of a variant: ARRAY, OBJECT, or the name of a scalar; null for none."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def judge_responses(responses: DataFrame, list_path: str) -> DataFrame:
    """``responses`` with ``status`` and ``entries`` (array of VARIANT, empty where there are none)."""
    items = F.try_variant_get("response", list_path, "array<variant>")  # null for all but a list
    other = F.when(F.col("_items").isNull(), F.try_variant_get("response", list_path, "variant"))
    kind = _kind(F.col("_list"))
    status = (F.when(F.col("response").isNull(), "unparsed").when(F.size("_items") == 0, "empty").when(F.col("_items").isNotNull(), "ok")
              .when(F.col("_list").isNull() | (kind == "VOID"), "absent").when(kind == "OBJECT", "single").otherwise("mistyped"))
    entries = F.when(F.col("status") == "ok", F.col("_items")).when(F.col("status") == "single", F.array("_list")).otherwise(
        F.expr("cast(array() as array<variant>)"))
    return (responses.withColumn("_items", items).withColumn("_list", other).withColumn("status", status).withColumn("entries", entries)
            .drop("_list", "_items"))


def _nested(v: Column) -> Column:
    """Whether a variant is a list or an object; false for none."""
    return F.try_variant_get(v, "$", "array<variant>").isNotNull() | F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def entry_fields(entry: Column, fields: Sequence[str]) -> list[Column]:
    """The ``fields`` of a VARIANT entry as text; numbers and booleans are spelled out, lists and objects give null."""
    def text(name: str) -> Column:
        v = F.try_variant_get(entry, f"$.{name}", "variant")
        return F.when(~_nested(v), F.try_variant_get(v, "$", "string")).alias(name)

    return [text(f) for f in fields]


def lost_fields(entry: Column, fields: Sequence[str]) -> tuple[Column, Column, Column]:
    """(unknown, missing, mistyped) of an entry: names that it has beyond ``fields``, names that it lacks, and names whose value is a list or an object."""
    return _lost(entry, _by_shape(entry), fields)


def _by_shape(entry: Column) -> Column:
    """An entry's fields by name, once with the values that are lists and once with those that are objects; all others are null."""
    return F.struct(F.try_variant_get(entry, "$", "map<string,array<variant>>").alias("lists"),
                    F.try_variant_get(entry, "$", "map<string,map<string,variant>>").alias("objects"))


def _deep(fields: Sequence[str]) -> list[str]:
    """The ``fields`` that lie within a field of the entry."""
    return [f for f in fields if "." in f or "[" in f]


def _lost(entry: Column, shapes: Column, fields: Sequence[str]) -> tuple[Column, Column, Column]:
    none = F.expr("cast(array() as array<string>)")
    have = F.coalesce(F.map_keys(shapes["lists"]), none)
    known, flat = (F.array(*[F.lit(f) for f in names]).cast("array<string>") for names in (fields, [f for f in fields if f not in _deep(fields)]))
    nested = F.concat(*[F.coalesce(F.map_keys(F.map_filter(shapes[s], lambda _, v: v.isNotNull())), none) for s in ("lists", "objects")])
    bad = F.filter(flat, lambda f: F.array_contains(nested, f))
    if _deep(fields):
        bad = F.concat(bad, F.array_compact(F.array(*[F.when(_nested(F.try_variant_get(entry, f"$.{f}", "variant")), F.lit(f)) for f in _deep(fields)])))
    return F.array_except(have, known), F.array_except(known, have), bad


def _count_lost(entries: Column, fields: Sequence[str]) -> Column:
    """How many fields ``lost_fields`` names over all ``entries``: an array of the three counts."""
    usual = F.array(*[F.lit(f) for f in sorted(fields)]).cast("array<string>")  # as an object has its names

    def add(counts: Column, entry: Column, shapes: Column) -> Column:
        some = F.array(*[counts[k] + F.size(names) for k, names in enumerate(_lost(entry, shapes, fields))])
        if _deep(fields):
            return some
        nested = [F.exists(F.map_values(shapes[s]), lambda v: v.isNotNull()) for s in ("lists", "objects")]
        return F.when((F.map_keys(shapes["lists"]) == usual) & ~nested[0] & ~nested[1], counts).otherwise(some)  # most entries lose nothing

    # the inner fold is over one item: it works an entry's shapes out once, for all that reads them
    return F.aggregate(entries, F.array(*[F.lit(0)] * 3), lambda counts, e: F.aggregate(F.array(_by_shape(e)), counts, lambda n, shapes: add(n, e, shapes)))


def read_boxoffice_drifting(spark: SparkSession, path: str, *, multi_line: bool = True, fields: Sequence[str] = tuple(schemas.BOXOFFICE_FIELDS),
                            root: str = "$.boxOfficeResult", together: bool = False) -> tuple[DataFrame, DataFrame] | DataFrame:
    """S13 / S14 for drifting payloads: (rows, audit).

    rows: boxoffice_date and the text ``fields`` of every entry that can be read, also of a single entry without its list.
    audit: one row a response: file_name, boxoffice_date, status, entries, and unknown, missing and mistyped (counts of
    fields over its entries), raw where no entry could be read. ``root`` is where the payload lies (``$.data.boxOfficeResult`` for regional ones).
    ``together``: both in one table, for a reader of both, so that a response is parsed once: the audit with the ``place`` 0, and
    after it the response's rows with the places from 1 on, beside the same audit.
    """
    judged = judge_responses(read_responses(spark, path, multi_line=multi_line), f"{root}.dailyBoxOfficeList")
    day = _show_day(F.try_variant_get("response", f"{root}.showRange", "string"))
    judged = judged.withColumn("boxoffice_date", day).withColumn("_lost", _count_lost(F.col("entries"), fields)).withColumnRenamed("entries", "_entries")
    audit = judged.select("file_name", "boxoffice_date", "status", F.size("_entries").alias("entries"),
                          *[F.col("_lost")[k].alias(name) for k, name in enumerate(("unknown", "missing", "mistyped"))],
                          F.when(F.size("_entries") == 0, F.col("raw")).alias("raw"), "_entries")
    # outer: otherwise a filter on the entries is inferred, which parses a response again wherever it mentions them
    each = audit.select("*", F.posexplode_outer(F.concat(F.array(F.lit(None).cast("variant")), "_entries")).alias("place", "_entry")).drop("_entries")
    if together:
        return each.select(*[c for c in each.columns if c != "_entry"], *entry_fields(F.col("_entry"), fields))
    return each.where("place > 0").select("boxoffice_date", *entry_fields(F.col("_entry"), fields)), audit.drop("_entries")


def payload_schema(responses: DataFrame) -> DataFrame:
    """One row: the schema of all the responses together, as Spark writes it, for a look at what an API sends now."""
    return responses.agg(F.schema_of_variant_agg("response").alias("schema"))
