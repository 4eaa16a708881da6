"""CSV ingest that keeps what it cannot read.

A reader in ``PERMISSIVE`` mode turns a short row into nulls and a long one into a cut, and nobody notices. Here every
landed record ends in exactly one of two tables: the rows that fit the schema, and the rejects with their file, their
raw text and what is wrong. The input is parsed once; the counts come from the same pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewlake.functions.files import source_file_name
from reviewlake.sources.files import read_csv

RECORD = "_record"


@dataclass(frozen=True)
class Landed:
    """What ``land_csv`` made: the two tables and how many records went where."""

    good: DataFrame
    rejects: DataFrame
    rows: int
    rejected: int


def parse_csv(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """The records under ``path`` by ``schema``, with ``_record`` (the raw text of a record that does not fit, else null) and ``file_name``."""
    typed = StructType([*schema.fields, StructField(RECORD, StringType())])
    # all columns are parsed whatever is selected later: a pruned parse would not see that a row is short
    return read_csv(spark, path, typed, columnNameOfCorruptRecord=RECORD, columnPruning="false", **options).withColumn("file_name", source_file_name())


def problem(record: Column, schema: StructType) -> Column:
    """Why a raw record does not fit: ``fields`` (more or fewer than the schema has) or ``value`` (a field of another type)."""
    texts = ", ".join([f"`{f.name}` STRING" for f in schema.fields] + [f"`{RECORD}` STRING"])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    return F.when(F.from_csv(record, texts, options)[RECORD].isNull(), F.lit("value")).otherwise(F.lit("fields"))


def land_csv(spark: SparkSession, path: str, schema: StructType, out: str, **options) -> Landed:
    """Reads the CSV files under ``path`` once and writes ``out/rejected=false`` and ``out/rejected=true``.

    good has the schema's columns and ``file_name``; rejects has ``file_name``, ``record`` (raw text without its line end) and
    ``problem``. A record with a quoted line break is one record. Nothing is dropped: good plus rejects are the landed records.
    """
    parsed = parse_csv(spark, path, schema, **options)
    seen = Observation()
    parsed = parsed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(RECORD).isNotNull()).alias("rejected"))
    parsed.withColumn("rejected", F.col(RECORD).isNotNull()).write.mode("overwrite").partitionBy("rejected").parquet(out)
    counts = seen.get
    stored = spark.read.schema(StructType([*parsed.schema.fields, StructField("rejected", StringType())])).parquet(out)
    record = F.regexp_replace(RECORD, "[\\\\r\\\\n]+$", "")
    good = stored.where("rejected = 'false'").select(*schema.names, "file_name")
    rejects = stored.where("rejected = 'true'").select("file_name", record.alias("record"), problem(record, schema).alias("problem"))
    return Landed(good, rejects, counts["rows"] or 0, counts["rejected"] or 0)
