"""Corpus pipeline: language ID, near duplicates, decontamination, secrets, tokens; each stage is one table.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all that its
predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import bpe, decontaminate, language_id, secrets, simhash
from reviewlake.llm.batches import column, cut, fresh
from reviewlake.llm.queries import byte_bpe
from reviewlake.session import checkpoint_dir

#: A document stays if the words of one language hold at least this share of its letters.
MIN_LANGUAGE_SHARE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identified language (null, no letters, unknown script) and those in which
    no language holds ``MIN_LANGUAGE_SHARE`` of the letters. Learns from the rows that are not held out."""
    model = language_id.train_language_model(docs.where(~language_id.held_out(F.col("doc_id"))))
    data = fresh(docs, "__row")
    packed = docs.select("text", F.struct(*[column(c) for c in docs.columns]).alias(data))
    rows = language_id.identify_languages(packed, model, keep=[data])
    return rows.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SHARE)).select(f"{data}.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the one of the least id, of equal ids that with the least text digest.

    Documents without an id come after all others. Rows that share id and text are one document, whatever their other columns say;
    one of them stays. An id that stands for two texts names two documents.
    """
    cols = [column(c) for c in docs.columns]
    handle = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.coalesce(F.sha2("text", 256), F.lit("")).alias("digest"))
    key, data, order = fresh(docs, "__key"), fresh(docs, "__row"), fresh(docs, "__order")
    spelled = lambda h: F.sha2(F.concat_ws(":", h["none"].cast("string"), h["id"].cast("string"), h["digest"]), 256)
    groups = simhash.near_duplicates(docs.select(handle.alias("doc_id"), "text"))
    first = groups.where(F.col("id").eqNullSafe(F.col("component"))).groupBy(spelled(F.col("id")).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    first = cut(first)
    left = docs.select(*cols, spelled(handle).alias(key))
    kept = left.join(first.select(key), key, "left_semi").select(*cols)
    repeated = first.where("n > 1").select(key)
    if repeated.isEmpty():
        return kept
    plain = [column(c) for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    copies = left.join(repeated, key, "left_semi").select(key, F.struct(*cols).alias(data), F.xxhash64(*plain).alias(order))
    one = copies.groupBy(key).agg(F.min_by(data, order).alias(data)).select(f"{data}.*")
    return left.join(first.where("n = 1").select(key), key, "left_semi").select(*cols).unionByName(one)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item stands, up to the operator's edit limit."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    data = fresh(docs, "__row")
    packed = docs.select("text", F.struct(*[column(c) for c in docs.columns]).alias(data))
    rows = decontaminate.find_contamination(packed, items, keep=[data], out="leaks")
    return rows.where(F.size("leaks") == 0).select(f"{data}.*")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark (``n_chars`` follows); every document stays, a null text too."""
    found = fresh(docs, "__secrets")
    rows = secrets.scan_secrets(docs, out=found)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(secrets.redact(F.col("text"), column(found)))
    done = rows.withColumn("text", text).drop(found)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return done.select(*[column(c) for c in docs.columns])


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document: doc_id, count, digests of ids and decoded bytes, and the ids."""
    return bpe.encode_texts(docs.select("doc_id", "text"), byte_bpe(), keep=["doc_id"])


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("byte_bpe", token_stage),
]

#: SQL cannot express the stages (trained scores, walks, merges); tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    base = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
