"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import bpe, chat, conversations, decontaminate, fingerprints, html_text, language_id, mixing, phrases, secrets, simhash, toxicity, url_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def byte_bpe():
    """The encoder maker of the public byte-level vocabulary."""
    import public_tokenizers as tok

    return bpe.tokenizer(tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text: count, digest of the ids, digest of the decoded bytes."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_texts(docs, byte_bpe(), keep=["doc_id"], with_ids=False)


def op2_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and its edited version, and their likeness."""
    rows = fingerprints.fingerprint_versions(_table(spark, sf_dir, "documents"), digests=False)
    return rows.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


#: The rule set that op3 judges by.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate group of every document."""
    rows = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that stands in it: edits and place."""
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    rows = decontaminate.find_contamination(docs.select("doc_id", "text"), items, keep=["doc_id"])
    leak = F.explode("leaks").alias("leak")
    return rows.select("doc_id", leak).select("doc_id", "leak.item_id", "leak.edits", "leak.start", "leak.end")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text: counts of the fixed kinds, digest of their spans, all spans."""
    rows = secrets.scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(line(base), 256).alias("base_sha256"),
                       line(F.col("secrets")).alias("spans"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text, learnt from the labelled rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train_toxicity(docs.where("not held_out"), labels)
    return toxicity.score_toxicity(docs, model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every text, learnt from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.train_language_model(docs.where("not held_out"))
    rows = language_id.identify_languages(docs.drop("lang"), model, keep=["doc_id", "held_out"])
    return rows.select("doc_id", "held_out", "lang_pred", "score")


def op9_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation with its repaired role and its piece of the rendered conversation."""
    return chat.format_chats(_table(spark, sf_dir, "conversations"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages, keep=["page_id", "url"]).select("page_id", "url", "text", "n_chars")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language."""
    return phrases.collocations(_table(spark, sf_dir, "documents"), min_count=30, top=2000)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; sources weigh 3, 1, 2, repeating, and share 150 % of all words."""
    rows = mixing.mix_sources(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return rows.withColumnRenamed("id", "doc_id")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest repair and the digest of the repaired text."""
    turns = _table(spark, sf_dir, "conversations")
    facts, edits = conversations.repair_conversations(conversations.damage_turns(turns))
    empty = hashlib.sha256(b"").hexdigest()
    columns = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": empty}
    return conversations.merge_facts([turns.select("conv_id").distinct(), facts, conversations.repaired_digests(edits)], columns)


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_paragraph_sketch": op2_paragraph_sketch,
    "op3_url_rules": op3_url_rules,
    "op4_simhash_groups": op4_simhash_groups,
    "op5_decontamination": op5_decontamination,
    "op6_secrets": op6_secrets,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_chat_repair": op9_chat_repair,
    "op10_main_text": op10_main_text,
    "op11_collocations": op11_collocations,
    "op12_source_mix": op12_source_mix,
    "op13_conversation_repair": op13_conversation_repair,
}
