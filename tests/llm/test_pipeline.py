"""The corpus pipeline and the registered queries over small tables."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from reviewlake.llm.oracle import ORACLE
from reviewlake.llm.queries import QUERIES
from tests.conftest import SF001, SF01
from tests.llm.test_text_operators import closure, prose, slow_simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, secrets string, leaks string, __row string"


def write_tables(spark, folder, rows, items):
    spark.createDataFrame([(i, t, lang, "s", len(t or ""), 0.5, "x", "y", "z") for i, t, lang in rows], SCHEMA).write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))


def test_pipeline_equals_brute_force(spark, tmp):
    rng = random.Random(21)
    plain = [prose(rng, rng.randint(60, 200)) for _ in range(60)]
    items = [(1, prose(random.Random(5), 40)), (2, None), (3, "")]
    texts = list(plain)
    texts[7] = texts[3]                                             # a copy
    texts[9] = "intro words " + items[0][1] + " closing words here"  # a leak
    texts[11] += ' token = "a1b2c3d4e5f6a7b8c9d0a1b2c3d4e5f6" end'   # a secret
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(100, None, "en"), (101, "12 34 !!", None), (102, "", "en"), (None, plain[0] + " tail", "en"), (5, texts[5], "en")]
    rows.append((None, lone := prose(random.Random(77), 90), "en"))  # without an id and like no other
    write_tables(spark, tmp, rows, items)
    out = corpus_pipeline.run(spark, tmp).collect()
    everything = [*texts, plain[0] + " tail", lone]
    roots = closure([slow_simhash(t) for t in everything], 4)
    stays = {i for i in range(len(texts)) if roots[i] == i and i != 9}
    assert roots[7] == 3 and stays >= set(range(3)) | {3, 11}
    assert sorted((r.doc_id is None, r.doc_id) for r in out if r.doc_id is not None) == sorted((False, i) for i in stays)
    # a document without an id goes where one with an id is like it; the other one stays
    assert roots[-2] == 0 and roots[-1] == len(everything) - 1
    assert [r.decoded_sha256 for r in out if r.doc_id is None] == [hashlib.sha256(lone.encode()).hexdigest()]
    by_id = {r.doc_id: r for r in out}
    for i in stays:
        want = re.sub(r'token = "a1b2c3d4e5f6a7b8c9d0a1b2c3d4e5f6', "[SECRET]", texts[i])
        assert by_id[i].decoded_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_each_stage_keeps_the_columns(spark, tmp):
    rows = [(i, prose(random.Random(i), 80), "en") for i in range(12)] + [(20, None, None)]
    write_tables(spark, tmp, rows, [(1, prose(random.Random(99), 30))])
    docs = spark.read.parquet(os.path.join(tmp, "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, tmp)
        assert done.columns == docs.columns and done.dtypes == docs.dtypes
        assert done.select("doc_id", "__row", "score").collect() is not None
    secret = corpus_pipeline.secret_stage(spark, docs, tmp)
    assert secret.count() == docs.count() and secret.where("doc_id = 20 and text is null").count() == 1
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, tmp).count() == 0


def test_language_stage_drops_texts_of_unknown_scripts(spark, tmp):
    rows = [(i, prose(random.Random(i), 80), "en") for i in range(12)] + [(50, "ภาษาไทย " * 1000 + "river stone", None), (51, "river stone garden " * 9 + "ไทย", None)]
    write_tables(spark, tmp, rows, [(1, "a")])
    docs = spark.read.parquet(os.path.join(tmp, "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, tmp).collect()} == {*range(12), 51}


def test_language_stage_learns_from_all_texts(spark, tmp, monkeypatch):
    """The stage's language model counts the trigrams of every text that is not held out."""
    lid, models = corpus_pipeline.language_id, []
    monkeypatch.setattr(lid, "identify_languages", lambda docs, model, *a, f=lid.identify_languages, **k: models.append(model) or f(docs, model, *a, **k))
    rows = [(i, f"word{'abcdefgh'[i % 8]} {'xyz'[i % 3]}", "en" if i % 50 else "de") for i in range(6000)] + [(None, "lone", "en"), (6001, None, "en"), (6002, "none", None)]
    write_tables(spark, tmp, rows, [(1, "a")])
    corpus_pipeline.language_stage(spark, spark.read.parquet(os.path.join(tmp, "documents.parquet")), tmp).count()
    taught = [(t, x) for i, t, x in rows if t and x and (i is None or zlib.crc32(str(i).encode()) % 3 != 1)]
    counts = np.stack([np.bincount(lid._grams([t for t, x in taught if x == lang])["bucket"], minlength=2 ** lid.BUCKET_BITS) for lang in ("de", "en")], axis=1) + 0.1
    assert models[0].langs == ["de", "en"]
    assert np.allclose(models[0].weights, np.log(counts) - np.log(counts.sum(axis=0)), atol=1e-5)


def test_secret_stage_updates_lengths(spark, tmp):
    write_tables(spark, tmp, [(1, "key token=abcdefgh12 end", "en"), (2, "none", "en"), (3, None, "en")], [(1, "a")])
    docs = spark.read.parquet(os.path.join(tmp, "documents.parquet"))
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.secret_stage(spark, docs, tmp).collect()}
    assert got == {1: ("key [SECRET] end", 16), 2: ("none", 4), 3: (None, 0)}


def test_secret_stage_learns_from_all_texts(spark, tmp, monkeypatch):
    """The stage's law of words counts all rows and whole texts."""
    laws, limit = [], corpus_pipeline.secrets.randomness_limit
    monkeypatch.setattr(corpus_pipeline.secrets, "randomness_limit", lambda docs, law, *a: laws.append(law) or limit(docs, law, *a))
    write_tables(spark, tmp, [(1, "1 2 " * 2500 + "zq", "en"), *[(i, "jx", "en") for i in range(2, 6002)]], [(1, "a")])
    docs = spark.read.parquet(os.path.join(tmp, "documents.parquet"))
    assert corpus_pipeline.secret_stage(spark, docs, tmp).count() == 6001
    assert laws == [corpus_pipeline.secrets._word_law({"^z": 1.0, "zq": 1.0, "^j": 6000.0, "jx": 6000.0})]


def test_one_query_for_each_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert E.queries()["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    res = duck.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(res.fetchall())


@pytest.mark.parametrize("name", ["op1_byte_bpe", "op5_decontamination", "op7_toxicity", "op8_language_id", "op9_chat_repair", "op10_main_text"])
def test_queries_return_their_columns(spark, name):
    columns = {"op1_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256", "op5_decontamination": "doc_id item_id edits start end",
               "op7_toxicity": "doc_id held_out score predicted", "op8_language_id": "doc_id held_out lang_pred score",
               "op9_chat_repair": "conv_id turn place role_given role_fixed action rendered", "op10_main_text": "page_id url text n_chars"}[name].split()
    df = QUERIES[name](spark, SF001)
    assert df.columns == columns and df.count() > 0


def test_language_accuracy_on_held_out_documents(spark):
    rows = QUERIES["op8_language_id"](spark, SF01).where("held_out").join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = rows.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97
