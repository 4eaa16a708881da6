"""Language identification: script ranges narrow the candidates, a Viterbi pass over per-word scores labels spans.

A model is a table of character-trigram log probabilities per language and the scripts each language is
written in. Per word the trigram scores (with both word edges) are summed for the languages of the word's
script; a Viterbi pass with a switching penalty then labels the words of a text, so a mixed text falls into
spans and a single odd word does not.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from reviewlake.llm.batches import column, map_texts, slices

UNDETERMINED = "und"
#: log2 of the number of trigram buckets of a model.
BUCKET_BITS = 16
#: A label changes inside a text only where the other language's words win by this many nats.
SWITCH_PENALTY = 9.0
#: A language is written in a script that holds at least this share of its training letters.
SCRIPT_SHARE = 0.01
_EXCLUDED = -1e4
#: Code points whose words are labelled at once.
_LABEL_CHARS = 3_000_000
#: Languages that a task counts side by side.
_TABLES_AT_ONCE = 64

#: First and last code point of each script's main blocks (Unicode).
SCRIPT_RANGES = [
    ("Latin", 0x0041, 0x024F), ("Latin", 0x1E00, 0x1EFF), ("Latin", 0x2C60, 0x2C7F), ("Latin", 0xFF21, 0xFF5A),
    ("Greek", 0x0370, 0x03FF), ("Greek", 0x1F00, 0x1FFF),
    ("Cyrillic", 0x0400, 0x052F), ("Cyrillic", 0x1C80, 0x1C8F), ("Cyrillic", 0x2DE0, 0x2DFF),
    ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF),
    ("Arabic", 0x0600, 0x06FF), ("Arabic", 0x0750, 0x077F), ("Arabic", 0xFB50, 0xFDFF), ("Arabic", 0xFE70, 0xFEFF),
    ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF), ("Tamil", 0x0B80, 0x0BFF), ("Telugu", 0x0C00, 0x0C7F),
    ("Thai", 0x0E00, 0x0E7F), ("Georgian", 0x10A0, 0x10FF),
    ("Hangul", 0x1100, 0x11FF), ("Hangul", 0x3130, 0x318F), ("Hangul", 0xAC00, 0xD7AF),
    ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x4DBF), ("Han", 0x4E00, 0x9FFF), ("Han", 0x20000, 0x2FA1F),
]
SCRIPTS = ["Other"] + list(dict.fromkeys(s for s, _, _ in SCRIPT_RANGES))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: letter (2), mark inside words (1) or neither (0); lower case; script number."""
    n = 0x110000
    kinds = np.zeros(n, np.uint8)
    lower = np.arange(n, dtype=np.uint32)
    for c in range(0x32400):  # no letter is assigned beyond
        cat = unicodedata.category(chr(c))[0]
        if cat == "L":
            kinds[c] = 2
            low = chr(c).lower()
            lower[c] = ord(low[0])
        elif cat == "M":
            kinds[c] = 1
    script = np.zeros(n, np.uint8)
    for name, a, b in SCRIPT_RANGES:
        script[a:b + 1] = SCRIPTS.index(name)
    return kinds, lower, script


def _grams(texts: list[str]) -> dict[str, np.ndarray]:
    """Words of the texts (joined by line feeds) and their trigram buckets, as flat arrays."""
    kinds, lower, script = _tables()
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds[cp]
    inside = kind > 0
    x = np.where(inside, lower[cp], 0).astype(np.uint64)
    before = np.concatenate(([False], inside[:-1]))
    opens, closes = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    letters = np.add.reduceat((kind == 2).astype(np.int64), opens) if len(opens) else np.zeros(0, np.int64)
    at = np.flatnonzero(inside | before)  # each word's code points and the edge behind them
    p1 = np.concatenate(([0], x[:-1])).astype(np.uint64)
    p2 = np.where(p1 == 0, np.uint64(0), np.concatenate(([0, 0], x[:-2])).astype(np.uint64))
    h = x[at] * np.uint64(0x9E3779B97F4A7C15) + p1[at] * np.uint64(0xC2B2AE3D27D4EB4F) + p2[at] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    bucket = ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(closes - opens + 1)))[:-1]
    row = np.searchsorted(begins, opens, side="right") - 1
    return {"row": row, "start": opens - begins[row] if len(opens) else opens, "end": closes - begins[row] if len(opens) else closes,
            "letters": letters, "script": script[cp[opens]], "bucket": bucket, "first": first.astype(np.int64)}


@dataclass(frozen=True)
class LanguageModel:
    """``weights``: log probability of each trigram bucket per language; ``allowed``: script by language."""

    langs: list[str]
    weights: np.ndarray = field(repr=False)
    allowed: np.ndarray = field(repr=False)


def train_language_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Trigram and script counts of each language over all texts of ``docs``.

    Rows without text or language teach nothing. Counting runs on Spark, a table of fixed size a language in each task; the driver
    gets one row per language and bucket (at most 2 ** BUCKET_BITS) and one per language and script.
    """
    rows = docs.select(column(text_col).cast("string").alias("t"), column(lang_col).cast("string").alias("l")).where("t is not null and l is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, found in tables.items():
                for kind, counts in zip(("gram", "script"), found, strict=True):
                    ids = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids), pa.string()), pa.array([kind] * len(ids), pa.string()),
                                                      pa.array(ids, pa.int32()), pa.array(counts[ids])], names=["l", "kind", "id", "n"])
            tables.clear()

        for b in batches:
            langs, texts = b.column(1).to_pylist(), b.column(0).to_pylist()
            for lang in set(langs):
                if len(tables) == _TABLES_AT_ONCE:
                    yield from counted()
                grams, letters = tables.setdefault(lang, (np.zeros(2 ** BUCKET_BITS, np.int64), np.zeros(len(SCRIPTS), np.int64)))
                for _, part in slices([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                    g = _grams(part)
                    grams += np.bincount(g["bucket"], minlength=len(grams))
                    letters += np.bincount(g["script"], g["letters"], len(letters)).astype(np.int64)
        yield from counted()

    counts = rows.mapInArrow(count, "l string, kind string, id int, n long").groupBy("l", "kind", "id").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["l"] for r in counts if r["kind"] == "gram"})
    grams = np.zeros((2 ** BUCKET_BITS, len(langs)))
    letters = np.zeros((len(SCRIPTS), len(langs)))
    for r in counts:
        (grams if r["kind"] == "gram" else letters)[r["id"], langs.index(r["l"])] += r["n"]
    weights = np.log(grams + 0.1) - np.log((grams + 0.1).sum(axis=0)) if langs else grams
    allowed = letters >= SCRIPT_SHARE * letters.sum(axis=0) if langs else letters > 0
    return LanguageModel(langs, weights.astype(np.float32), allowed & (letters > 0))


def _viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word; texts are runs of words given by ``first`` and ``count``.

    All texts of a batch advance together, longest first, so a step costs a few array operations."""
    k = scores.shape[1]
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    alive = np.searchsorted(-count, -np.arange(count[0] if len(count) else 0), side="left")
    came = np.empty(scores.shape, np.int8)
    own = np.arange(k, dtype=np.int8)
    best = np.zeros((len(first), k), np.float32)
    for t, n in enumerate(alive):
        at = first[:n] + t
        v = best[:n]
        top = v.argmax(axis=1)
        m = v[np.arange(n), top][:, None] - penalty
        stay = v >= m
        came[at] = np.where(stay, own, top[:, None])
        best[:n] = np.where(stay, v, m) + scores[at]
    labels = np.empty(len(scores), np.int8)
    last = best.argmax(axis=1).astype(np.int8)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = first[:n] + t
        labels[at] = last[:n]
        last[:n] = came[at, last[:n]]
    return labels


def _label(model: LanguageModel, penalty: float, texts: list) -> list:
    k = len(model.langs)
    parts = []
    for base, part in slices(texts):
        g = _grams(part)
        words = len(g["first"])
        s = np.add.reduceat(model.weights[g["bucket"]], g["first"], axis=0) if words and k else np.zeros((words, k), np.float32)
        ok = model.allowed[g["script"]] if k else np.zeros((words, 0), bool)
        known = ok.any(axis=1) & (g["letters"] > 0)
        use = np.flatnonzero(g["letters"] > 0)
        s = np.where(ok[known], s[known], np.float32(_EXCLUDED))
        parts.append(((g["row"][use] + base).astype(np.int32), g["start"][use].astype(np.int32), g["end"][use].astype(np.int32),
                      g["letters"][use].astype(np.int32), known[use], s.astype(np.float32)))
    row, start, end, letters, known, scores = (
        (np.concatenate([p[i] for p in parts]) if parts else np.zeros((0, k) if i == 5 else 0, bool if i == 4 else np.int32)) for i in range(6))
    del parts
    n = len(texts)
    count = np.bincount(row[known], minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    labels = np.full(len(row), k, np.int16)  # a word in a script that no language uses
    if known.any():
        labels[known] = _viterbi(scores, first, count, penalty)
    weight = np.bincount(row.astype(np.int64) * (k + 1) + labels, letters, n * (k + 1)).reshape(n, k + 1)
    total = weight.sum(axis=1)
    found = weight[:, :k].max(axis=1, initial=0.0)
    names = np.array([*model.langs, UNDETERMINED], dtype=object)
    pred = names[np.where(found > 0, weight[:, :k].argmax(axis=1) if k else 0, k)]
    share = found / np.maximum(total, 1)
    fresh_span = np.ones(len(row), bool)
    fresh_span[1:] = (row[1:] != row[:-1]) | (labels[1:] != labels[:-1])
    s0 = np.flatnonzero(fresh_span)
    s1 = np.concatenate((s0[1:], [len(row)])) - 1 if len(s0) else s0
    per_row = np.bincount(row[s0], minlength=n) if len(s0) else np.zeros(n, np.int64)
    spans = pa.StructArray.from_arrays(
        [pa.array(start[s0], pa.int32()), pa.array(end[s1], pa.int32()), pa.array(list(names[labels[s0]]), pa.string())], names=["start", "end", "lang"])
    offsets = pa.array(np.concatenate(([0], np.cumsum(per_row))), pa.int32())
    return [pa.array(list(pred), pa.string()), pa.array(share, pa.float64()), pa.ListArray.from_arrays(offsets, spans)]


def identify_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text", penalty: float = SWITCH_PENALTY,
                       keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred`` (the language with most letters, or ``und``), ``score`` (its share of all letters)
    and ``lang_spans`` (array of start, end, lang; code points, end exclusive; words joined to runs).

    A null or empty text or one without a letter gives ``und``, score 0 and no spans. Words in scripts that no
    learned language uses are ``und`` in the spans and count in the share; a text of such words only is ``und``
    with score 0. Equal scores go to the language first in name order. Whole texts are
    read; equal texts get equal results. ``keep`` names the input columns kept (default all); input
    columns named like an output give way to it. No shuffle.
    """
    span = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("lang", StringType())])
    out = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("lang_spans", ArrayType(span))]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: buckets by languages

    def setup():
        def run(texts: list) -> list:
            done = [_label(shared.value, penalty, part) for _, part in slices(texts, _LABEL_CHARS)]
            return [pa.concat_arrays(a) for a in zip(*done, strict=True)] if done else _label(shared.value, penalty, [])

        return run

    return map_texts(docs, text_col, setup, out, keep)


def held_out(key: Column) -> Column:
    """True for rows kept from training: crc32 of the key's text mod 3 is 1 (false for a null key)."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))
