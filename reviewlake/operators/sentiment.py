"""Review sentiment.

A19 (distinct sentiment values to loop over) is not needed: sentiment is a
group key in every aggregate here.

The reference labels each review with a transformer run row by row on the
driver. Here the label is a column computed inside the executors:

* ``score_lexicon`` (default): the review's words are looked up in a
  weighted lexicon held as hash-set literals (one per weight) and summed
  with higher-order functions, row by row inside the scan stage: no
  explode, no join, no shuffle. The whole text is scored.
* ``score_lexicon_table``: the same score for a lexicon too large for a
  literal: explode, join (broadcast by measured size) and re-aggregate.
* ``fit_sentiment_model`` / ``score_model``: a trained ``pyspark.ml``
  pipeline (tokenizer, hashing TF, IDF, logistic regression).
* ``score_with_plugin``: any batch scorer through ``mapInPandas``; the
  model is built once per task and fed Arrow batches.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.text import (STOPWORDS_KO_LONG, clean_for_tokens, col_, split_words)
from reviewlake.operators.keywords import tokens
from reviewlake.operators.skew import share_of_group, top_n
from reviewlake.session import checkpoint_dir

# The reference's model labels and their meaning.
LABELS = {"LABEL_0": "negative", "LABEL_1": "positive"}
# The reference's display names for the two labels.
LABELS_KO = {"LABEL_0": "부정", "LABEL_1": "긍정"}

# Ours: small weighted lexicons (word, weight, part of speech).
LEXICON_KO = [
    ("최고", 2, "Noun"), ("감동", 2, "Noun"), ("재밌어요", 2, "Adjective"), ("좋아요", 1, "Adjective"),
    ("추천", 1, "Noun"), ("연기", 1, "Noun"), ("별로", -1, "Noun"), ("지루", -2, "Noun"),
    ("최악", -2, "Noun"), ("아쉬워요", -1, "Adjective"), ("실망", -2, "Noun"), ("졸려요", -1, "Verb"),
]
LEXICON_LATIN = [
    ("and", 1, "Conjunction"), ("with", 1, "Preposition"), ("for", 1, "Preposition"),
    ("und", 1, "Conjunction"), ("mit", 1, "Preposition"), ("für", 1, "Preposition"),
    ("et", 1, "Conjunction"), ("pour", 1, "Preposition"), ("con", 1, "Preposition"),
    ("no", -2, "Adverb"), ("not", -2, "Adverb"), ("that", -1, "Pronoun"), ("was", -1, "Verb"),
    ("von", -1, "Preposition"), ("sich", -1, "Pronoun"), ("que", -1, "Pronoun"), ("qui", -1, "Pronoun"),
]

SENTIMENT_COLUMNS = ["movieNm", "context", "sentiment", "platform", "date"]


def word_weight(lexicon: Sequence[tuple]):
    """``word -> weight`` as one membership test per distinct weight.

    Each word list becomes a hash-set lookup (``InSet``), so a word costs a
    few hash probes whatever the lexicon size; a map literal is searched
    linearly (measured: 2,000 words, 14x slower).
    """
    by_weight: dict[int, list[str]] = {}
    seen: set[str] = set()
    for w, wt, *_ in lexicon:
        if w in seen:
            raise ValueError(f"lexicon word listed twice: {w!r}")
        seen.add(w)
        by_weight.setdefault(int(wt), []).append(w)

    def weight(w: Column) -> Column:
        e = F.lit(0)
        for wt, ws in sorted(by_weight.items()):
            e = F.when(w.isin(ws), F.lit(wt)).otherwise(e)
        return e

    return weight


def lexicon_score(text, lexicon: Sequence[tuple], charset: str = "hangul+jamo") -> Column:
    """Sum of lexicon weights over the words of ``text``."""
    words = split_words(clean_for_tokens(text, charset))
    weights = F.transform(words, word_weight(lexicon))
    return F.aggregate(weights, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def label_of(score) -> Column:
    """Binary label, as the reference model: positive when the score is above 0."""
    return F.when(col_(score) > 0, F.lit("LABEL_1")).otherwise(F.lit("LABEL_0"))


def value_map(c, mapping: dict[str, str]) -> Column:
    """Map values; unmatched gives null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), col_(c))


def review_inputs(df: DataFrame) -> DataFrame:
    """the scorer's input, rows with any null among its columns dropped."""
    keep = ["movieNm", "context", "platform", "date"] + (["id"] if "id" in df.columns else [])
    return df.select(*keep).na.drop("any", subset=["movieNm", "context", "platform", "date"])


def score_lexicon(df: DataFrame, lexicon: Sequence[tuple] = LEXICON_KO, charset: str = "hangul+jamo") -> DataFrame:
    """U1(a): ``review_sentiment`` from a lexicon (whole text, no shuffle)."""
    base = review_inputs(df)
    score = lexicon_score("context", lexicon, charset)
    return base.withColumn("score", score).withColumn("raw_label", label_of("score")).withColumn(
        "sentiment", value_map("raw_label", LABELS))


def review_key(*cols: str) -> Column:
    """Digest that identifies a review: by default reviewer, text and film (``id`` alone is the reviewer)."""
    return F.sha2(F.to_json(F.struct(*(cols or ("id", "context", "movieNm")))), 256)


def score_lexicon_table(df: DataFrame, lexicon: DataFrame, charset: str = "hangul+jamo") -> DataFrame:
    """U1(a) for a lexicon table (word, weight): explode, join, sum per review.

    Words meet the lexicon before anything is grouped: what the lexicon does
    not hold never leaves the scan stage when the planner can broadcast the
    lexicon, and is not grouped by review in any case. Scores meet
    their reviews by ``review_key``, so texts are not moved for them.
    """
    key = F.unhex(review_key(*[c for c in ("id", "context", "movieNm") if c in df.columns]))
    lex = lexicon.select("word", F.col("weight").cast("bigint").alias("weight"))
    # the key is a column before the words are: selected beside explode, the text would be hashed again for each of its words
    rows = review_inputs(df).withColumn("_review", key)
    words = rows.select("_review", F.explode(split_words(clean_for_tokens("context", charset))).alias("word"))
    hits = words.join(lex, "word", "inner").groupBy("_review").agg(F.sum("weight").alias("score"))
    # equal reviews share a key and were summed together: divide by how many there are
    copies = rows.groupBy("_review").agg(F.count(F.lit(1)).alias("_copies"))
    scores = hits.join(copies, "_review").select("_review", F.expr("score div _copies").alias("score"))
    out = rows.join(scores, "_review", "left")
    out = out.withColumn("score", F.coalesce("score", F.lit(0).cast("bigint"))).drop("_review")
    return out.withColumn("raw_label", label_of("score")).withColumn("sentiment", value_map("raw_label", LABELS))


def pos_filter(words: DataFrame, pos_lexicon: DataFrame, tags: Sequence[str] = ("Noun", "Adjective", "Verb"),
               word_col: str = "word") -> DataFrame:
    """F16: keep words whose part of speech is in ``tags`` (semi join to a
    ``word, pos`` table; the tag list is the reference's)."""
    allowed = pos_lexicon.where(F.col("pos").isin(list(tags))).select(F.col("word").alias(word_col)).distinct()
    return words.join(allowed, word_col, "left_semi")


def tag_with_plugin(words: DataFrame, make_tagger: Callable[[], Callable[[pd.Series], pd.Series]],
                    word_col: str = "word") -> DataFrame:
    """U2 plug-in: part of speech per word from any batch tagger (e.g. a
    morphological analyser), built once per task and fed Arrow batches.
    The result feeds ``pos_filter`` through its ``word, pos`` columns."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields] + ["pos string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = make_tagger()
        for pdf in batches:
            pdf = pdf.copy()
            pdf["pos"] = tagger(pdf[word_col]).astype(str).values
            yield pdf

    return words.mapInPandas(run, schema)


def sentiment_words(scored: DataFrame, charset: str = "hangul+jamo",
                    stopwords: Sequence[str] = STOPWORDS_KO_LONG, pos_lexicon: DataFrame | None = None) -> DataFrame:
    """Per review, the count of each word, with film, platform, day and
    sentiment (the word-cloud feed). One row per review and word; reviews
    are told apart by ``review_key``'s columns, as one reviewer writes many.

    A review's words are counted inside its row, so that no table of all
    reviews' words is held or shuffled; equal reviews are counted first.
    """
    labels = ["movieNm", "platform", "date", "sentiment"]
    key = [*(["id"] if "id" in scored.columns else []), "context", *labels]
    reviews = scored.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"))
    cleaned = F.sort_array(split_words(clean_for_tokens("context", charset)))
    sized = reviews.select(*labels, "_copies", cleaned.alias("_words")).withColumn("_n", F.size("_words"))
    # a sorted word starts where it differs from the one before and ends where the next one starts
    starts = F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: (i == 0) | (F.get("_words", i) != F.get("_words", i - 1)))
    runs = sized.select(*labels, "_copies", "_words", "_n", starts.alias("_starts"))
    ends = F.concat(F.slice("_starts", 2, F.size("_starts")), F.array("_n"))
    pairs = F.zip_with("_starts", ends, lambda a, b: F.struct(F.get("_words", a).alias("word"), (b - a).alias("n")))
    w = F.col("word")
    words = runs.select(*labels, "_copies", F.explode(pairs).alias("_p")).select(
        *labels, F.col("_p.word").alias("word"), (F.col("_p.n") * F.col("_copies")).alias("count"))
    words = words.where((F.length(w) >= 2) & (~w.isin(list(stopwords)) if stopwords else F.lit(True)))
    return words if pos_lexicon is None else pos_filter(words, pos_lexicon).select(*words.columns)


def sentiment_top10(scored: DataFrame, n: int = 10, charset: str = "hangul+jamo",
                    stopwords: Sequence[str] = STOPWORDS_KO_LONG) -> DataFrame:
    """The ``n`` most frequent words per sentiment.

    The sum over reviews of per-review word counts (A20) is the word count
    per sentiment, so the tokens are aggregated straight to
    ``(sentiment, word)``: the partial aggregate leaves each map task with
    one row per word and sentiment instead of one per review and word.
    """
    words = tokens(scored, "context", charset, stopwords, 2, keep=["sentiment"])
    per = words.groupBy("sentiment", "word").agg(F.count(F.lit(1)).alias("count"))
    return top_n(per, ["sentiment"], [F.desc("count"), F.asc("word")], n, rank_col="rank").orderBy(
        "sentiment", "rank")


def sentiment_by_platform(scored: DataFrame) -> DataFrame:
    """Sentiment ratio per platform."""
    per = scored.groupBy("platform", "sentiment").agg(F.count(F.lit(1)).alias("count"))
    return share_of_group(per, ["platform"], "count", "ratio").orderBy("platform", "sentiment")


def sentiment_by_day(scored: DataFrame) -> DataFrame:
    """Reviews per day and sentiment."""
    return (
        scored.groupBy("date", "sentiment").agg(F.count(F.lit(1)).alias("count"))
        .orderBy("date", "sentiment")
    )


def sentiment_platform_counts(scored: DataFrame) -> DataFrame:
    """Reviews per platform, with positive and negative counts."""
    return (
        scored.groupBy("platform").agg(
            F.count(F.lit(1)).alias("review_count"),
            F.count_if(F.col("sentiment") == "positive").alias("positive_count"),
            F.count_if(F.col("sentiment") == "negative").alias("negative_count"),
        ).orderBy(F.desc("review_count"), "platform")
    )


# ---------------------------------------------------------------- U1(b)
def _with_tokens(df: DataFrame, text_col: str, charset: str) -> DataFrame:
    """The T-chain's words of a text as an array, so that the model reads the script that the rules read."""
    words = F.filter(split_words(clean_for_tokens(text_col, charset)), lambda w: F.length(w) > 0)
    return df.withColumn("_tokens", words)


def fit_naive_bayes(labelled: DataFrame, text_col: str = "context", label_col: str = "label",
                    charset: str = "hangul+jamo", scale: int = 1_000_000) -> DataFrame:
    """U1(b), exact form: multinomial naive Bayes as a lexicon table (word, weight).

    The weight of a word is the log ratio of its add-one smoothed shares of
    the positive and the negative words, in millionths: one count per word
    and label (pre-aggregated), two totals, no driver work. Score with
    ``score_lexicon_table``; sums of whole numbers do not depend on order.
    """
    words = _with_tokens(labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()), text_col, charset)
    counts = (words.select(F.explode("_tokens").alias("word"), (F.col(label_col) > 0).alias("_pos")).groupBy("word")
              .agg(F.count_if("_pos").alias("pos"), F.count_if(~F.col("_pos")).alias("neg")))
    # written once: the texts are counted once, and what reads the lexicon knows its size (a small one is broadcast to the texts' words)
    path = os.path.join(checkpoint_dir(labelled.sparkSession), f"lexicon-{uuid.uuid4().hex}")
    counts.write.parquet(path)
    counts = labelled.sparkSession.read.parquet(path)
    totals = counts.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("words"))).scalar()
    ratio = (F.log((F.col("pos") + 1) / (totals["pos"] + totals["words"]).cast("double"))
             - F.log((F.col("neg") + 1) / (totals["neg"] + totals["words"]).cast("double")))
    return counts.select("word", F.round(ratio * scale).cast("bigint").alias("weight"))


def fit_sentiment_model(labelled: DataFrame, text_col: str = "context", label_col: str = "label",
                        num_features: int = 1 << 18, max_iter: int = 20, charset: str = "hangul+jamo"):
    """Train T-chain words -> hashing TF -> IDF -> logistic regression."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF

    stages = [
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label_col, maxIter=max_iter,
                           predictionCol="_prediction", probabilityCol="_probability",
                           rawPredictionCol="_raw"),
    ]
    rows = labelled.select(text_col, F.col(label_col).cast("double").alias(label_col))
    # saved and loaded, the model leaves its training summary behind: that holds the session, which no task takes once an Observation ran in it
    path = os.path.join(checkpoint_dir(labelled.sparkSession), f"model-{uuid.uuid4().hex}")
    Pipeline(stages=stages).fit(_with_tokens(rows, text_col, charset)).save(path)
    return PipelineModel.load(path)


def score_model(df: DataFrame, model, charset: str = "hangul+jamo") -> DataFrame:
    """U1(b): label reviews with a pipeline fitted on the same ``charset``."""
    base = review_inputs(df)
    out = model.transform(_with_tokens(base, "context", charset))
    raw = F.when(F.col("_prediction") > 0.5, F.lit("LABEL_1")).otherwise(F.lit("LABEL_0"))
    return out.select(*base.columns, raw.alias("raw_label")).withColumn(
        "sentiment", value_map("raw_label", LABELS))


# ---------------------------------------------------------------- U1(c)
def score_with_plugin(df: DataFrame, make_scorer: Callable[[], Callable[[pd.Series], pd.Series]],
                      text_col: str = "context") -> DataFrame:
    """U1(c): label reviews with any batch scorer (e.g. a local transformer).

    ``make_scorer()`` runs once per task; the scorer maps a pandas Series of
    texts to a Series of raw labels (``LABEL_0`` / ``LABEL_1``).
    """
    base = review_inputs(df)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields]
                       + ["raw_label string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for pdf in batches:
            pdf = pdf.copy()
            pdf["raw_label"] = scorer(pdf[text_col]).astype(str).values
            yield pdf

    return base.mapInPandas(run, schema).withColumn("sentiment", value_map("raw_label", LABELS))


def pandas_lexicon_scorer(lexicon: Sequence[tuple] = LEXICON_LATIN, charset: str = "latin"):
    """A batch scorer for ``score_with_plugin`` with the lexicon rule, used to
    check the plug-in path against the native one. Python ``re`` reads the
    same ``\\uXXXX`` classes as Java."""
    import re

    from reviewlake.functions.text import CHARSETS, WS

    weights = {w: int(wt) for w, wt, *_ in lexicon}
    drop = re.compile(f"[^{CHARSETS[charset]} \\t\\n\\x0B\\f\\r\\u00a0\\u3000]")
    edge = re.compile(f"^{WS}+|{WS}+$")
    split = re.compile(f"{WS}+")

    def make():
        def one(t) -> str:
            s = edge.sub("", drop.sub("", t or "").lower())
            total = sum(weights.get(w, 0) for w in split.split(s))
            return "LABEL_1" if total > 0 else "LABEL_0"

        return lambda texts: texts.map(one)

    return make
