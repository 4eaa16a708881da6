"""Stems of agglutinated words without a word list.

Korean words carry particles and endings, so one noun is counted under many spellings. Where a stem ends, the next
syllable is hard to guess: after it almost any ending may follow, inside it almost always the same one. The words' own
prefix counts (a trie, kept as a table) say how hard: the branching entropy of a prefix, weighted by how firmly its syllables
hold together. Each word is cut behind the prefix with the best product of the two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.text import STOPWORDS_KO
from reviewlake.operators.keywords import tokens
from reviewlake.session import checkpoint_dir

#: Stems have two syllables at least and this many at most; the rest of a word is its ending, however long.
MIN_STEM, MAX_STEM = 2, 10


def prefix_statistics(words: DataFrame) -> DataFrame:
    """(prefix, count, entropy) of every prefix of 1 to ``MAX_STEM`` syllables of ``words`` (word, n).

    ``count`` sums n over the words that begin with the prefix; ``entropy`` (bits, six digits) is that of the syllable behind it, the
    end of a word being one of the choices. Counts are summed before the shuffle, so a frequent first syllable is no hot group.
    """
    size = F.length("word")
    steps = words.where(size > 0).select("n", "word", F.explode(F.sequence(F.lit(1), F.least(size, F.lit(MAX_STEM)))).alias("k"))
    nexts = steps.select(F.expr("substring(word, 1, k)").alias("prefix"), F.expr("substring(word, k + 1, 1)").alias("next"), "n").groupBy("prefix", "next").agg(
        F.sum("n").alias("n"))
    total = F.sum("n").alias("count")
    surprise = F.sum(F.col("n") * F.log2(F.col("n").cast("double"))).alias("s")
    return nexts.groupBy("prefix").agg(total, surprise).select("prefix", "count", F.round(
        F.log2(F.col("count").cast("double")) - F.col("s") / F.col("count"), 6).alias("entropy"))


def split_stems(words: DataFrame) -> DataFrame:
    """(word, n, stem, ending): each word of ``words`` (word, n; a word once) cut behind its best prefix.

    A prefix of k syllables scores entropy times cohesion, cohesion being the mean chance (k-1st root) with which its first syllable
    continues to it. Of equal scores the shortest prefix wins; words shorter than ``MIN_STEM`` and words without any
    branching stay whole.
    """
    stats = prefix_statistics(words)
    size = F.least(F.length("word"), F.lit(MAX_STEM))
    cuts = words.where(F.length("word") >= MIN_STEM).select("word", F.explode(F.sequence(F.lit(MIN_STEM), size)).alias("k"))
    cuts = cuts.select("word", "k", F.expr("substring(word, 1, k)").alias("prefix"), F.expr("substring(word, 1, 1)").alias("first"))
    heads = stats.where(F.length("prefix") == 1).select(F.col("prefix").alias("first"), F.col("count").alias("first_count"))
    cohesion = F.pow(F.col("count") / F.col("first_count"), F.lit(1.0) / (F.col("k") - 1))
    scored = cuts.join(stats, "prefix").join(heads, "first").select("word", "k", F.round(F.col("entropy") * cohesion, 6).alias("score"))
    best = scored.groupBy("word").agg(F.max(F.struct("score", (-F.col("k")).alias("nk"))).alias("b"))
    k = F.when(F.coalesce(F.col("b.score"), F.lit(0.0)) > 0, -F.col("b.nk")).otherwise(F.length("word"))
    cut = words.join(best, "word", "left").withColumn("k", k)
    return cut.select("word", "n", F.expr("substring(word, 1, k)").alias("stem"), F.expr("substring(word, k + 1, length(word))").alias("ending"))


def _kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stem_keywords(df: DataFrame, charset: str = "hangul", stopwords: Sequence[str] = STOPWORDS_KO) -> DataFrame:
    """A5 over stems: (movieNm, keyword, count, spellings), ``spellings`` being the number of different words that share the stem in the film."""
    # counted once and kept: each later step reads other columns of it, so that Spark would go through the texts again for each
    counts = _kept(tokens(df, charset=charset, stopwords=stopwords).groupBy("movieNm", "word").agg(F.count(F.lit(1)).alias("count")))
    stems = split_stems(_kept(counts.groupBy("word").agg(F.sum("count").alias("n")))).select("word", "stem")
    return counts.join(stems, "word").groupBy("movieNm", F.col("stem").alias("keyword")).agg(
        F.sum("count").alias("count"), F.count(F.lit(1)).alias("spellings"))


def stem_lexicon(words: DataFrame, pos: str = "Noun") -> DataFrame:
    """(word, pos) for ``sentiment.pos_filter``: the spellings that were cut, under one part of speech. Stems that take several endings are what a
    tagger would call nouns and verb stems; words that never vary are left out."""
    return split_stems(words).where(F.length("ending") > 0).select("word", F.lit(pos).alias("pos"))
