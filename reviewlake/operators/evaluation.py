"""How good a scorer is: exact ranks, AUC and calibration as one table (U1 b).

AUC needs the rank of every score. Equal scores are counted together first, then running totals over the sorted
scores are taken range by range (``skew.running_totals``); nothing is sorted in one task and nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.operators.skew import running_totals

BINS = 10


def evaluate_scores(scored: DataFrame, score_col: str = "score", label_col: str = "label", threshold: float = 0, by: Sequence[str] = ()) -> DataFrame:
    """(by..., metric, bin, n, value) of ``scored``; rows without score or label do not count. A label above 0 is positive.

    metric ``auc``: chance that a positive row scores above a negative one, ties half (null without either kind); ``accuracy``,
    ``precision`` and ``recall`` of "score above ``threshold``"; and per tenth of the rows by rank ``bin_positive``, the share of
    positive rows (n: rows of the bin). Rows of equal score share a bin, so bins may differ in size or be missing.
    """
    by = list(by)
    rows = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
    per = rows.groupBy(*by, F.col(score_col).alias("s")).agg(F.count_if(F.col(label_col) > 0).alias("pos"), F.count_if(~(F.col(label_col) > 0)).alias("neg"))
    ranked = running_totals(per, [*by, "s"], ["pos", "neg"])
    # totals run over all groups; a group starts where its first score stands
    starts = ranked.groupBy(*by).agg(F.min("pos_before").alias("p0"), F.min("neg_before").alias("n0"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, "_all"]]  # without groups one row of totals meets all
    joined = ranked.withColumn("_all", F.lit(1)).alias("a").join(starts.withColumn("_all", F.lit(1)).alias("b"), on)
    joined = joined.select(*[F.col(f"a.{c}") for c in by], "s", "pos", "neg", (F.col("pos_before") - F.col("p0")).alias("pb"),
                           (F.col("neg_before") - F.col("n0")).alias("nb"), "P", "N")
    wide = lambda c: c.cast("decimal(38, 0)")
    above = F.col("s") > threshold
    yes = lambda c: F.sum(F.when(above, F.col(c)).otherwise(0))
    share = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    sums = joined.groupBy(*by).agg(
        F.sum(wide(F.col("pos")) * (F.col("nb") * 2 + F.col("neg"))).alias("u"), F.max("P").alias("P"), F.max("N").alias("N"), yes("pos").alias("tp"), yes("neg").alias("fp"))
    n = F.col("P") + F.col("N")
    metrics = {"auc": share(F.col("u"), wide(F.col("P")) * F.col("N") * 2), "accuracy": share(F.col("tp") + F.col("N") - F.col("fp"), n),
               "precision": share(F.col("tp"), F.col("tp") + F.col("fp")), "recall": share(F.col("tp"), F.col("P"))}
    whole = sums.select(*by, n.alias("n"), F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.round(v, 9).alias("value")) for m, v in metrics.items()])).alias("m"))
    whole = whole.select(*by, "m.metric", F.lit(None).cast("int").alias("bin"), "n", "m.value")
    bin_of = F.floor((F.col("pb") + F.col("nb")) * BINS / n).cast("int")
    bins = joined.groupBy(*by, bin_of.alias("bin")).agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("p")).select(
        *by, F.lit("bin_positive").alias("metric"), "bin", "n", F.round(share(F.col("p"), F.col("n")), 9).alias("value"))
    return whole.unionByName(bins)
