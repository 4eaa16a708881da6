"""Search-result matching.

For each film the crawler took the search hit with the same title and
opening year, else the first hit that shows an image. Here both rules are
one priority in an aggregate over the landed hits: ``min`` of
``(priority, position)`` per film, combined map-side, so a film with
millions of hits never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def candidate_match(movies: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per film in ``movies`` (movieNm, open_year) with the chosen hit.

    ``hits``: movieNm (the search), hit_id, title, open_year, position,
    has_image. ``match`` is ``exact``, ``image`` or null (no usable hit).
    """
    h = hits.join(movies.select("movieNm", F.col("open_year").alias("_want")), "movieNm", "inner")
    prio = (F.when((F.col("title") == F.col("movieNm")) & (F.col("open_year") == F.col("_want")), F.lit(0))
            .when(F.col("has_image"), F.lit(1)))
    best = (
        h.withColumn("_prio", prio).where(F.col("_prio").isNotNull())
        .groupBy("movieNm")
        .agg(F.min(F.struct("_prio", "position", "hit_id")).alias("_b"))
        .select("movieNm",
                F.col("_b.hit_id").alias("hit_id"),
                F.col("_b.position").alias("position"),
                F.when(F.col("_b._prio") == 0, F.lit("exact")).otherwise(F.lit("image")).alias("match"))
    )
    return movies.select("movieNm", "open_year").join(best, "movieNm", "left")
