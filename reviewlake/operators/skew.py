"""Skew-safe building blocks shared by the operators.

A single film, platform or day may hold a third of all rows, so no
operator here sends a whole group to one task:

* ``keep_first`` deduplicates with an aggregate (``min`` of a struct),
  which Spark computes partially on the map side: a hot key leaves each
  map task as one row.
* ``top_n`` uses ``row_number() <= n``; Spark plans it with a partial
  ``WindowGroupLimit`` before the shuffle, so at most ``n`` rows per group
  and map task cross the network.
* ``share_of_group`` divides by a group total computed with a partial
  aggregate and joined back; the planner broadcasts the totals only when
  their measured size is under the broadcast threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_digest(keys: Sequence[str]) -> Column:
    """SHA-256 of the key columns; nulls compare equal, and no two different keys are spelled alike."""
    spelled = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.unhex(F.sha2(F.concat_ws(",", *spelled), 256))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
               digest: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the smallest by ``order``, then by every other column.

    Ascending, nulls first, like ``row_number() over (partition by keys
    order by ... nulls first) = 1`` but as a map-side-combined aggregate.
    Key columns named in ``digest`` (long texts) are grouped by their SHA-256
    instead, on the assumption that different texts differ in it; the text
    itself then travels once, with the chosen row, and nulls stay one group.
    """
    keys = list(keys)
    if digest:
        narrow = {c: f"_sha_{c}" for c in digest}
        hashed = df.withColumns({h: F.unhex(F.sha2(F.col(c), 256)) for c, h in narrow.items()})
        return keep_first(hashed, [narrow.get(k, k) for k in keys], order).select(*df.columns)
    rest = [c for c in df.columns if c not in keys]
    ordered = list(order) + [c for c in rest if c not in order]
    packed = F.min(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ordered)])).alias("_best")
    out = df.groupBy(*keys).agg(packed)
    return out.select(
        *[F.col(c) for c in keys],
        *[F.col(f"_best._{ordered.index(c)}").alias(c) for c in rest],
    ).select(*df.columns)


def top_n(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str | None = None) -> DataFrame:
    """Rows ranked ``1..n`` within each group; ``order`` must be a total order."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def share_of_group(df: DataFrame, group_cols: Sequence[str], value_col: str,
                   share_col: str = "share", digits: int | None = 6) -> DataFrame:
    """``value / sum(value) over group`` via aggregate + join.

    The join is null-safe, so a null group (e.g. an unreadable day) keeps
    its rows, as ``partition by`` does.
    """
    group_cols = list(group_cols)
    keys = [f"_g{i}" for i in range(len(group_cols))]
    totals = df.groupBy(*group_cols).agg(F.sum(value_col).alias("_total")).toDF(*keys, "_total")
    cond = [df[c].eqNullSafe(totals[k]) for c, k in zip(group_cols, keys)]
    share = F.col(value_col).cast("double") / F.col("_total").cast("double")
    if digits is not None:
        share = F.round(share, digits)
    return df.join(totals, cond, "inner").withColumn(share_col, share).drop("_total", *keys)


def share_of_total(df: DataFrame, value_col: str, share_col: str = "share", digits: int | None = 6) -> DataFrame:
    """``value / sum(value)`` over the whole table.

    The total is a scalar subquery (a global aggregate: one partial row
    per map task, then one row), read by the projection: no join, and the
    table itself is never moved to a single partition. Spark reuses the
    input's exchange for the subquery.
    """
    total = df.agg(F.sum(value_col)).scalar()
    share = F.col(value_col).cast("double") / total.cast("double")
    if digits is not None:
        share = F.round(share, digits)
    return df.withColumn(share_col, share)


def running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df`` with ``<value>_before`` per value: its sum over all rows earlier by ``order`` (a unique key), over the whole table.

    A window without partition keys would bring every row to one task. Here
    the rows are cut into ranges by ``order`` and written once to the
    checkpoint folder; each range is summed on its own and starts from the
    totals of the ranges before it (one row a range).
    """
    from reviewlake.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    sums = rows.groupBy("_range").agg(*[F.sum(v).alias(v) for v in values])
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", *[F.coalesce(F.sum(v).over(ahead), F.lit(0)).alias(f"_{v}_start") for v in values])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumns({f"_{v}_in": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}).join(starts, "_range")
    return summed.select(*df.columns, *[(F.col(f"_{v}_start") + F.col(f"_{v}_in")).alias(f"{v}_before") for v in values])
