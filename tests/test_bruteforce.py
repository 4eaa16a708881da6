"""Operators against plain-Python brute force on random small inputs with a
hot key (one key holding a large share of the rows)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlake.operators.skew import keep_first, share_of_group, top_n

KEYS = st.sampled_from(["hot", "hot", "hot", "a", "b", "c"])
ROWS = st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["x", "y", "z", None])),
                min_size=1, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _nulls_first(v):
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(rows=ROWS)
def test_keep_first_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(3)
    got = sorted(tuple(r) for r in keep_first(df, ["k"], ["o"]).collect())
    best = {}
    for k, o, v in rows:
        cand = (_nulls_first(o), (v is not None, v or ""))
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, o, v))
    assert got == sorted(b[1] for b in best.values())


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, st.integers(0, 100), st.integers(0, 10_000)), min_size=1, max_size=40,
                     unique_by=lambda t: t[2]))
def test_top_n_equals_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, score int, item int").repartition(3)
    got = sorted(tuple(r) for r in top_n(df, ["g"], [F.desc("score"), F.asc("item")], 2).collect())
    want = []
    for g in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want.extend(grp[:2])
    assert got == sorted(want)


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, st.integers(1, 50)), min_size=1, max_size=30))
def test_share_equals_brute_force(spark, rows):
    df = spark.createDataFrame([(g, i, v) for i, (g, v) in enumerate(rows)], "g string, i int, v long")
    got = {r.i: r.share for r in share_of_group(df, ["g"], "v").collect()}
    tot = {}
    for g, v in rows:
        tot[g] = tot.get(g, 0) + v
    assert got == {i: round(v / tot[g], 6) for i, (g, v) in enumerate(rows)}
