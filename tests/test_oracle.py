"""Every registered query against its DuckDB oracle at sf0.01:
same columns, same row count, same rows (order-free; doubles to 9 digits)."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from reviewlake.plans.landing_oracle import ORACLE as LANDING_ORACLE
from reviewlake.plans.oracle import ORACLE as PLAIN_ORACLE
from reviewlake.plans.queries import QUERIES
from tests.conftest import SF001, SF01

ORACLE = {**PLAIN_ORACLE, **LANDING_ORACLE}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())


def test_every_query_but_the_trained_model_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == {"sentiment_ml"}
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["movieNm", "rating_count", "avg_rating", "stddev_rating"]
    assert len(rows) > 0


def test_sentiment_ml_labels_every_review(spark):
    out = E.queries()["sentiment_ml"](spark, SF001)
    n = out.count()
    assert n == E.queries()["sentiment_lexicon"](spark, SF001).count()
    assert {r.sentiment for r in out.select("sentiment").distinct().collect()} <= {"positive", "negative"}
