"""The fast multi-pass charset filter keeps exactly what the single negated
class keeps, for every charset, on random text over the relevant ranges."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reviewlake.functions import text

INTERESTING = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x21, 0x41, 0x5A, 0x61, 0x7A, 0xA0, 0xAA, 0xB5, 0xBA, 0xC0,
               0xD6, 0xD7, 0xD8, 0xF6, 0xF7, 0xF8, 0x24F, 0x250, 0x3000, 0x3001, 0x3130, 0x3131, 0x314B, 0x314E,
               0x314F, 0x3160, 0x3163, 0xABFF, 0xAC00, 0xD7A3, 0xD7A4, 0x4E00, 0x1F600, 0x2028, 0x85, 0x1100]
CHARS = st.one_of(st.sampled_from([chr(c) for c in INTERESTING]), st.characters(blacklist_categories=("Cs",)))
TEXTS = st.lists(st.text(alphabet=CHARS, max_size=40), min_size=1, max_size=25)


@pytest.mark.parametrize("charset", sorted(text.CHARSETS))
@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=TEXTS)
def test_fast_equals_single(spark, charset, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select(text.keep_charset("x", charset).alias("a"), text.keep_charset_single("x", charset).alias("b"))
    assert all(r.a == r.b for r in rows.collect())
