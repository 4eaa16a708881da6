"""Recommend-tag expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlake.functions.text import col_, strip_ws

# Tag markers the site shows for collapsed tag lists
# ("+2" = two more, "연출 외" = "directing and others"); such tags are dropped.
TAG_MORE = "+"
TAG_OTHERS = "외"


def parse_tags(c) -> Column:
    """C9 (replaces the U3 list-literal parse): JSON or Python list literal
    text to ``array<string>``.

    ``from_json`` accepts the single-quoted form; broken text gives null.
    """
    return F.from_json(col_(c), "array<string>")



def clean_tags(arr) -> Column:
    """strip, then drop blank tags and tags holding ``+`` or ``외``."""
    stripped = F.transform(col_(arr), lambda t: strip_ws(t))
    return F.filter(
        stripped,
        lambda t: t.isNotNull() & (F.length(t) > 0)
        & ~t.contains(TAG_MORE) & ~t.contains(TAG_OTHERS),
    )


def tags_literal(arr) -> Column:
    """Array to the Python-list text the landed files hold: ``['a', 'b']``."""
    quoted = F.transform(col_(arr), lambda t: F.concat(F.lit("'"), t, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
