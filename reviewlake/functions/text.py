"""Text column expressions: whitespace, charsets, tokens.

Java's ``\\s`` is ASCII-only, while the reference's pandas strip and split
treat U+00A0 and U+3000 as spaces, so every whitespace rule here uses the
explicit class below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace class used by strip and split (Java regex syntax), and the
# same characters as a plain string for ``trim``.
WS = "[ \\t\\n\\x0B\\f\\r\\u00a0\\u3000]"
WS_CHARS = " \t\n\x0b\f\r\u00a0\u3000"

# Character classes kept by the keyword cleaner.
# hangul+jamo is the batch rule, hangul the daily rule;
# latin stands in for the driver's invented European prose.
CHARSETS = {
    "hangul+jamo": "\\u3131-\\u314e\\uac00-\\ud7a3",
    "hangul": "\\uac00-\\ud7a3",
    "latin": "A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f",
}

# Stop words. The first two lists are the reference's own
# (short list for movie keywords, long list for sentiment words).
STOPWORDS_KO = ["영화", "정말", "너무", "근데", "그리고"]
STOPWORDS_KO_LONG = ["영화", "정말", "너무", "그리고", "근데", "그냥", "봤어요", "있어요", "합니다", "한다", "때문"]
# Ours, for the latin charset.
STOPWORDS_LATIN = ["the", "and", "of", "to", "in", "is", "de", "la", "le", "et", "en", "el", "der", "und", "die"]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip leading and trailing whitespace (pandas ``str.strip`` rule).

    ``trim`` with a character set looks at the two ends only; a regex
    would scan the whole text.
    """
    return F.trim(col_(c), F.lit(WS_CHARS))


def is_present(c) -> Column:
    """not null and not blank after stripping."""
    c = col_(c)
    return c.isNotNull() & (F.length(strip_ws(c)) > 0)


def min_length(c, n: int = 10) -> Column:
    """stripped length at least ``n``."""
    return F.length(strip_ws(c)) >= n


def has_reviewer(c) -> Column:
    """the row names its reviewer (id or name not blank)."""
    c = col_(c)
    return c.isNotNull() & (F.length(strip_ws(c)) > 0)


def keep_charset(c, charset: str = "hangul+jamo") -> Column:
    """C8 (replaces the U5 regex lambda): remove every character outside
    ``charset`` and whitespace.

    Java evaluates a negated class built from many ranges an order of
    magnitude slower per character than a single-property class, so the
    set is removed in fast passes that keep exactly the same characters:
    first everything that is neither a letter nor whitespace, then the
    letter ranges outside the set (``FAST_PASSES``; for latin also the
    three letters below U+0250 that are not in it: ª, µ, º).
    """
    c = col_(c)
    if charset not in FAST_PASSES:
        return keep_charset_single(c, charset)
    out = F.regexp_replace(c, "[^\\p{L}\\s\\u00a0\\u3000]+", "")  # letters and whitespace remain
    for pattern in FAST_PASSES[charset]:
        out = F.regexp_replace(out, pattern, "")
    if charset == "latin":
        out = F.translate(out, "\u00aa\u00b5\u00ba", "")
    return out


# After the first pass only letters and whitespace remain; these passes
# remove the letters outside each set. Each class is at most two ranges,
# the form Java evaluates fast; the whitespace kept (tab to CR, space,
# U+00A0, U+3000) lies outside every range.
FAST_PASSES = {
    "latin": ["[^\\x{0}-\\x{24f}\\u3000]+"],
    "hangul+jamo": ["[\\x{21}-\\x{9f}\\x{a1}-\\x{2fff}]+", "[\\x{3001}-\\x{3130}\\x{314f}-\\x{abff}]+",
                    "[\\x{d7a4}-\\x{10ffff}]+"],
    "hangul": ["[\\x{21}-\\x{9f}\\x{a1}-\\x{2fff}]+", "[\\x{3001}-\\x{abff}]+", "[\\x{d7a4}-\\x{10ffff}]+"],
}


def keep_charset_single(c, charset: str) -> Column:
    """C8 as one negated class (the reference's form; slower in Java)."""
    cls = CHARSETS[charset]
    return F.regexp_replace(col_(c), f"[^{cls} \\t\\n\\x0B\\f\\r\\u00a0\\u3000]", "")


def word_pattern(charset: str, min_len: int = 2) -> str:
    """a whole word of at least ``min_len`` characters of ``charset``."""
    return f"^[{CHARSETS[charset]}]{{{min_len},}}$"


def split_words(c) -> Column:
    """Split on runs of whitespace."""
    return F.split(col_(c), f"{WS}+")


def clean_for_tokens(c, charset: str = "hangul+jamo") -> Column:
    """The first half of the T-chain: charset filter, lower, strip."""
    return strip_ws(F.lower(keep_charset(blank_if_null(c), charset)))


def text_prefix(c, n: int = 200) -> Column:
    """First ``n`` characters (model input limit in the reference)."""
    return F.substring(col_(c), 1, n)


def blank_if_null(c) -> Column:
    """C17."""
    return F.coalesce(col_(c), F.lit(""))
