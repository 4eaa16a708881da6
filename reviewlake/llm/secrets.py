"""Secret scan: fixed patterns, and a battery of randomness tests on long tokens. Spark functions only.

The smallest encoding that holds all characters of a token is inferred (digits, hex, letters, base 36, 62, 64)
and its symbols are tested against uniform draws: chi-squared of the symbol counts, runs above and below the
middle, and lag-one serial correlation. The squared z values add up to a distance from randomness; a token
further off than uniform draws come (``FARTHEST``) is no secret. Words are the null population: their law is a
chain of letters, case, digits and separators, whose letter pairs are fixed values refined by all the
words of the documents. The chance of a token under that law, divided by its chance under uniform draws of
its encoding, is a p value of "this is a word" (by Markov's inequality, for any number of words, also none),
and Benjamini-Hochberg keeps the expected share of words among the reported tokens below ``FDR``. Tokens of
letters only are tested like all others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import column, fresh

#: Patterns of the fixed kinds, in reporting order, and what a match must fulfil (fixed values).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
ASSIGN_MIN_VALUE = 6
#: Characters of a token, and the least length that is tested.
TOKEN_CHARS = "A-Za-z0-9+/_=-"
MIN_TOKEN = 20
#: Expected share of words among the tokens reported by the tests.
FDR = 0.01
#: Greatest distance of a random token: three squared z values exceed it once in a thousand (chi-squared law).
FARTHEST = 16.27
#: p values are counted by powers of two, up to so many.
P_BINS = 1024
#: Weight of the fixed letter pairs: so many seen pairs a letter, and this share however many are seen.
PAIR_PRIOR, PAIR_SHARE = 50.0, 0.1
_BLOCK = 256

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Encodings from small to large: symbols, and the pattern of the tokens they hold.
ENCODINGS = [
    (_DIGITS, "^[0-9]*$"), (_DIGITS + "abcdef", "^[0-9a-f]*$"), (_DIGITS + "ABCDEF", "^[0-9A-F]*$"),
    (_LOWER, "^[a-z]*$"), (_UPPER, "^[A-Z]*$"), (_DIGITS + _LOWER, "^[0-9a-z]*$"), (_DIGITS + _UPPER, "^[0-9A-Z]*$"),
    (_UPPER + _LOWER, "^[A-Za-z]*$"), (_UPPER + _LOWER + _DIGITS, "^[A-Za-z0-9]*$"), (_UPPER + _LOWER + _DIGITS + "+/-_", "^.*$"),
]

#: Symbols of the words' law; the place behind the last one is the start of a token.
SYMBOLS = _LOWER + _UPPER + _DIGITS + "+/-_="
#: Letters in per cent of text, frequent pairs, and the class of a symbol (lower, upper, digit, separator) after that of another.
_LETTERS = dict(zip("etaoinshrdlcumwfgypbvkjxqz", [12, 9, 8, 7.5, 7, 6.7, 6.3, 5.5, 6, 4.3, 4, 2.8, 2.8, 2.4, 2, 2, 2, 1.8, 1.9, 1.5, 1, 0.9, 0.3, 0.3, 0.2, 0.4], strict=True))
_PAIRS = set("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur".split())
_CLASSES = {"": (0.6, 0.3, 0.05, 0.05), "l": (0.9, 0.04, 0.02, 0.04), "u": (0.33, 0.6, 0.02, 0.05), "d": (0.07, 0.05, 0.8, 0.08), "s": (0.5, 0.2, 0.2, 0.1)}


def _letter_pairs(seen: dict[str, float]) -> dict[str, dict[str, float]]:
    """Chance of a letter after another (after "" at a start): the fixed pairs, refined by the ``seen`` ones."""
    law = {}
    for a in ["", *_LOWER]:
        fixed = {b: f * (3 if a + b in _PAIRS else 1) * (1 if not a else (2 if a not in "aeiouy" else 0.8) if b in "aeiouy" else 0.7 if a not in "aeiouy" else 1.3)
                 for b, f in _LETTERS.items()}
        whole, n = sum(fixed.values()), sum(seen.get(a + b if a else "^" + b, 0.0) for b in _LOWER)
        law[a] = {b: PAIR_SHARE * fixed[b] / whole + (1 - PAIR_SHARE) * (seen.get((a or "^") + b, 0.0) + PAIR_PRIOR * fixed[b] / whole) / (n + PAIR_PRIOR)
                  for b in _LOWER}
    return law


def _word_law(seen: dict[str, float]) -> list[float]:
    """log2 chance of each symbol after each symbol (or at the start of a token), row by row."""
    pairs = _letter_pairs(seen)
    kind = lambda c: "" if not c else "l" if c in _LOWER else "u" if c in _UPPER else "d" if c in _DIGITS else "s"
    out = []
    for a in [*SYMBOLS, ""]:
        for b in SYMBOLS:
            ka, kb = kind(a), kind(b)
            chance = _CLASSES[ka]["luds".index(kb)]
            if kb in "lu":  # a capital after a small letter starts a word
                chance *= pairs[a.lower() if ka in ("l", "u") and (ka, kb) != ("l", "u") else ""][b.lower()]
            elif kb == "d" and ka == "d":  # numbers hold zeros, repeats and counts
                chance *= 0.035 + 0.3 * (b == "0") + 0.2 * (a == b) + 0.15 * ((int(a) + 1) % 10 == int(b))
            elif kb == "d":
                chance *= 0.05 + (0.25 if b in "12" else 0.0)
            else:
                chance *= 0.5 * (a == b) + 0.1 if ka == "s" else 0.2
            out.append(math.log2(chance))
    return out


def word_law(docs: DataFrame, text_col: str = "text") -> list[float]:
    """The words' law (see ``_word_law``) refined by the letter pairs of all words of all texts.

    What leaves Spark is a count for each pair of letters, 27 x 26 at most.
    """
    rows = docs.select(column(text_col).cast("string").alias("t")).where("t is not null")
    found = F.regexp_extract_all("t", F.lit(f"(?<![{TOKEN_CHARS}])[A-Za-z]{{2,}}+(?![{TOKEN_CHARS}])"), 0)
    words = rows.select(F.explode(found).alias("w")).groupBy(F.lower("w").alias("w")).agg(F.count("*").alias("n"))
    letters = words.select("n", F.filter(F.split("w", ""), lambda c: c != "").alias("c"))  # an array: a word of any length costs no square
    before = F.concat(F.array(F.lit("^")), F.slice("c", 1, F.size("c") - 1))
    pairs = letters.select("n", F.explode(F.zip_with(before, "c", lambda a, b: F.concat(a, b))).alias("pair"))
    return _word_law({r["pair"]: float(r["n"]) for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect()})


def _starts(lengths: Column) -> Column:
    """Start of each match from its (gap before, length); in blocks, so that many matches cost no square."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x["g"] + x["m"]))
    offsets = F.aggregate(sums, F.struct(F.lit(0).alias("p"), F.expr("cast(array() as array<int>)").alias("o")),
                          lambda a, s: F.struct((a["p"] + s).alias("p"), F.concat(a["o"], F.array(a["p"])).alias("o")))["o"]
    within = F.zip_with(blocks, offsets, lambda b, o: F.aggregate(
        b, F.struct(o.alias("p"), F.expr("cast(array() as array<int>)").alias("s")),
        lambda a, x: F.struct((a["p"] + x["g"] + x["m"]).alias("p"), F.concat(a["s"], F.array(a["p"] + x["g"])).alias("s")))["s"])
    return F.flatten(within)


def _with_matches(df: DataFrame, text: str, pattern: str, out: str, when: Column | None = None) -> DataFrame:
    """Adds ``out``: array of (start, end, token) of all matches, leftmost and not overlapping."""
    none = F.expr("cast(array() as array<string>)")
    found = F.regexp_extract_all(column(text), F.lit(pattern), 0)
    df = df.withColumn(out, found if when is None else F.when(when, found).otherwise(none))
    gaps = F.split(column(text), pattern, -1)
    lengths = F.zip_with(F.slice(gaps, 1, F.size(out)), F.col(out), lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    spans = F.zip_with(_starts(lengths), F.col(out), lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("token")))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,token:string>>)")
    return df.withColumn(out, F.when(F.size(out) > 0, spans).otherwise(empty))


def _with_tokens(df: DataFrame, text: str, out: str) -> DataFrame:
    return _with_matches(df, text, f"(?<![{TOKEN_CHARS}])[{TOKEN_CHARS}]{{{MIN_TOKEN},}}+", out)


def _holds(core: Column) -> Column:
    """For each of ENCODINGS whether it holds all characters."""
    return F.array(*[core.rlike(pattern) for _, pattern in ENCODINGS])


def _encoded(tokens: Column) -> Column:
    """Tokens as (start, end, core, enc): padding off, the smallest encoding."""
    x = F.transform(tokens, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.rtrim(t["token"], F.lit("=")).alias("core")))
    return F.transform(x, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), t["core"].alias("core"),
        (F.array_position(_holds(t["core"]), F.lit(True)) - 1).cast("int").alias("enc")))


def _tested(encoded: Column, law: list[float]) -> Column:
    """(start, end, grade) of each token: -log2 of its p value as a word, 0 if it is no uniform draw of its encoding."""
    alphabets = F.array(*[F.lit(a) for a, _ in ENCODINGS])
    kept = ("start", "end")
    table, size = F.split(F.lit(",".join(map(repr, law))), ",").cast("array<double>"), len(SYMBOLS)  # a constant
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    x = F.transform(encoded, lambda t: F.struct(
        *[t[c].alias(c) for c in (*kept, "core")], F.get(alphabets, t["enc"]).alias("abc"),
        F.transform(F.split(t["core"], "(?!^)", -1), lambda c: F.instr(F.lit(SYMBOLS), c) - 1).alias("at")))
    chain = lambda at: F.zip_with(F.concat(F.array(F.lit(size)), F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0)))), at,
                                  lambda a, b: F.get(table, a * size + b))
    x = F.transform(x, lambda t: F.struct(
        *[t[c].alias(c) for c in kept], F.length(t["abc"]).cast("double").alias("k"),
        (-total(chain(t["at"])) - F.size(t["at"]) * F.log2(F.length(t["abc"])) - math.log2(len(ENCODINGS))).alias("grade"),
        F.transform(F.split(t["core"], "(?!^)", -1), lambda c: (F.instr(t["abc"], c) - 1).cast("double")).alias("v")))
    x = F.transform(x, lambda t: F.struct(*[t[c].alias(c) for c in (*kept, "grade", "k", "v")], F.size(t["v"]).cast("double").alias("n")))
    x = F.transform(x, lambda t: F.struct(
        *[t[c].alias(c) for c in (*kept, "grade", "k", "n", "v")],
        total(F.transform(F.array_distinct(t["v"]), lambda s: F.pow(F.size(F.filter(t["v"], lambda y: y == s)).cast("double"), F.lit(2.0)))).alias("squares"),
        F.size(F.filter(t["v"], lambda y: y * 2 >= t["k"])).cast("double").alias("high"),
        (total(t["v"]) / F.greatest(t["n"], F.lit(1.0))).alias("mean"),
        F.slice(t["v"], 1, F.greatest(F.size(t["v"]) - 1, F.lit(0))).alias("a"),
        F.slice(t["v"], 2, F.greatest(F.size(t["v"]) - 1, F.lit(0))).alias("b")))
    x = F.transform(x, lambda t: F.struct(
        *[t[c].alias(c) for c in (*kept, "grade", "k", "n", "squares", "high")],
        (1.0 + total(F.zip_with(t["a"], t["b"], lambda p, q: ((p * 2 >= t["k"]) != (q * 2 >= t["k"])).cast("double")))).alias("runs"),
        total(F.transform(t["v"], lambda p: (p - t["mean"]) * (p - t["mean"]))).alias("spread"),
        total(F.zip_with(t["a"], t["b"], lambda p, q: (p - t["mean"]) * (q - t["mean"]))).alias("serial")))

    def distance(t: Column) -> Column:
        n, k, h = t["n"], t["k"], t["high"]
        chi = (t["squares"] * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        pairs = 2 * h * (n - h)
        spread = pairs * (pairs - n) / (n * n * (n - 1))
        runs = F.when(spread > 0, (t["runs"] - 1 - pairs / n) / F.sqrt(spread)).otherwise(F.sqrt(n))  # all on one side
        corr = F.when(t["spread"] > 0, (t["serial"] / t["spread"] + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
        up = F.greatest(chi, F.lit(0.0))
        return up * up + runs * runs + corr * corr

    return F.transform(x, lambda t: F.struct(
        *[t[c].alias(c) for c in kept], F.when((t["n"] > 2) & (distance(t) <= FARTHEST), F.greatest(t["grade"], F.lit(0.0))).otherwise(F.lit(0.0)).alias("grade")))


def _p_bin(grade: Column) -> Column:
    return F.least(F.floor(grade), F.lit(P_BINS)).cast("int")


def randomness_limit(docs: DataFrame, law: list[float], text_col: str = "text", fdr: float = FDR) -> int:
    """The least -log2 p that is reported, from the tokens of all documents (Benjamini-Hochberg step-up).

    What leaves Spark is a histogram of at most ``P_BINS`` + 1 bins.
    """
    rows = _with_tokens(docs.select(column(text_col).cast("string").alias("t")).where("t is not null"), "t", "k")
    rows = rows.where(F.size("k") > 0).select(_encoded(F.col("k")).alias("k"))
    counts = rows.select(F.explode(_tested(F.col("k"), law)).alias("x")).groupBy(_p_bin(F.col("x.grade")).alias("g")).agg(F.count("*").alias("n")).collect()
    m, seen, limit = sum(r["n"] for r in counts), 0, P_BINS + 1
    for r in sorted(counts, key=lambda r: -r["g"]):
        seen += r["n"]
        if math.log2(fdr * seen / m) >= -r["g"]:
            limit = math.ceil(-math.log2(fdr * seen / m))  # no token lies between it and this bin
    return limit


def _numbered(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda t: F.struct(t["start"].alias("start"), F.lit(kind).alias("kind"), t["end"].alias("end")))


def scan_secrets(docs: DataFrame, text_col: str = "text", limits: tuple[list[float], int] | None = None, fdr: float = FDR, out: str = "secrets") -> DataFrame:
    """Adds ``secrets``: array of (kind, start, end) by start, then kind as in ``KINDS``; code points, end exclusive.

    Kinds ``assign``, ``access`` and ``hex`` are the fixed patterns (leftmost, not overlapping within a kind;
    an assignment needs a value of six characters); ``random`` are the tokens that the tests report. Spans
    of different kinds may overlap. Null and empty texts have none. ``limits`` (the words' law and the least
    -log2 p) come from ``word_law`` and ``randomness_limit`` over the same documents unless given. Rows stay as they are, repeated ones too;
    an input column named like the output gives way to it. No shuffle but for the law's pairs and the limit's histogram.
    """
    if limits is None:
        law = word_law(docs, text_col)
        limits = law, randomness_limit(docs, law, text_col, fdr)
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    df = docs.select(*[column(c) for c in kept])
    text, *parts = (fresh(df, f"__{n}") for n in ("text", *KINDS))
    df = df.withColumn(text, F.coalesce(column(text_col).cast("string"), F.lit("")))
    low = F.lower(column(text))
    worth = low.contains(ASSIGN_WORDS[0])
    for w in ASSIGN_WORDS[1:]:
        worth = worth | low.contains(w)
    df = _with_matches(df, text, ASSIGN, parts[0], worth)
    value = lambda m: F.length(F.regexp_extract(m, "^" + ASSIGN + "$", 1))
    df = df.withColumn(parts[0], F.filter(parts[0], lambda m: value(m["token"]) >= ASSIGN_MIN_VALUE))
    df = _with_matches(df, text, ACCESS, parts[1], column(text).contains("AKIA"))
    df = _with_matches(df, text, HEX, parts[2])
    df = _with_tokens(df, text, parts[3])
    df = df.withColumn(parts[3], F.when(F.size(parts[3]) > 0, F.filter(
        _tested(_encoded(F.col(parts[3])), limits[0]), lambda t: _p_bin(t["grade"]) >= limits[1])))
    spans = F.concat(*[_numbered(F.coalesce(F.col(p), F.array()), i) for i, p in enumerate(parts)])
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.transform(F.array_sort(spans), lambda t: F.struct(F.get(names, t["kind"]).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return df.select(*[column(c) for c in kept], ordered.alias(out))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each stretch that spans cover replaced by ``mark``; overlapping spans give one mark."""
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        inside = (s["start"] < a["pos"]) & (a["pos"] > 0)
        more = F.concat(a["out"], F.substring(text, a["pos"] + 1, F.greatest(s["start"] - a["pos"], F.lit(0))), F.when(inside, F.lit("")).otherwise(F.lit(mark)))
        return F.struct(F.greatest(a["pos"], s["end"]).alias("pos"), more.alias("out"))

    done = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
