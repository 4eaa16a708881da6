"""Phrase mining, source mixing and conversation repair against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import conversations, mixing, phrases, queries

BITS = 1 << 16


# --- phrase mining ---

def brute_counts(rows):
    f = Counter()
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            f[lang or "und", 0, ""] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und", k, " ".join(w[i:i + k])] += 1
    return f


def brute_collocations(rows, least, top):
    f = brute_counts(rows)
    freq = {key: n for key, n in f.items() if key[1] and n >= least}
    per = defaultdict(list)
    for (lang, k, p), a in freq.items():
        if k < 2:
            continue
        w = p.split(" ")
        if any(g == lang and n > k and 100 * b >= 80 * a and any(q.split(" ")[i:i + k] == w for i in range(n - k + 1)) for (g, n, q), b in freq.items()):
            continue
        cuts = []
        for i in range(1, k):
            l, r = f[lang, i, " ".join(w[:i])], f[lang, k - i, " ".join(w[i:])]
            cuts.append((2000000 * a // (l + r), i, l, r))
        score, _, l, r = min(cuts)
        per[lang].append((-score, -a, p.encode(), l, r))
    return {(g, i, p.decode(), -a, l, r, f[g, 0, ""], -s) for g, x in per.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1)}


def words_of(rng, n):
    return " ".join(rng.choice(["a", "b", "C", "dé", "x\ty", "日", "e.", "f,g", "\x00z", "h!\n", "\r\x0bk"]) for _ in range(n))


def test_collocations_equal_brute_force_whatever_the_sample(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["en", "de", None]), rng.choice([None, "", "  ", words_of(rng, rng.randrange(1, 90))])) for _ in range(160)]
    rows += [("en", "Quick BROWN fox jumps over. quick brown fox")] * 40
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("rank", F.lit(1)).repartition(5)
    want = brute_collocations(rows, 12, 9)
    for sample in (0.05, 0.3, 1.0):
        got = phrases.collocations(df, 12, 9, sample=sample, filter_bits=BITS)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {tuple(r) for r in got.collect()} == want


def test_border_failures_trigger_further_passes(spark):
    """A sample without the phrase proposes none of it; words, pairs and triples fail one after the other."""
    rows = [("en", f"u{i} v{i}") for i in range(3000)] + [("en", "north east south west wind")] * 30
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    passes, count = [], phrases._counts
    phrases._counts = lambda *a: passes.append(a[-1] is None) or count(*a)
    try:
        got = {(r.k, r.phrase): r.f for r in phrases.frequent_phrases(df, 30, sample=0.0001, filter_bits=BITS).collect()}
    finally:
        phrases._counts = count
    want = {(k, p): n for (_, k, p), n in brute_counts(rows).items() if n >= 30}
    assert got == want and (4, "east south west wind") in got
    assert passes == [False, True, True]


def test_a_full_filter_changes_nothing(spark):
    rows = [("en", "one two three four five")] * 8 + [("en", " ".join(f"w{i} w{i + 1}" for i in range(500)))] * 2
    df = spark.createDataFrame(rows, "lang string, text string")
    got = {(r.k, r.phrase): r.f for r in phrases.frequent_phrases(df, 5, sample=0.5, filter_bits=128).collect()}
    assert got == {(k, p): n for (_, k, p), n in brute_counts(rows).items() if n >= 5 or not k}


def test_long_texts_lose_no_phrase_at_a_cut():
    rng = random.Random(5)
    text = words_of(rng, 4000).encode()
    old = phrases.PART_BYTES
    try:
        for size in (1, 2, 7, 50, 1000):
            phrases.PART_BYTES = size
            got = Counter()
            for tokens, n in phrases._parts(text):
                got.update(tuple(tokens[i:i + 4]) for i in range(n) if b"." not in tokens[i:i + 4] and len(tokens[i:i + 4]) == 4)
            phrases.PART_BYTES = 10**9
            whole = [t for t, _ in phrases._parts(text)][0]
            assert got == Counter(tuple(whole[i:i + 4]) for i in range(len(whole) - 3) if b"." not in whole[i:i + 4])
    finally:
        phrases.PART_BYTES = old


def test_slices_within_a_task_add_up(spark):
    rows = [("en", "a b c d e f")] * 50
    want = {(k, p): n for (_, k, p), n in brute_counts(rows).items()}
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    assert {(r.k, r.phrase): r.f for r in phrases.frequent_phrases(df, 2, sample=1.0, filter_bits=BITS).collect()} == want
    part = phrases._Slice([([0, 1, 2, 0], 3)], [b"a", b"b", b"c"], ["en", "en", "de"])  # the last token starts no phrase here
    assert part.totals().to_pydict() == {"lang": ["en", "de"], "k": [0, 0], "phrase": ["", ""], "h": [0, 0], "f": [2, 1]}


def test_texts_are_tokenised_once_whatever_the_passes(spark, tmp_path):
    """Each pass reads the kept word numbers; the texts themselves are read by one task, once."""
    reads, made = [], phrases._sliced
    texts = [("en", f"u{i} v{i}") for i in range(3000)] + [("en", "north east south west wind")] * 30
    path = str(tmp_path / "texts")
    spark.createDataFrame(texts, "lang string, text string").coalesce(1).write.parquet(path)
    phrases._sliced = lambda docs: reads.append(1) or made(docs)
    try:
        known = phrases.frequent_phrases(spark.read.parquet(path), 30, sample=0.0001, filter_bits=BITS)
    finally:
        phrases._sliced = made
    assert reads == [1] and "FileScan" not in known._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.phrase): r.f for r in known.collect()} == {(k, p): n for (_, k, p), n in brute_counts(texts).items() if n >= 30 or not k}


def test_a_kept_slice_comes_back_as_it_was():
    for n in (0, 3, 70_000):  # no words, and more of them than 16 bits number
        words, langs = [b"w%d" % i for i in range(n)], ["en", "de"] * (n // 2) + ["en"] * (n % 2)
        items = [(np.r_[np.arange(n, dtype=np.int64), -1], max(n - 1, 0))] * 2
        part = phrases._Slice(items, words, langs)
        row = part.row(True).to_pylist()[0]
        back = phrases._Slice.of_row(row)
        assert row["pick"] and back.size == part.size and (back.w == part.w).all() and (back.starts == part.starts).all()
        assert back.spelling == words and back.langs.to_pylist() == langs and (back.hashes == part.hashes).all()


def test_hashes_are_exchanged_packed(spark):
    """Sorted hashes take a few bytes each, come back as they were and meet by their first bits; counted phrases travel without a hash."""
    rng = np.random.default_rng(1)
    values = np.unique(np.r_[rng.integers(0, 1 << phrases.HASH_BITS, 300_000, np.uint64), np.uint64(0), np.uint64((1 << phrases.HASH_BITS) - 1)])
    n = rng.integers(1, 4, len(values)) + (rng.random(len(values)) < 0.001) * (1 << 33)
    rows = phrases._packed_parts(values, n)
    assert sum(map(len, rows["hashes"].to_pylist())) < 5 * len(values)
    back = [(part, *phrases._of_packed(blob)) for part, blob in zip(rows["part"].to_pylist(), rows["hashes"].to_pylist(), strict=True)]
    assert (np.concatenate([(np.uint64(p) << phrases._LOW) | v for p, v, _ in back]) == values).all() and (np.concatenate([f for *_, f in back]) == n).all()
    texts = [("en", "a b c d"), ("de", "a b"), ("en", "A b. c d")] * 9
    docs = phrases._sliced(spark.createDataFrame(texts, "lang string, text string").withColumn("pick", F.lit(True)).repartition(3))
    full = spark.sparkContext.broadcast(np.full(BITS >> 6, 2**64 - 1, np.uint64).tobytes())
    none = spark.sparkContext.broadcast(np.zeros(BITS >> 6, np.uint64).tobytes())
    known = phrases._counts(docs, full, none, full)
    assert known.columns == ["lang", "k", "phrase", "f"]
    of = {(r.lang, r.k, r.phrase): r.f for r in known.where("k > 0").collect()}
    assert of == {key: f for key, f in brute_counts(texts).items() if key[1]}
    counted = sorted(r.f for r in phrases._hash_counts(docs, (1, 2, 3, 4), full, 10).collect())
    assert counted == sorted(f for f in of.values() if f >= 10)  # no two of these few phrases share a hash
    hashes = {r.h for r in phrases._hash_counts(docs, (1, 2, 3, 4), full, 1).collect()}
    dropped = 64 - phrases.HASH_BITS
    assert {r.h >> dropped << dropped for r in phrases._hashed(known.where("k > 0")).collect()} == hashes


def test_collocations_of_an_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(df, filter_bits=BITS).collect() == []


# --- mixing ---

def fill(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, full = share * sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * w[s] / free for s in names}
        more = {s for s in names if target[s] > most * sizes[s] * (1 + 1e-12)}
        if not more:
            return target
        full |= more


def tilt(sizes, target, most):
    """lambda by bisection."""
    rate = lambda lam, s: 1.0 if s == 0 else min(most, math.exp(min(50.0, lam * s)))
    lo, hi = -60.0, 60.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(s * rate(mid, s) for s in sizes) < target else (lo, mid)
    return lambda s: rate(hi, s)


def mixed(rows, spark, **kw):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int, taken int")
    return mixing.mix_sources(df, **kw).collect()


def texts(rng, n, source, at):
    size = lambda: max(1, int(rng.lognormvariate(3, 1)))
    return [(at + i, source, rng.choice([" ", "\n"]).join(["w"] * size()), 0, 0) for i in range(n)]


def test_mixing_meets_the_targets_by_tilted_rates(spark):
    rng = random.Random(11)
    rows = texts(rng, 900, "big", 0) + texts(rng, 200, "a", 2000) + texts(rng, 150, "Ω", 3000) + texts(rng, 90, None, 4000) + texts(rng, 300, "B", 5000)
    rows += [(7000, "empty", None, 0, 0), (7001, "empty", "", 0, 0), (7002, "big", " \t\n ", 0, 0), (None, "a", "x y z", 0, 0), (None, "a", "x y z", 0, 0)]
    got = mixed(rows, spark)
    assert sorted((r.id or -1) for r in got) == sorted((r[0] or -1) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    sizes = {s: sum(r.size for r in x) for s, x in by.items()}
    target = fill(sizes, (3, 1, 2), 1.5, 2)
    for s, x in by.items():
        assert {r.source_size for r in x} == {sizes[s]}
        assert all(r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in x)
        assert sum(r.taken for r in x) == pytest.approx(target[s], abs=1)
        if 0 < target[s] < 2 * sizes[s]:
            rate = tilt([r.size for r in x], target[s], 2.0)
            assert all(r.rate == pytest.approx(rate(r.size), rel=1e-5) for r in x)
    assert {(r.id, r.taken) for r in got if r.id} == {(r.id, r.taken) for r in mixed(rows[::-1], spark) if r.id}


def test_mixing_pays_back_what_large_documents_leave(spark):
    """One document holds most of a source's words, the small ones make up for its whole copies."""
    rows = [(0, "a", "w " * 500, 0, 0)] + [(i, "a", "w " * (1 + i % 7), 0, 0) for i in range(1, 200)] + [(1000, "b", "w " * 900, 0, 0)]
    got = mixed(rows, spark, weights=(1,), share=0.7)
    for s in "ab":
        x = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in x) - x[0].target) <= (1 if s == "a" else 900)


def test_mixing_of_repeated_ids_and_one_hot_cell(spark):
    rows = [(1, "a", "x y", 0, 0)] * 300 + [(i, "a", "x y", 0, 0) for i in range(2, 302)] + [(9999, "b", "w " * 100, 0, 0)]
    got = mixed(rows, spark, weights=(1, 9))
    a = [r for r in got if r.source == "a"]
    assert len(got) == len(rows) and sum(r.taken for r in a) == pytest.approx(a[0].target, abs=2)
    assert {r.copies for r in a} <= {0, 1, 2}


def test_mixing_of_nothing(spark):
    assert mixed([], spark) == []
    got = mixed([(1, None, None, 0, 0), (2, "a", " ", 0, 0)], spark)
    assert sorted(tuple(r)[:5] for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mixing_runs_without_python_workers(spark):
    df = spark.createDataFrame([(1, "a", "x y")], "doc_id long, source string, text string")
    plan = mixing.mix_sources(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


# --- conversation repair ---

def brute_repair(turns):
    """(cost, audit) by exhaustive recursion over (turns read, initials so far as a state)."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    memo = {}

    def best(i, state, inserted):
        key = i, state, inserted
        if key in memo:
            return memo[key]
        ways = [(0, "")] if i == len(turns) and state in ("", "a") else []

        def way(cost, letter, ahead):
            if ahead is not None:
                ways.append((cost + ahead[0], letter + ahead[1]))

        for r in "ua":
            if r in legal[state] and inserted < 2:
                way(5, "I", best(i, r, inserted + 1))
        if i < len(turns):
            initial, fault = turns[i]
            way(2, "D", best(i + 1, state, 0))
            if fault in ("", "truncated"):
                extra = 5 if fault else 0
                if initial and initial in legal[state]:
                    way(extra, "K", best(i + 1, initial, 0))
                for r in "ua":
                    if r in legal[state]:
                        way(extra + 1, "R", best(i + 1, r, 0))
        memo[key] = min(ways) if ways else None
        return memo[key]

    return best(0, "", 0)


def brute_conversations(rows):
    """The whole contract in plain Python."""
    per = {}
    blank = re.compile(r"[\x20\x09-\x0D]+")
    for c, t, role, text in rows:
        out = per.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(t, role, text)] * (2 if kind == 3 else 1)
    result = set()
    for c, x in per.items():
        x.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, turns = set(), []
        for _, role, text in x:
            left = blank.sub("", text)
            fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
            seen.add((role, text))
            turns.append((role[:1], fault))
        cost, audit = brute_repair(turns)
        lines, state, i = [], "", 0
        for e in audit:
            asked = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if e == "I":
                lines.append(asked + ":")
                state = asked[0]
                continue
            role, text = x[i][1:]
            i += 1
            if e != "D":
                role = asked if e == "R" else role
                lines.append(f"{role}:{text}")
                state = role[0]
        numbers = [r[0] for r in x if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        count = Counter(f for _, f in turns)
        pairs = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        result.add((c, gaps, count["blank"], count["duplicate"], count["truncated"], pairs, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return result


def random_turns(rng, n, faults=True):
    return [(rng.choice("suaxua"), rng.choice(["", "", "", "blank", "truncated", "duplicate"]) if faults else "") for _ in range(n)]


def test_search_finds_the_cheapest_audit():
    rng = random.Random(1)
    close = ["", "II", "I", ""]
    for case in range(600):
        turns = random_turns(rng, rng.randrange(1, 14), case % 3 > 0)
        found = conversations.search(turns, conversations.START)
        ways = [(x[0] + 5 * len(c), x[1] + c) for x, c in zip(found, close, strict=True) if x]
        assert min(ways) == brute_repair(turns), turns


def test_suffix_bounds_never_exceed_the_cost():
    rng = random.Random(2)
    for _ in range(300):
        turns = random_turns(rng, rng.randrange(1, 10))
        for i, b in enumerate(conversations.suffix_bounds(turns)[:-1]):
            for entry in range(4):
                assert all(x is None or x[0] >= b for x in conversations.search(turns[i:], entry))


def test_search_of_a_whole_block_is_quick():
    rng = random.Random(4)
    turns = [(rng.choice("ua"), "") for _ in range(conversations.BLOCK_TURNS)]
    found = conversations.search(turns, conversations.START)
    assert min(x[0] + 5 * len(c) for x, c in zip(found, ["", "II", "I", ""], strict=True) if x) == brute_repair(turns)[0]


def run_contract(spark, rows, tmp_path):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit(1)).repartition(3).write.parquet(path)
    got = queries.op13_conversation_repair(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {tuple(r) for r in got.collect()}


def test_repair_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    say = lambda: rng.choice(["Yes.", "no", "Why?  ", " \t", "", None, "End!\n", "x.y", "Ünd so…"])
    rows = [(c, rng.choice([t, t + 1, None]) if rng.random() < 0.2 else t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), say())
            for c in [None, *range(60)] for t in range(rng.randrange(1, 9))]
    unique = {(r[0], r[1], r[2]): r for r in rows}  # no ties between different texts
    rows = list(unique.values())
    assert run_contract(spark, rows, tmp_path) == brute_conversations(rows)


def test_repair_of_long_conversations_in_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK_TURNS", 7)
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["system", "user", "assistant"]), f"{rng.randrange(40)} said{rng.choice(['.', '', '?'])}") for c in (1, 2, 3) for t in range(90)]
    assert run_contract(spark, rows, tmp_path) == brute_conversations(rows)


def test_repair_of_lost_and_absent_conversations(spark, tmp_path):
    lost = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    rows = [(lost, 0, "user", "Hello.")]
    empty = hashlib.sha256(b"").hexdigest()
    assert run_contract(spark, rows, tmp_path) == {(lost, 0, 0, 0, 0, 0, 0, "", empty)}
    assert run_contract(spark, [], tmp_path / "none") == set()


def test_edits_render_the_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 2, "user", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    facts, edits = conversations.repair_conversations(df)
    assert [tuple(r)[1:] for r in facts.collect()] == [(0, 0, 1, 0, 2, 4, "KRRD")]
    got = [(r.edit, r.turn, r.role, r.text) for r in edits.orderBy("part", "block", "seq").collect()]
    assert got == [("K", 0, "system", "Be kind."), ("R", 1, "user", "Hello."), ("R", 2, "assistant", "Hi."), ("D", 2, "user", "Hi.")]
