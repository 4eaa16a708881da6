"""Each operator against a brute-force version, an exact round trip or held-out accuracy, with awkward inputs."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import bpe, chat, decontaminate, fingerprints, html_text, language_id, secrets, simhash, toxicity, url_rules
from reviewlake.llm.components import components
from reviewlake.llm.queries import byte_bpe

WORDS = "the of and river stone quick under light seven paper window orange cloud silver market garden winter simple travel letter".split()
SCHEMA = "doc_id long, text string, lang string, score string, host string, leaks string, secrets string, spans string"


def prose(rng, n):
    out = []
    while len(out) < n:
        out += [rng.choice(WORDS) + rng.choice(["", "s", "ly", "ing"]) for _ in range(rng.randint(4, 12))]
        out[-1] += rng.choice([".", ".\n", ","])
    return " ".join(out[:n])


def table(spark, texts, ids=None):
    """Documents with extra columns that bear the names of outputs."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", "h", "l", "x", "y") for i, t in zip(ids, texts)], SCHEMA)


AWKWARD = [None, "", "   \n\t ", "a", "no end", "x" * 5000, "é ü ñ 日本語 🙂\u0000", "word " * 3000, "!!! 123 ---", "same text here now", "same text here now"]


# ------------------------------------------------------------------ byte-level BPE
def test_bpe_equals_tiktoken_and_decodes(spark):
    import public_tokenizers as tok
    import tiktoken

    ranks = {t: i for i, t in enumerate(bpe.read_ranks(tok.path("byte_bpe_50k.tiktoken")))}
    own = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*AWKWARD, "<|endoftext|> it's\r\n\r\n  twice", "".join(map(chr, range(1, 700)))]
    rows = bpe.encode_texts(table(spark, texts), byte_bpe(), keep=["doc_id"]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = own.encode_ordinary(text)
        raw = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, bytes(r.ids), r.ids_sha256) == (len(ids), raw, hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode_ids(bpe.encode_texts(table(spark, texts), byte_bpe(), keep=["doc_id"]), byte_bpe())
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_bpe_memory_may_be_cleared_at_any_time(monkeypatch):
    import public_tokenizers as tok

    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    small = bpe.tokenizer(tok.path("byte_bpe_50k.tiktoken"), tok.PATTERN)()
    texts = ["one two three four five", "six seven one", "", "one two"]
    assert small.decode(b"".join(small.encode(texts))) == "".join(texts).encode()
    assert all(small.encode([t])[0] == x for t, x in zip(texts, small.encode(texts)))


# ------------------------------------------------------------------ paragraph sketches
def test_sketches_recover_exact_differences(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.choice([0, 5, 40, 300, 2000])) for _ in range(30)] + AWKWARD + [prose(rng, 300)] * 3
    ids = [i * 37 for i in range(len(texts))]
    ids[-1] = ids[-2]  # a repeated id
    rows = fingerprints.fingerprint_versions(table(spark, texts, ids)).collect()
    assert len(rows) == len(texts)
    cut = re.compile(fingerprints.PARAGRAPH)
    parts = lambda t: set(cut.findall(t or ""))
    near = lambda a, b: len(parts(a) & parts(b)) / len(parts(a) | parts(b)) if parts(a) | parts(b) else 1.0
    unique = {i: t for i, t in zip(ids, texts) if ids.count(i) == 1}
    order = sorted(zip(ids, texts), key=lambda x: -x[0])
    by_id = {r.id: r for r in rows}
    prints = {}
    for k, (i, t) in enumerate(order):
        r = by_id[i]
        assert prints.setdefault(t or "", r.fingerprint) == r.fingerprint
        if i not in unique or order[(k + 1) % len(order)][0] not in unique:
            continue
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(t)
        assert r.near_edited == pytest.approx(near(t, edited)) and r.near_next == pytest.approx(near(t, nxt))
        assert len(r.edited_gained) == len(parts(edited) - parts(t)) and len(r.edited_lost) == len(parts(t) - parts(edited))


def test_a_sketch_is_made_once_and_peels_to_the_difference(spark):
    rng = random.Random(9)
    pool = [rng.getrandbits(63) for _ in range(40)]
    pairs = [(pool[:a], pool[a - common:a - common + b]) for a, b, common in ((0, 0, 0), (3, 3, 3), (4, 5, 3), (1, 0, 0), (0, 4, 0), (12, 12, 9), (20, 20, 0))]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(pairs)], "i int, first array<long>, second array<long>")
    for seed in (0, 1, 2):  # the stored form and further attempts
        sketches = df.select("i", "first", "second", fingerprints.difference_sketch(F.col("first"), F.col("second"), seed).alias("cells"))
        peeled = sketches.select("i", fingerprints.peel(F.col("cells"), seed).alias("r"))
        rows = [r.r for r in peeled.orderBy("i").collect()]
        assert not any(r.left for r in rows[:5]) and rows[6].left  # 40 digests do not fit 24 cells
        for (a, b), r in zip(pairs, rows, strict=True):
            assert set(r.got.lost) <= set(a) - set(b) and set(r.got.gained) <= set(b) - set(a)
            assert r.left or (len(r.got.lost), len(r.got.gained)) == (len(set(a) - set(b)), len(set(b) - set(a)))
    plan = sketches.withColumnRenamed("cells", "made_once").select(fingerprints.peel(F.col("made_once"), 1).alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.splitlines()[0].count("made_once") == 1


def test_sketches_of_tiny_tables(spark):
    empty = fingerprints.fingerprint_versions(table(spark, []))
    assert empty.count() == 0
    one = fingerprints.fingerprint_versions(table(spark, ["alone\nhere"])).first()
    assert one.near_next == 1.0  # it follows itself
    nulls = fingerprints.fingerprint_versions(table(spark, ["a\nb", "c\nd", None], [None, 5, None])).collect()
    assert len(nulls) == 3


def test_an_unchanged_half_leaves_common_paragraphs(spark):
    rng = random.Random(23)
    han = "".join(chr(rng.randint(0x4e00, 0x9fff)) for _ in range(600))
    lines = ["".join(han[i:i + 30] + "。" for i in range(0, 600, 30)), han, " ".join(f"k{rng.random()}=v{rng.random()}" for _ in range(40)),
             "".join(f"var a{rng.randint(0, 9999)}={rng.randint(0, 9999)};" for _ in range(60)), "".join(rng.choice("ACGT") for _ in range(900)),
             " ".join(rng.choice(WORDS) for _ in range(120)), "Short one. " + "Then another short one. " * 3 + prose(rng, 30).replace("\n", " "),
             "".join(chr(rng.randint(0xe01, 0xe2e)) for _ in range(700))]
    rows = {r.id: r for r in fingerprints.fingerprint_versions(table(spark, lines)).collect()}
    assert all(0 < rows[i].near_edited < 1 for i in range(len(lines)))
    shifted = re.findall(fingerprints.PARAGRAPH, "new words here " + lines[5])  # found again behind an insertion
    assert len(set(shifted) & set(re.findall(fingerprints.PARAGRAPH, lines[5]))) >= 0.8 * len(shifted)


# ------------------------------------------------------------------ url rules
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
         ("b.net", "/fr/x", "allow"), ("", "/empty", "block")]


def judge(url, rules=RULES):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit) if fit else (0, 0, False, None, "allow")
    return host, path, best[3], best[4]


def test_url_rules_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "BLOCK_HOSTS", 3)
    rng = random.Random(5)
    hosts = ["com", "example.com", "WWW.Example.com", "a.b.c.example.com", "notexample.com", "x.net", "a.b.net", "b.net", "net", "org", "", "com.", "-a.com", "a..com", "com:80"]
    paths = ["", "/", "/en/", "/en/x", "/en", "/es/1", "/fr/x?y", "/fr/x#z", "?q=/en/", "#/es/", "/EN/", "/empty"]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)]
    urls += [None, "", "no scheme/en/", "http:/one.com/", "://example.com/en/a", "a://b.com/x://y.net/es/", "http://ex\nample.com/en/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = spark.createDataFrame([r for r in RULES if r[0]] + [(None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, rules).collect()}
    assert got == {i: judge(u) for i, u in enumerate(urls)}
    none = url_rules.judge_urls(pages, rules.where("false")).where("verdict <> 'allow' or rule is not null")
    assert none.count() == 0 and url_rules.judge_urls(pages.where("false"), rules).count() == 0


# ------------------------------------------------------------------ SimHash
def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    keys = [{}, {}]
    for side, x in enumerate((a, b)):
        for k, r in zip(*simhash.pair_keys(x)):
            keys[side].setdefault(int(r), set()).add(int(k))
    assert all(keys[0][i] & keys[1][i] for i in range(len(a)))
    words = np.arange(0, 1 << 23, 997, dtype=np.uint32)
    parity, _ = simhash._golay()
    index = simhash.codeword_index(words)
    assert (np.bitwise_count(words ^ ((index << np.uint32(11)) | parity[index])) <= 3).all()


def closure(fps, bits):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("limit", [65_536, 7])
def test_links_join_what_brute_force_joins(spark, monkeypatch, limit):
    """A dense group, chains of close fingerprints and strangers; also with runs cut into blocks."""
    rng = random.Random(11)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2))) for _ in range(150)}
    x = rng.getrandbits(64)
    for _ in range(40):
        x ^= sum(1 << b for b in rng.sample(range(64), rng.choice([3, 4, 5])))
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(50)} | {0}
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "_SHORT_RUN", 5)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v),) for v in fps], "simhash long")
    got = {r.node: r.root for r in components(simhash.fingerprint_links(df, run_limit=limit)).collect()}
    want = closure(fps, 4)
    groups = {}
    for i, v in enumerate(fps):
        groups.setdefault(want[i], set()).add(signed(v))
    for members in groups.values():
        roots = {got.get(m, m) for m in members}
        assert roots == {min(members)}


def test_near_duplicates_of_awkward_texts(spark):
    rng = random.Random(2)
    long = prose(rng, 900)
    texts = [*AWKWARD, long, long.replace("river", "rivers", 1), long.upper()]
    rows = {r.id: r for r in simhash.near_duplicates(table(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        assert rows[i].simhash & (2 ** 64 - 1) == slow_simhash(t or "")
    want = closure([slow_simhash(t or "") for t in texts], 4)
    assert [rows[i].component for i in range(len(texts))] == want
    assert rows[0].component == rows[1].component == rows[2].component == 0  # no words: fingerprint zero
    nulls = simhash.near_duplicates(table(spark, ["same words of text", "same words of text", "other words are here"], [None, 7, None])).collect()
    assert sorted((r.component is None, r.component or 0) for r in nulls) == [(False, 7), (False, 7), (True, 0)]
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def slow_simhash(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(b"[A-Z]", lambda m: m[0].lower(), text.encode()))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_equal_union_find(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (2000, 2001), (2000, 2001)]
    parent = {v: v for e in edges for v in e}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(v, v) == find(v) for v in parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ decontamination
def edits(item, text):
    """Least word edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_contamination_recall_and_exactness(spark):
    rng = random.Random(4)
    vocab = [f"{a}{b}{c}" for a in WORDS for b in ("", "er", "ow") for c in ("", "ti", "ma", "lo")]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [text(rng.randint(14, 60)) for _ in range(60)] + [text(5)]
    docs, planted = [], []
    for k in range(180):
        i = k % len(items)
        words, share = list(items[i]), [0, 0.05, 0.1, 0.2][k % 4] if len(items[i]) > 10 else 0
        for at in rng.sample(range(len(words)), int(share * len(words))):
            words[at] = rng.choice(["", "new", words[at] + " more"])
        docs.append(" ".join([*text(rng.randint(0, 80)), *words, *text(rng.randint(0, 80))]).title())
        planted.append(i)
    clean = [" ".join(text(200)) for _ in range(100)]
    bench = spark.createDataFrame([*[(i, " ".join(t)) for i, t in enumerate(items)], (900, None), (901, ""), (902, " ".join(items[0]))], "item_id long, text string")
    rows = decontaminate.find_contamination(table(spark, docs + clean + AWKWARD), bench, keep=["doc_id"]).collect()
    found = {r.doc_id: r.leaks for r in rows}
    assert len(found) == len(docs) + len(clean) + len(AWKWARD)
    hit = sum(any(leak.item_id == planted[d] for leak in found[d]) for d in range(len(docs)))
    assert hit >= 0.95 * len(docs)
    for d in range(len(docs)):
        words = docs[d].lower().split()
        for leak in found[d]:
            item = items[0] if leak.item_id == 902 else items[leak.item_id]
            assert leak.edits == edits(item, words) <= 0.2 * len(item)
            assert edits(item, docs[d][leak.start:leak.end].lower().split()) == leak.edits
        assert any(leak.item_id == 902 for leak in found[d]) == any(leak.item_id == 0 for leak in found[d])
    for d in range(len(docs), len(found)):
        words = (docs + clean + AWKWARD)[d] or ""
        assert all(edits(items[leak.item_id % 902], words.lower().split()) <= 0.2 * 60 for leak in found[d])
        assert not found[d]


def test_short_items_are_found_within_their_limit():
    rng = random.Random(14)
    vocab = [a + b for a in WORDS for b in ("", "er", "ow", "ti", "ma")]
    items = [[rng.choice(vocab) for _ in range(n)] for n in range(1, 21) for _ in range(8)]
    index = decontaminate.index_items([(i, " ".join(x)) for i, x in enumerate(items)])
    texts = []
    for x in items:
        words = list(x)
        for at in rng.sample(range(len(x)), len(x) // 5):
            words[at] = rng.choice(["", "new", words[at] + " more"])
        texts.append(" ".join([*rng.choices(vocab, k=rng.randint(0, 30)), *words, *rng.choices(vocab, k=rng.randint(0, 30))]))
    got = {(f[0], f[1]): f[2] for f in decontaminate._find(index, texts)}
    for d, t in enumerate(texts):
        for i, x in enumerate(items):
            least = edits(x, t.split())
            assert got.get((d, i)) == (least if least <= len(x) // 5 else None)


def test_contamination_in_blocks_and_without_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 8)
    items = ["one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"]
    docs = table(spark, ["so " + items[0] + " end", items[1].upper(), "nothing of it", None])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.find_contamination(docs, bench, keep=["doc_id"])
    assert found.columns == ["doc_id", "leaks"]
    assert {r.doc_id: [x.item_id for x in r.leaks] for r in found.collect()} == {0: [0], 1: [1], 2: [], 3: []}
    none = decontaminate.find_contamination(docs, bench.where("false"))
    assert none.where(F.size("leaks") > 0).count() == 0 and none.count() == 4


# ------------------------------------------------------------------ secrets
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(found)]


def test_base_spans_equal_brute_force_and_redaction(spark):
    rng = random.Random(8)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [f"é{prose(rng, 30)} 🙂 token = \"{hexa(40)}\" x PASSWORD:{hexa(5)} api_key='{hexa(6)}'", f"AKIA{'Z' * 16} AKIA{'Z' * 15} {hexa(23)} {hexa(24)}{hexa(3)}g{hexa(30)}",
             "token=token: abcdefgh secret=secret=abcdefg passwd = short", "apikey=abc.def-ghi/+= SeCrEt \"  =  'value123", "token\n=abcdefgh", "ſecret=abcdefgh",
             " ".join(f"token={hexa(8)}" for _ in range(700)), *AWKWARD, prose(rng, 400)]
    rows = {r.doc_id: r.secrets for r in secrets.scan_secrets(table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert [(s.kind, s.start, s.end) for s in rows[i] if s.kind != "random"] == base_spans(t or "")
    cut = secrets.scan_secrets(table(spark, texts)).select("doc_id", "text", secrets.redact(F.col("text"), F.col("secrets")).alias("clean")).collect()
    for r in cut:
        if r.text is None:
            assert r.clean is None
            continue
        out, at = "", 0
        for s in rows[r.doc_id]:
            if s.start < at:
                at = max(at, s.end)
                continue
            out, at = out + r.text[at:s.start] + "[SECRET]", s.end
        assert r.clean == out + r.text[at:]
    assert secrets.scan_secrets(table(spark, [])).count() == 0


def test_word_law_counts_every_word(spark):
    """The law comes from all words: those behind the first thousands of characters, of very long words, and of the last of many rows."""
    texts = ["1 2 " * 2500 + "zqzq Zq", "qz" * 20_000, None, "", "ab-cd x notaword1"] + ["jx kv"] * 6000
    seen: dict[str, float] = {}
    for w in (w for t in texts if t for w in re.findall(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{2,}(?![A-Za-z0-9+/_=-])", t)):
        for a, b in zip("^" + w.lower()[:-1], w.lower(), strict=True):
            seen[a + b] = seen.get(a + b, 0.0) + 1
    assert seen["zq"] > 3 and seen["jx"] == 6000
    assert secrets.word_law(table(spark, texts)) == secrets._word_law(seen)


def test_random_tokens_are_found_among_words(spark):
    rng = random.Random(6)
    abc = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    word = lambda: "".join(rng.choice(["tion", "heit", "schaft", "keit", "ver", "ung", "lich"]) for _ in range(rng.randint(5, 9)))
    texts = [f"{word()} and {word()} then {word()}" for _ in range(400)]
    for i in range(60):
        texts[i] += " " + "".join(rng.choice(abc) for _ in range(rng.choice([32, 44, 64])))
    texts += ["a1" * 20, "0" * 40, "1234567890" * 4]
    rows = {r.doc_id: [s for s in r.secrets if s.kind == "random"] for r in secrets.scan_secrets(table(spark, texts)).collect()}
    assert sum(bool(rows[i]) for i in range(60)) >= 50
    assert not any(rows[i] for i in range(60, 400))
    assert not rows[400] and not rows[401]


def test_random_tokens_need_no_words(spark):
    """The same token is found in a table without one long word and among few of them."""
    rng = random.Random(16)
    abc = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    token = lambda: "".join(rng.choice(abc) for _ in range(rng.choice([24, 32, 44])))
    found = lambda texts: [[s for s in r.secrets if s.kind == "random"] for r in secrets.scan_secrets(table(spark, texts)).orderBy("doc_id").collect()]
    alone = found([token() for _ in range(20)])
    assert sum(map(bool, alone)) >= 19
    mixed = found([f"{prose(rng, 30)} {token()}" for _ in range(20)] + ["internationalization of electroencephalograms"] * 3 + ["a1" * 20, "0" * 40])
    assert sum(map(bool, mixed[:20])) >= 19 and not any(mixed[20:])


def test_random_letters_are_found_and_long_words_stay(spark):
    rng = random.Random(26)
    small, great = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tokens = ["".join(rng.choice(abc) for _ in range(n)) for abc in (small, great, small + great) for n in (32, 40) for _ in range(20)]
    words = ["internationalization", "electroencephalographically", "counterrevolutionaries", "antidisestablishmentarianism", "uncharacteristically",
             "Donaudampfschifffahrtsgesellschaft", "Rechtsschutzversicherungsgesellschaften", "anticonstitutionnellement", "institutionalization",
             "INTERNATIONALIZATION", "getElementsByClassNameAndValue", "path/to/some/other/folder", "state-of-the-art-technology", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    rows = secrets.scan_secrets(table(spark, [f"{prose(rng, 20)} {t} {prose(rng, 5)}" for t in tokens + words * 4])).orderBy("doc_id").collect()
    found = [any(s.kind == "random" for s in r.secrets) for r in rows]
    assert sum(found[:len(tokens)]) >= 0.95 * len(tokens)
    assert not any(found[len(tokens):])


# ------------------------------------------------------------------ toxicity
def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(12)
    insults = ["moronic", "scumbag", "worthless", "pathetic"]
    texts, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(rng, 60).split()
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        texts.append(" ".join(words))
        labels.append(int(bad))
    model = toxicity.fit(texts[:300], labels[:300])
    held = table(spark, texts[300:] + AWKWARD + [f"{prose(rng, 30)} m-o-r-o-n-i-c. w o r t h l e s s. pathetiic {prose(rng, 30)}"])
    rows = {r.doc_id: r for r in toxicity.score_toxicity(held, model, keep=["doc_id"]).collect()}
    assert sum(rows[i].predicted == labels[300 + i] for i in range(100)) >= 97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    assert rows[100].score == rows[101].score and rows[100].predicted == 0
    assert rows[len(rows) - 1].predicted == 1
    one = toxicity.fit(["only one label"], [0])
    assert toxicity.worst_sentences(one, ["x", ""]).shape == (2,)
    assert toxicity.score_toxicity(held.where("false"), model).count() == 0


def test_toxicity_training_reads_labels_only(spark):
    docs = table(spark, ["good words here", None, "bad idiot words", "more good words"])
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (3, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    assert model.weights.any()


# ------------------------------------------------------------------ language
def sentence(rng, lang):
    parts = {"xx": ["ka", "ro", "mi", "tu"], "yy": ["sch", "ein", "ung", "ver"], "zz": ["жи", "ка", "ло", "ны"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(8, 20))) + ". "


def test_languages_spans_and_undetermined(spark):
    rng = random.Random(1)
    rows = [(i, "".join(sentence(rng, lang) for _ in range(4)), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 40)]
    train = spark.createDataFrame([*rows, (900, None, "xx"), (901, "ohne", None)], "doc_id long, text string, lang string")
    model = language_id.train_language_model(train)
    assert model.langs == ["xx", "yy", "zz"]
    x, y, z = (sentence(rng, v) * 3 for v in ("xx", "yy", "zz"))
    texts = [x, y, z, x + y, z + "日本語", *AWKWARD, "日本語 テキスト", "1234 !!"]
    got = {r.doc_id: r for r in language_id.identify_languages(table(spark, texts), model, keep=["doc_id"]).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["xx", "yy", "zz"]
    assert [s.lang for s in got[3].lang_spans] == ["xx", "yy"]
    assert abs(got[3].lang_spans[1].start - len(x)) <= 12  # words that both languages could hold may go either way
    for i, t in enumerate(texts):
        letters = [c for c in t or "" if c.isalpha()]
        if not letters:
            assert (got[i].lang_pred, got[i].score, got[i].lang_spans) == ("und", 0.0, [])
        assert 0 <= got[i].score <= 1
    assert got[len(texts) - 2].lang_pred == "und"  # a script that no learnt language uses
    none = language_id.train_language_model(train.where("false"))
    assert {r.lang_pred for r in language_id.identify_languages(table(spark, texts), none).collect()} == {"und"}


def test_letters_of_unknown_scripts_count(spark):
    rng = random.Random(31)
    train = spark.createDataFrame([(i, sentence(rng, lang) * 3, lang) for i, lang in enumerate(["xx", "yy"] * 30)], "doc_id long, text string, lang string")
    model = language_id.train_language_model(train)
    texts = ["ภาษาไทย " * 1000 + "karo", "karo mitu " * 10 + "ไทย " * 5, "ไทย", "12 ไทย karo", "karo"]
    got = [(r.lang_pred, r.score, [(s.start, s.end, s.lang) for s in r.lang_spans])
           for r in language_id.identify_languages(table(spark, texts), model, keep=["doc_id"]).orderBy("doc_id").collect()]
    letters = lambda t: sum(c.isalpha() for c in t)
    for (_, score, _), t in zip(got, texts, strict=True):
        assert score == pytest.approx(letters("".join(c for c in t if c.isascii())) / letters(t))
    assert [g[0] for g in got] == ["xx", "xx", "und", "xx", "xx"]
    assert got[0][2] == [(0, 7999, "und"), (8000, 8004, "xx")] and got[2][2] == [(0, 3, "und")] and got[3][2] == [(3, 6, "und"), (7, 11, "xx")]


def test_viterbi_equals_exhaustive_search():
    rng = np.random.default_rng(3)
    from itertools import product

    count = np.array([4, 0, 6, 1])
    scores = rng.normal(0, 3, (count.sum(), 3)).astype(np.float32)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    labels = language_id._viterbi(scores, first, count, 2.0)
    for f, n in zip(first, count):
        value = lambda path: sum(scores[f + i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
        if n:
            assert value(labels[f:f + n]) == pytest.approx(max(value(p) for p in product(range(3), repeat=int(n))), abs=1e-4)


# ------------------------------------------------------------------ chat
def cheapest(roles):
    """Least cost over all choices of a role per turn, by the legal-turn automaton."""
    from itertools import product

    best = 1e9
    for chosen in product(chat.ROLES, repeat=len(roles)):
        cost, state = 0.0, 0
        for given, role in zip(roles, chosen):
            if (state, role) not in chat._MOVES:
                break
            cost += chat._MOVES[state, role][0] + (0 if given == role else chat.RELABEL)
            state = chat.STATES.index(role)
        else:
            best = min(best, cost + chat._CLOSING[state])
    return best


def test_repair_is_the_cheapest():
    rng = random.Random(7)
    for _ in range(60):
        roles = [rng.choice([*chat.ROLES, "other"]) for _ in range(rng.randint(1, 6))]
        cost, states = chat.repair(roles)
        assert cost == pytest.approx(cheapest(roles)) and len(states) == len(roles)


@pytest.mark.parametrize("block", [512, 3])
def test_chats_render_legally(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rng = random.Random(10)
    rows = []
    for c in range(30):
        for t in range(rng.choice([1, 2, 5, 14])):
            rows.append((c, t, rng.choice(["user", "assistant", "System ", "human", "bot", None, "tool"]), rng.choice(["hi", "", None, "a\nb"]), "clash"))
    rows += [(None, 1, "user", "x", "c"), (None, None, "assistant", "y", "c"), (7, 0, "user", "twin", "c"), (7, 0, "user", "twin", "c")]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered string")).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.conv_id, []).append(r)
    legal = re.compile(r"(?:<\|system\|>\n(?s:[^<]*)<\|end\|>\n)?(?:<\|user\|>\n[^<]*<\|end\|>\n<\|assistant\|>\n[^<]*<\|end\|>\n)*")
    for turns in by.values():
        turns.sort(key=lambda r: r.place)
        assert [r.place for r in turns] == list(range(len(turns)))
        assert legal.fullmatch("".join(r.rendered for r in turns))
        roles = [chat.canonical_role(r.role_given) for r in turns]
        _, states = chat.repair(roles)
        assert [r.role_fixed for r in turns] == [chat.STATES[s] for s in states]
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# ------------------------------------------------------------------ pages
def test_main_text_of_pages(spark):
    page = ("<!DOCTYPE html><html><head><title>T</title><script>var a = '</p>';</script></head><body><header>Top</header><nav><ul><li>Menu</ul></nav>"
            "<div class='ad big'>Buy</div><main><article><header><h1>Head &amp; Title</h1></header><p>One <b>bold</b>\n  text<br>here<p>Two &#39;x&#x41;&eacute;"
            "<ul><li>first<li>second</ul><aside>side</aside><form>f<input></form><div class=comments><p>reader</div><table><tr><td>a<td>b</table></article></main>"
            "<footer>&copy; foot</footer></body></html>")
    want = "Head & Title\nOne bold text here\nTwo 'xAé\nfirst\nsecond\na\nb"
    plain = "<div>1 < 2 and <i>kept</i></div><p>tail &am"
    pages = [page, page, None, "", plain, "<p>cut off <a href='x", "no markup", "<script>only", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>"]
    df = spark.createDataFrame([(i, f"http://h{i}.example.com/", p, "clash") for i, p in enumerate(pages)], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
    assert got == {0: want, 1: want, 2: "", 3: "", 4: "1 < 2 and kept\ntail &am", 5: "cut off", 6: "no markup", 7: "", 8: "deep"}
    assert html_text.extract_text(df.where("false")).count() == 0


@pytest.mark.parametrize("limit", [500_000, 0])
def test_templates_go_copies_stay(spark, limit):
    rng = random.Random(3)
    rows = []
    for i in range(40):
        own = f"<p>{prose(rng, 40)}</p><p>{prose(rng, 10)}</p>"
        rows.append((i, "http://site.example.com/a", f"<div>Site news box</div><section>Archive <b>2020</b></section>{own}"))
    copy = "<div>shared words of a copied page</div><p>long paragraph of the copied page with many words</p>"
    rows += [(100 + i, "http://mirror.example.com/x", copy) for i in range(30)]
    rows += [(200, "http://other.example.com/", "<div>Site news box</div><p>but on another host</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in html_text.extract_text(df, broadcast_limit=limit).collect()}
    assert len(got) == len(rows)
    assert all("news box" not in got[i].text and "Archive" not in got[i].text and got[i].n_chars == len(got[i].text) > 100 for i in range(40))
    assert all("shared words" in got[100 + i].text and "long paragraph" in got[100 + i].text for i in range(30))
    assert "news box" in got[200].text


@pytest.mark.parametrize("limit", [500_000, 0])
def test_template_longer_than_any_own_paragraph_goes(spark, limit):
    rng = random.Random(13)
    legal = f"<div><p>Legal {prose(rng, 300)}</p></div>"
    shared = f"<p>{prose(rng, 120)}</p>"  # a passage that many pages quote is no sign of a copy
    own = [f"own{i} {prose(rng, 20)}" for i in range(20)]
    rows = [(i, "http://site.example.com/a", f"<div>Site news box</div><p>{own[i]}</p>{shared if i % 2 else ''}{legal}") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(df, broadcast_limit=limit).collect()}
    assert all("Legal" not in got[i] and "news box" not in got[i] and f"own{i} " in got[i] for i in range(20))


def test_class_words_delete_no_article(spark):
    body = "<p>The story itself.</p>"
    pages = [f"<div class='layout with-sidebar'><article>{body}</article></div>", f"<main class='search-results'>{body}</main>",
             f"<article class='post related-post'>{body}</article>", f"<div id='page' class='has-notice'><article>{body}</article></div>",
             f"<div class='social_layout'><div class='widget'><article>{body}</article></div></div>", f"<div class='page no-menu'>{body}</div>",
             f"<div role=main class=search>{body}</div>", f"<div class='masthead-page'><div class='related'><article>{body}</article></div></div>",
             f"<main><div class='sidebar-page'><article>{body}</article></div></main>",
             f"<article>{body}</article><div class='related'><article>Teaser</article></div><div class='sidebar no-print'>Side</div>",
             f"<article>{body}</article><article hidden>Unseen</article><div hidden><article>Unseen</article></div>"]
    df = spark.createDataFrame([(i, f"http://h{i}.example.com/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
    assert got == {i: "The story itself." for i in range(len(pages))}
