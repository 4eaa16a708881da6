"""Phrase collocation mining after Toivonen.

A sample of the documents proposes phrases: it is mined level by level (words, pairs, triples) with a lowered
threshold. Full passes then count every proposed phrase and the negative border: a phrase is counted where the
phrases without its last and without its first word are both proposed. If a border phrase turns out frequent, it joins
the proposed ones and a further pass counts what that adds, until no border phrase fails. Every frequent phrase has
frequent parts, so then none is missed, whatever the sample.

Most of the border is rare. The first full pass therefore counts hashes: the count of a hash is never below that of
a phrase with it. Phrases are spelled out and counted exactly in the second pass, and only where their hash reached the threshold.

Proposed phrases are looked up in a Bloom filter of fixed size; a phrase that it lets pass by mistake is
counted in vain and changes no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, ByteType, LongType, StringType, StructField, StructType

from reviewlake.llm.batches import column, cut

MAX_WORDS = 4
#: Share of the documents that proposes phrases; a proposed phrase reaches this share of its part of the threshold there.
SAMPLE, LOWERED = 0.2, 0.6
#: Bits of a filter of phrases; every task holds up to three of them (8 MB each).
FILTER_BITS = 1 << 26
#: Tokens counted together within a task (local word numbers must fit 21 bits).
SLICE_TOKENS = 600_000
#: Hashes of slices that a task counts together before they are exchanged.
MERGED_HASHES = 800_000
#: Bits of a hash that are kept: a collision only lets a rare phrase be spelled out in vain.
HASH_BITS = 40
#: Hashes are exchanged by their first bits, in so many parts of a power of two; a task merges one part at a time.
PART_BITS = 10
#: Longer texts are cut into parts of about so many bytes; no phrase is lost at a cut.
PART_BYTES = 1_000_000

#: Bytes as the words see them: A-Z lower-cased, what ends a piece is a full stop, what ends a word a space.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_BREAK = re.compile(rb"[ .]")
_SPREAD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
_COUNTS = StructType([StructField("lang", StringType()), StructField("k", ByteType()), StructField("phrase", StringType()), StructField("h", LongType()),
                      StructField("f", LongType())])
#: The slices as they are kept, packed: word numbers (16 bits each where they fit, ``_NONE`` for what ends a piece), where a phrase may start, the words.
_SLICES = StructType([StructField("pick", BooleanType()), StructField("size", LongType()), StructField("w", BinaryType()), StructField("starts", BinaryType()),
                      StructField("words", BinaryType()), StructField("lang_of", BinaryType()), StructField("langs", ArrayType(StringType()))])
_SLICE_TYPES = [pa.bool_(), pa.int64(), *[pa.binary()] * 4, pa.list_(pa.string())]
_NONE = 65535
_PACKED = StructType([StructField("part", LongType()), StructField("hashes", BinaryType())])
_HASHES = StructType([StructField("h", LongType()), StructField("f", LongType())])
_DROPPED, _LOW = np.uint64(64 - HASH_BITS), np.uint64(HASH_BITS - PART_BITS)


class _Words(dict):
    """Word of one language -> number in the slice; -1 for what ends a piece."""

    def __init__(self, lang: str, words: list[bytes], langs: list[str]):
        super().__init__({b".": -1})
        self.lang, self.words, self.langs = lang, words, langs

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return number


def _tokens(text: bytes) -> list[bytes]:
    return text.replace(b".", b" . ").split()


def _parts(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """(tokens, how many of them may start a phrase): parts of a text, each with the next part's first tokens."""
    text = text.translate(_BYTES)
    if len(text) <= PART_BYTES:
        tokens = _tokens(text)
        yield tokens, len(tokens)
        return
    held, at = [], 0
    while at < len(text):
        end = _BREAK.search(text, min(at + PART_BYTES, len(text)))
        stop = end.start() if end else len(text)
        tokens = _tokens(text[at:stop])
        at = stop
        if not held or len(tokens) < MAX_WORDS:
            held += tokens
            continue
        yield held + tokens[:MAX_WORDS - 1], len(held)
        held = tokens
    yield held, len(held)


def _mix(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (state ^ word) * _SPREAD[0]
    return x ^ (x >> np.uint64(29))


def _places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """The filter bits of a hash, by those of its bits that are kept."""
    shift = np.uint64(64 - (bits.bit_length() - 1))
    h = (h >> _DROPPED) << _DROPPED
    return [(h * s) >> shift for s in _SPREAD]


def _within(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    found = np.zeros(len(h), bool)
    left = np.arange(len(h))
    for p in _places(h, len(table) * 64):
        p = p[left]
        left = left[(table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1]
    found[left] = True
    return found


def _touches(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether any bit of a hash is set."""
    found = np.zeros(len(h), bool)
    for p in _places(h, len(table) * 64):
        found |= (table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return found


def _seed(lang: str) -> int:
    """Seed of the hashes of a language's words."""
    return xxhash.xxh3_64_intdigest(lang.encode())


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


def _planes(numbers: np.ndarray) -> bytes:
    """All low bytes, then all next ones: numbers in this order pack better."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _of_planes(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


class _Slice:
    """The tokens of one slice as an array, and the words with their hashes."""

    def __init__(self, items: list, words: list[bytes], langs: list[str]):
        self.size = sum(len(ids) + 1 for ids, _ in items)
        w, starts, at = np.full(self.size + MAX_WORDS, -1, np.int64), np.zeros(self.size, bool), 0
        for ids, n in items:
            w[at:at + len(ids)] = ids
            starts[at:at + n] = True
            at += len(ids) + 1
        self.w, self.starts = w, starts & (w[:self.size] >= 0)
        self.names = list(dict.fromkeys(langs))
        number = {g: i for i, g in enumerate(self.names)}
        self.spelling, self.of = words, np.fromiter(map(number.__getitem__, langs), np.int32, len(langs))

    def row(self, pick: bool) -> pa.RecordBatch:
        """The slice as a row of ``_SLICES``."""
        short = len(self.spelling) < _NONE  # such a slice's word numbers fit 16 bits
        ids = np.where(self.w[:self.size] < 0, _NONE, self.w[:self.size]).astype(np.uint16) if short else self.w[:self.size].astype(np.int32)
        values = [pick, self.size, *map(_packed, (_planes(ids), np.packbits(self.starts).tobytes(), b" ".join(self.spelling), self.of.tobytes())), self.names]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _SLICE_TYPES, strict=True)], names=_SLICES.names)

    @classmethod
    def of_row(cls, row: dict) -> _Slice:
        part = cls.__new__(cls)
        w, starts, words, of = (_unpacked(row[c]) for c in ("w", "starts", "words", "lang_of"))
        part.size, part.names, part.of = row["size"], row["langs"], np.frombuffer(of, np.int32)
        part.spelling = words.split(b" ") if words else []
        part.w = np.full(part.size + MAX_WORDS, -1, np.int64)
        if len(part.spelling) < _NONE:
            ids = _of_planes(w, np.uint16)
            part.w[:part.size] = np.where(ids == _NONE, -1, ids.astype(np.int64))
        else:
            part.w[:part.size] = _of_planes(w, np.int32)
        part.starts = np.unpackbits(np.frombuffer(starts, np.uint8), count=part.size).astype(bool)
        return part

    @cached_property
    def hashes(self) -> np.ndarray:
        seeds = [_seed(g) for g in self.names]
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.spelling, map(seeds.__getitem__, self.of.tolist())), np.uint64, len(self.spelling))

    @cached_property
    def words(self) -> pa.Array:
        return pa.array(self.spelling, pa.binary()).cast(pa.string())

    @cached_property
    def langs(self) -> pa.Array:
        return pa.array(self.names, pa.string()).take(pa.array(self.of))

    def places(self, levels: tuple[int, ...], table, old) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, places, hashes) of the phrases of ``levels`` words to be counted: both parts in ``table`` and not both in ``old``."""
        size, w = self.size, self.w
        whole = w >= 0
        hw = np.zeros(len(w), np.uint64)
        hw[whole] = self.hashes[w[whole]]
        h = hw
        if 1 in levels:
            at = np.flatnonzero(self.starts)
            yield 1, at, h[at]
        fresh = None if old is None else table & ~old
        for k in range(2, max(levels) + 1):
            part = np.zeros(len(whole), bool)  # where a phrase of k - 1 words is asked for; with ``old``, newly
            test = (lambda x: _within(x, table)) if old is None else (lambda x: _touches(x, fresh))
            part[whole] = test(self.hashes)[w[whole]] if k == 2 else test(h[whole])  # each word of the slice is tested once
            both = part[:-1] & part[1:] if old is None else part[:-1] | part[1:]
            shorter = h
            h = _mix(h[:-1], hw[k - 1:])
            whole = whole[:-1] & (w[k - 1:] >= 0)
            if k in levels:
                at = np.flatnonzero(both[:size] & whole[:size] & self.starts)
                if old is not None:  # few are left: a part that touches fresh bits is asked for only if all its bits are set
                    one, two = shorter[at], shorter[at + 1]
                    at = at[_within(one, table) & _within(two, table)]
                yield k, at, h[at]

    def spelled(self, k: int, at: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        """Exact counts of the k-word phrases at the given places; equal words have equal numbers, so no hash decides."""
        w = self.w
        if k < 4:
            code = w[at]
            for j in range(1, k):
                code = (code << 21) | w[at + j]
        else:
            _, both = np.unique(np.concatenate([(w[at] << 21) | w[at + 1], (w[at + 2] << 21) | w[at + 3]]), return_inverse=True)
            code = (both[:len(at)] << 31) | both[len(at):]
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        place = at[first]
        parts = [self.words.take(pa.array(w[place + j])) for j in range(k)]
        phrase = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, " ")
        return pa.RecordBatch.from_arrays([self.langs.take(pa.array(w[place])), pa.array(np.full(len(place), k, np.int8)), phrase,
                                           pa.array(h[first].view(np.int64)), pa.array(n)], names=_COUNTS.names)

    def totals(self) -> pa.RecordBatch:
        """The number of words per language, as rows with k = 0."""
        n = np.bincount(self.w[:self.size][self.starts], minlength=len(self.words))
        per = pa.table({"lang": self.langs, "f": pa.array(n)}).group_by("lang").aggregate([("f", "sum")])
        return pa.RecordBatch.from_arrays([per["lang"].combine_chunks(), pa.array(np.zeros(len(per), np.int8)), pa.array([""] * len(per)),
                                           pa.array(np.zeros(len(per), np.int64)), per["f_sum"].combine_chunks()], names=_COUNTS.names)


class _Gathered:
    """Texts that are gathered to slices."""

    def __init__(self):
        self.words, self.langs, self.vocab, self.items, self.held = [], [], {}, [], 0

    def add(self, lang: str, tokens: list[bytes], n: int) -> None:
        if lang not in self.vocab:
            self.vocab[lang] = _Words(lang, self.words, self.langs)
        self.items.append((np.fromiter(map(self.vocab[lang].__getitem__, tokens), np.int64, len(tokens)), n))
        self.held += len(tokens)

    def slice(self) -> _Slice:
        return _Slice(self.items, self.words, self.langs)


def _sliced(docs: DataFrame) -> DataFrame:
    """The slices of ``docs`` (pick, lang, text), written once, so that each pass reads word numbers; picked texts have slices of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = {True: _Gathered(), False: _Gathered()}
        for b in batches:
            for pick, lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()), strict=True):
                for tokens, n in _parts(text.as_py() or b""):
                    open_[pick].add(lang, tokens, n)
                    if open_[pick].held >= SLICE_TOKENS:
                        yield open_[pick].slice().row(pick)
                        open_[pick] = _Gathered()
        for pick, rest in open_.items():
            if rest.held:
                yield rest.slice().row(pick)

    return cut(docs.select("pick", "lang", "text").mapInArrow(run, _SLICES))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Slice]:
    for b in batches:
        for i in range(b.num_rows):
            yield _Slice.of_row({name: b.column(j)[i].as_py() for j, name in enumerate(b.schema.names)})


def _table(bits) -> np.ndarray | None:
    return None if bits is None else np.frombuffer(bits.value, np.uint64)


def _packed_parts(values: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Sorted hashes (``HASH_BITS`` each) and their counts as rows of ``_PACKED``: steps from hash to hash, then the counts."""
    parts, starts = np.unique(values >> _LOW, return_index=True)
    low = (values & ((np.uint64(1) << _LOW) - np.uint64(1))).astype(np.uint32)
    steps = np.diff(low, prepend=np.uint32(0))
    steps[starts] = low[starts]
    blobs = [_packed(_planes(steps[i:j]) + _planes(n[i:j])) for i, j in zip(starts, [*starts[1:], len(values)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int64)), pa.array(blobs, pa.binary())], names=_PACKED.names)


def _of_packed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = _unpacked(blob)
    size = len(data) // 12
    return _of_planes(data[:4 * size], np.uint32).astype(np.uint64).cumsum(), _of_planes(data[4 * size:], np.int64)


def _hash_counts(docs: DataFrame, levels: tuple[int, ...], bits, least: int) -> DataFrame:
    """(h, f): the hashes that at least ``least`` phrases share among those of ``levels`` words that ``bits`` asks for, over ``docs`` (slices).

    Slices are counted in the tasks, ``MERGED_HASHES`` hashes together, and exchanged packed, sorted by hash: about a third of the bytes of plain rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = _table(bits), []

        def merged() -> pa.RecordBatch:
            values, at = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n for _, n in held]))
            held.clear()
            return _packed_parts(values, n.astype(np.int64))

        for part in _slices(batches):
            for _, _, h in part.places(levels, table, None):
                held.append(np.unique(h >> _DROPPED, return_counts=True))
            if sum(len(v) for v, _ in held) >= MERGED_HASHES:
                yield merged()
        if held:
            yield merged()

    def summed(rows: pa.Table) -> pa.Table:
        first = np.uint64(rows["part"][0].as_py()) << _LOW
        values, n = map(np.concatenate, zip(*(_of_packed(x.as_py()) for x in rows["hashes"]), strict=True))
        order = np.argsort(values, kind="stable")
        values = values[order]
        starts = np.flatnonzero(np.diff(values, prepend=values[:1] + np.uint64(1)))
        f = np.add.reduceat(n[order], starts)
        enough = f >= least
        h = ((values[starts[enough]] | first) << _DROPPED).view(np.int64)
        return pa.table({"h": pa.array(h), "f": pa.array(f[enough])})

    return docs.mapInArrow(run, _PACKED).groupBy("part").applyInArrow(summed, _HASHES)


def _counts(docs: DataFrame, bits, old, wanted) -> DataFrame:
    """Exact counts (lang, k, phrase, f) of the phrases that ``bits`` asks for beyond ``old``, and of those of ``old`` whose hash is in ``wanted``.

    With ``wanted`` this counts words too, and k = 0 the words of a language. Hashes are not exchanged; see ``_hashed``.
    """
    schema = StructType([f for f in _COUNTS if f.name != "h"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, before, hashes = _table(bits), _table(old), _table(wanted)
        for part in _slices(batches):
            if hashes is not None:
                yield part.totals()
                for k, at, h in part.places(tuple(range(1, MAX_WORDS + 1)), before, None):
                    some = _within(h, hashes)
                    yield part.spelled(k, at[some], h[some])
            if (table != before).any():
                for k, at, h in part.places(tuple(range(2, MAX_WORDS + 1)), table, before):
                    yield part.spelled(k, at, h)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (b.select(schema.names) for b in counted(batches))

    return docs.mapInArrow(run, schema).groupBy(*schema.names[:-1]).agg(F.sum("f").alias("f"))


def _hashed(known: DataFrame) -> DataFrame:
    """(h): the hashes, as ``_Slice.places`` gives them, of phrases (lang, k, phrase) of one word and more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seeds = {g: _seed(g) for g in b.column(0).unique().to_pylist()}
            langs = [seeds[g] for g in b.column(0).to_pylist()]
            k, words = b.column(1).to_numpy(), [p.split(b" ") for p in b.column(2).cast(pa.binary()).to_pylist()]
            h = np.zeros(b.num_rows, np.uint64)
            for j in range(MAX_WORDS):
                at = np.flatnonzero(k > j)
                word = np.fromiter((xxhash.xxh3_64_intdigest(words[i][j], langs[i]) for i in at), np.uint64, len(at))
                h[at] = _mix(h[at], word) if j else word
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return known.select("lang", "k", "phrase").mapInArrow(run, "h long")


def _filter_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """Filter of the column ``h``; as many numbers go to the driver whatever its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in _places(b.column(0).to_numpy().view(np.uint64), bits):
                yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64))], names=["place"])

    places = hashes.select("h").mapInArrow(run, "place long")
    one = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = places.select(F.expr("shiftright(place, 6)").alias("word"), one.alias("v"))
    empty = hashes.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("v"))
    found = words.unionByName(empty).groupBy("word").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[found["word"].to_numpy()] = found["v"].to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, min_count: int = 30, text_col: str = "text", lang_col: str = "lang", sample: float = SAMPLE,
                     filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, k, phrase, f): every phrase of 1 to 4 words that occurs at least ``min_count`` times in its language's texts.

    Texts are lower-cased in A-Z, split into pieces at ``.,;:!?`` and line breaks and into words at spaces and tabs;
    occurrences may overlap and lie within a piece. Rows with k = 0 hold the number of all words. A null text counts as
    empty, a null language as ``und``; repeated rows count each; other columns are ignored; an empty table gives an empty table.
    ``sample`` (0 to 1) only decides how much each pass counts. Counts are summed in tasks before the shuffle, so neither
    a frequent word nor a large language meets in one task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(column(lang_col).cast("string"), F.lit("und")).alias("lang"), column(text_col).cast("string").alias("text"))
    rows = _sliced(rows.withColumn("pick", F.rand(7) < sample if 0 < sample < 1 else F.lit(True)))
    share = rows.where("pick")
    least = max(2, int(min_count * sample * LOWERED))
    send = lambda table: spark.sparkContext.broadcast(table.tobytes())
    proposed = np.zeros(filter_bits >> 6, np.uint64)
    for k in range(1, MAX_WORDS):
        proposed = proposed | _filter_of(_hash_counts(share, (k,), send(proposed), least), filter_bits)
    old = send(proposed)
    hashed = cut(_hash_counts(rows, tuple(range(1, MAX_WORDS + 1)), old, min_count))
    wanted = _filter_of(hashed, filter_bits)
    grown, wanted, known = proposed | wanted, send(wanted), None  # a border phrase whose hash failed is proposed at once
    while True:
        bits = send(grown)
        found = cut(_counts(rows, bits, old, wanted).where((F.col("f") >= min_count) | (F.col("k") == 0)))
        known = found if known is None else known.unionByName(found)
        table, old, wanted = grown, bits, None
        grown = table | _filter_of(_hashed(found.where(F.col("k").between(1, MAX_WORDS - 1))), filter_bits)
        if (grown == table).all():
            return known


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, text_col: str = "text", lang_col: str = "lang", sample: float = SAMPLE,
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """Each language's ``top`` collocations: lang, rank, phrase, a, l, r, n, score.

    Candidates are the ``frequent_phrases`` of two words and more. A cut into two phrases that occur l and r times scores
    floor(2000000 a / (l + r)); a phrase's lowest-scoring cut counts, of equal ones that with the shortest first part. A
    phrase that lies inside a longer candidate with at least 80 % of its count is dropped. The order is score, then a, both
    descending, then the phrase's bytes. Nulls, repeats and empty tables as in ``frequent_phrases``.
    """
    known = frequent_phrases(docs, min_count, text_col, lang_col, sample, filter_bits)
    words = F.split("phrase", " ", -1)
    cands = known.where("k >= 2").withColumn("w", words)
    part = lambda a, b: F.concat_ws(" ", F.slice("w", a, b))
    cuts = cands.select("lang", "phrase", "k", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("k").cast("int") - 1)).alias("c")).select(
        "lang", "phrase", "a", "c", part(F.lit(1), F.col("c")).alias("left"), part(F.col("c") + 1, F.col("k") - F.col("c")).alias("right"))
    side = known.where(f"k between 1 and {MAX_WORDS - 1}")
    of = lambda name, count: side.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    scored = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    score = F.expr("cast(a as decimal(30, 0)) * 2000000 div (cast(l as decimal(30, 0)) + r)").cast("long")
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "c", "a", "l", "r")).alias("m")).select("lang", "phrase", "m.*")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k").cast("int") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("k").cast("int") - n + 1), lambda i: F.concat_ws(" ", F.slice("w", i, n)))))
    covers = cands.where("k >= 3").select("lang", F.col("f").alias("longer"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(covers, ["lang", "phrase"], "left").where("longer is null or cast(longer as decimal(30, 0)) * 100 < cast(a as decimal(30, 0)) * 80")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = known.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
