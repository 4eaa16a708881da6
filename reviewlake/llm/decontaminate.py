"""Benchmark decontamination: CGK walks turn edit distance into Hamming distance, bit sampling finds the windows.

Texts are read as words (lower case, runs of letters, marks and digits). The CGK embedding of a window is a
walk: at step j it outputs the word under its pointer, and a random bit of that word for step j says whether
the pointer moves on. Both walks of an edited pair fall into step again soon after an edit, so a small edit
distance gives a small Hamming distance between the outputs. Every word position of every text starts a
window; ``SAMPLES`` keys of ``SAMPLE_STEPS`` sampled outputs are taken from each of ``WALKS`` walks, and each
benchmark item is entered under the keys of its own window and of the windows of its later starts. Short items
are entered by pieces, one of which stands unchanged in every match (pigeonhole). A meeting
is verified by the exact word edit distance between the item and the best-fitting stretch of the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from reviewlake.llm.batches import column, map_texts, slices

#: An item is found where a stretch of the text is at most this share of the item's words away from it.
MAX_EDIT_SHARE = 0.2
#: Independent walks, keys taken from each, sampled steps in a key. With the starts below these reach a
#: measured recall above 0.95 at one edit in ten words and 0.9 at ``MAX_EDIT_SHARE`` (README).
WALKS, SAMPLES, SAMPLE_STEPS = 2, 6, 6
#: Steps of a walk; a pointer moves at every second step on average.
STEPS = 24
#: An item's window starts: its first word and every such many words further, while a walk still fits.
START_STRIDE = 2
#: Words that a walk reads at least; the last start of an item leaves it so many.
MIN_WALK_WORDS = STEPS // 2
#: Items up to so many words are cut into one piece more than edits are allowed: a piece stands unchanged in every match.
EXACT_WORDS = 20
#: At most so many benchmark words are held in memory and sent to the tasks at once; more items go in further blocks.
BLOCK_WORDS = 2_000_000
_SEED = 0x5EED
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 2 ** 64))


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it belongs to a word, and its lower case."""
    inside = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x32400):  # no letter, mark or digit that texts use is assigned beyond
        if unicodedata.category(chr(c))[0] in "LMN":
            inside[c] = True
            lower[c] = ord(chr(c).lower()[0])
    return inside, lower


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE, np.uint64))))
        down = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, _INVERSE, np.uint64))))
    return up, down


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, start, end) of every word of the texts, in order."""
    inside, lower = _classes()
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    word = inside[cp]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    edge = np.concatenate(([0], edge)) if len(word) and word[0] else edge
    s, e = edge[::2], edge[1::2]  # the closing line feed ends the last word
    up, down = _powers(1 << max(1, len(cp) - 1).bit_length())
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((lower[cp].astype(np.uint64) + np.uint64(1)) * up[:len(cp)], dtype=np.uint64)))
    h = _mix((sums[e] - sums[s]) * down[s]) | np.uint64(1)  # 0 is the end of a text
    row = np.searchsorted(begins, s, side="right") - 1
    return h, row, s - begins[row], e - begins[row]


def walk_keys(line: np.ndarray, starts: np.ndarray, seed: int = _SEED) -> Iterator[np.ndarray]:
    """One array of keys per (walk, sample): the sampled outputs of the walk from each start in ``line``.

    ``line`` holds word hashes with a 0 behind each text (and at its very end): a walk stays there.
    """
    for w in range(WALKS):
        rng = np.random.default_rng([seed, w])
        turn = _mix(line ^ np.uint64(rng.integers(1, 2 ** 63)))  # bit j of a word's turn: its move at step j
        turn = np.where(line == 0, np.uint64(0), turn).astype(np.uint32)
        picks = [rng.permutation(STEPS)[:SAMPLE_STEPS] for _ in range(SAMPLES)]
        salts = rng.integers(1, 2 ** 63, size=(SAMPLES, STEPS)).astype(np.uint64) | np.uint64(1)
        p = starts.astype(np.int32)
        acc = [np.full(len(starts), np.uint64(w * SAMPLES + k)) for k in range(SAMPLES)]
        for j in range(STEPS):
            uses = [k for k in range(SAMPLES) if j in picks[k]]
            if uses:
                out = line[p]
                for k in uses:
                    acc[k] += out * salts[k, j]
            p += ((turn[p] >> np.uint32(j)) & np.uint32(1)).view(np.int32)
        for k in range(SAMPLES):
            yield _mix(acc[k])


def edit_match(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, first word, end word) of the stretch of ``text`` nearest to ``item`` if at most ``most``
    word edits away; the least edits win, then the longest stretch that ends first."""
    n = len(text)
    cost = np.zeros(n + 1, np.int64)
    began = np.arange(n + 1, dtype=np.int64)
    steps = np.arange(n + 1, dtype=np.int64)
    for i, x in enumerate(item, 1):
        up = cost + 1
        diag = np.concatenate(([i], cost[:-1] + (text != x)))
        take = diag <= up
        best = np.where(take, diag, up)
        from_ = np.where(take, np.concatenate(([0], began[:-1])), began)
        # a run of text words without partner costs one each: a running minimum over cost minus place
        low = np.minimum.accumulate(best - steps)
        src = np.maximum.accumulate(np.where(best - steps == low, steps, 0))
        began = from_[src]
        cost = low + steps
    end = int(cost.argmin())
    return (int(cost[end]), int(began[end]), end) if cost[end] <= most else None


@dataclass(frozen=True)
class BenchmarkIndex:
    """Keys of a block of items. ``order``: key -> (item, start) pairs, by position in ``keys``."""

    ids: list
    words: list = field(repr=False)
    keys: np.ndarray = field(repr=False)
    item: np.ndarray = field(repr=False)
    start: np.ndarray = field(repr=False)
    sieve: np.ndarray = field(repr=False)
    short: dict = field(repr=False)


def _allowed(n: int) -> int:
    return int(MAX_EDIT_SHARE * n + 1e-9)


def _sequence_key(h: np.ndarray) -> int:
    acc = np.zeros(1, np.uint64)
    for x in h:
        acc = _mix(acc * _ODD + x)
    return int(acc[0])


def index_items(items: list[tuple]) -> BenchmarkIndex:
    """Index of (id, text) items; items without a word are left out."""
    ids, words, keys, numbers, starts, short = [], [], [], [], [], {}
    for item_id, text in items:
        h = word_hashes([text or ""])[0]
        if not len(h):
            continue
        ids.append(item_id)
        words.append(h)
        number = len(ids) - 1
        if len(h) <= EXACT_WORDS:
            cuts = np.linspace(0, len(h), _allowed(len(h)) + 2).astype(int)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                short.setdefault(int(b - a), {}).setdefault(_sequence_key(h[a:b]), []).append((number, int(a)))
            continue
        at = np.arange(0, len(h) - MIN_WALK_WORDS + 1, START_STRIDE)
        for k in walk_keys(np.append(h, np.uint64(0)), at):
            keys.append(k)
            numbers.append(np.full(len(at), number))
            starts.append(at)
    keys, numbers, starts = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.uint64), (numbers, np.int64), (starts, np.int64)))
    order = np.argsort(keys, kind="stable")
    sieve = np.zeros(1 << 22, bool)
    sieve[(keys >> np.uint64(42)).astype(np.int64)] = True
    return BenchmarkIndex(ids, words, keys[order], numbers[order], starts[order], sieve, short)


def _find(index: BenchmarkIndex, texts: list[str]) -> list[tuple]:
    """(text number, item number, edits, first code point, end code point) of every verified match."""
    h, row, start, end = word_hashes(texts)
    if not len(h):
        return []
    words_in = np.bincount(row, minlength=len(texts))
    stop = np.cumsum(words_in)
    place = np.arange(len(h)) + row  # in a line with a 0 behind each text
    line = np.zeros(len(h) + len(texts), np.uint64)
    line[place] = h
    pairs = []
    if len(index.keys):
        for lo in range(0, len(h), 65_536):  # small arrays stay in the cache
            at = np.arange(lo, min(lo + 65_536, len(h)))
            first = place[lo]
            for keys in walk_keys(np.append(line[first:place[at[-1]] + STEPS + 1], np.uint64(0)), place[at] - first):
                hit = np.flatnonzero(index.sieve[(keys >> np.uint64(42)).astype(np.int64)])
                if not len(hit):
                    continue
                a, b = np.searchsorted(index.keys, keys[hit], "left"), np.searchsorted(index.keys, keys[hit], "right")
                n = b - a
                if n.any():
                    which = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    pairs.append(np.stack((at[np.repeat(hit, n)] - index.start[which], index.item[which])))
    for n, table in index.short.items():  # the pieces of short items, word for word
        if len(h) >= n:
            acc = np.zeros(len(h) - n + 1, np.uint64)
            for j in range(n):
                acc = _mix(acc * _ODD + h[j:len(h) - n + 1 + j])
            same = row[:len(acc)] == row[n - 1:]
            hits = [(i - a, item) for i in np.flatnonzero(same & np.isin(acc, np.fromiter(table, np.uint64, len(table)))).tolist() for item, a in table[int(acc[i])]]
            if hits:
                pairs.append(np.array(hits, np.int64).T)
    found = []
    if pairs:
        p = np.unique(np.concatenate(pairs, axis=1), axis=1)
        owner = np.searchsorted(stop, np.clip(p[0], 0, len(h) - 1), side="right")
        done: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for begin, item, doc in zip(p[0], p[1], owner, strict=True):
            x = index.words[item]
            slack = _allowed(len(x))
            for d in {int(doc), int(np.searchsorted(stop, min(begin + len(x) // 2, len(h) - 1), side="right"))}:
                lo, hi = max(begin - slack, stop[d] - words_in[d]), min(begin + len(x) + 2 * slack, stop[d])
                if hi <= lo or any(u <= lo and hi <= v for u, v in done.get((d, int(item)), ())):
                    continue
                lo2, hi2 = max(lo - slack, stop[d] - words_in[d]), min(hi + slack, stop[d])
                done.setdefault((d, int(item)), []).append((lo2, hi2))
                around = set(h[lo2:hi2].tolist())
                if sum(w in around for w in x.tolist()) < len(x) - slack:  # each word without a like one costs an edit
                    continue
                m = edit_match(x, h[lo2:hi2], slack)
                if m and m[2] > m[1]:
                    found.append((d, int(item), m[0], int(start[lo2 + m[1]]), int(end[lo2 + m[2] - 1])))
    best: dict[tuple, tuple] = {}
    for f in found:
        key = (f[0], f[1])
        if key not in best or (f[2], f[3]) < (best[key][2], best[key][3]):
            best[key] = f
    return list(best.values())


def _blocks(benchmark: DataFrame, text_col: str, id_col: str) -> Iterator[list[tuple]]:
    """The items in blocks of about ``BLOCK_WORDS`` words: the size is summed first, so that each is bounded."""
    rows = benchmark.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text")).where("text is not null")
    words = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(words) // (5 * BLOCK_WORDS)))
    for i in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == i) if blocks > 1 else rows
        yield sorted(((r["id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0], x[1]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                       item_id: str = "item_id", item_text: str = "text", out: str = "leaks") -> DataFrame:
    """Adds ``leaks``: array of (item_id, edits, start, end) of the benchmark items that stand in the text,
    up to ``MAX_EDIT_SHARE`` word edits; one entry per item (the fewest edits, then the first place),
    by item id; code points, end exclusive.

    The benchmark is the query set: it is read in blocks of bounded size and every text is searched
    for all blocks, with no shuffle. Items that are null or have no word are never found; items
    up to ``EXACT_WORDS`` words are found in every text that holds them within the limit; a null or empty text has no leaks. Items of equal text are all
    reported. An input column named like the output gives way to it.
    """
    id_type = benchmark.select(column(item_id)).schema[0].dataType
    leak = StructType([StructField("item_id", id_type), StructField("edits", IntegerType()), StructField("start", IntegerType()),
                       StructField("end", IntegerType())])
    spark, names = docs.sparkSession, []
    done = docs
    for block, items in enumerate(_blocks(benchmark, item_text, item_id)):
        shared = spark.sparkContext.broadcast(index_items(items))

        def setup(shared=shared):
            index = shared.value

            def find(texts: list) -> list:
                rows: list[list] = [[] for _ in texts]
                for base, part in slices(texts):
                    for d, item, edits, a, b in _find(index, part):
                        rows[base + d].append((index.ids[item], edits, a, b))
                entries = [dict(zip(("item_id", "edits", "start", "end"), x, strict=True)) for r in rows for x in sorted(r, key=lambda y: (y[0] is None, y[0], y[2]))]
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in rows]))), pa.int32())
                return [pa.ListArray.from_arrays(offsets, pa.array(entries, arrow_type))]

            return find

        from pyspark.sql.pandas.types import to_arrow_type

        arrow_type = to_arrow_type(leak)
        name = f"__leaks_{block}"
        done = map_texts(done, text_col, setup, [StructField(name, ArrayType(leak))], None if keep is None else [*keep, text_col, *names])
        names.append(name)
    kept = [c for c in done.columns if c not in names and c.lower() != out.lower() and (keep is None or c in keep)]
    return done.select(*[column(c) for c in kept], F.concat(*[column(n) for n in names]).alias(out))
