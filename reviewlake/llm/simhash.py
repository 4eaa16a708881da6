"""SimHash near duplicates: Golay-code fuzzy keys find fingerprints within a few bits, links join into groups.

The 64-bit fingerprint is cut into three segments of at most 23 bits. The perfect binary Golay code maps
every 23-bit word to one of 4096 codewords; the codewords of a word and of its one-bit neighbours are its
keys (one or six of them). Two words at most two bits apart have a neighbour in common and so share a key.
With at most ``MAX_BITS`` = 4 differing bits, the two least damaged segments hold at most two of them
together, so the pair of their keys meets. Fingerprints that share a pair of keys are verified by
distance; verified links become groups by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from reviewlake.llm.batches import column, cut, map_texts
from reviewlake.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: First bit and width of each segment.
SEGMENTS = [(0, 22), (22, 21), (43, 21)]
#: Runs of equal keys longer than this are compared in blocks of this size by separate tasks.
RUN_LIMIT = 65_536
#: Runs up to this length are compared by shifted arrays, longer ones by breadth-first search.
_SHORT_RUN = 48
#: Generator polynomial of the (23, 12) Golay code (a fixed value).
_GENERATOR = 0xC75


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text: bit i is set where over half of its shingles' XXH64 values have it."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = list(accumulate(len(p) + 1 for p in parts))
    starts = [0, *ends[:-1]]
    if len(parts) <= words:
        pieces = [(0, len(line))]
    else:
        pieces = zip(starts, [e - 1 for e in ends[words - 1:]], strict=False)
    xx = xxhash.xxh64_intdigest
    h = np.array([xx(line[a:b], SEED) for a, b in pieces], np.uint64)
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 16_384):
        total += np.unpackbits(h[i:i + 16_384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "simhash", words: int = SHINGLE_WORDS,
                 keep: list[str] | None = None) -> DataFrame:
    """Adds the fingerprint as a signed long. A null, empty or all-space text has fingerprint 0. No shuffle."""

    def setup():
        return lambda texts: [pa.array(np.array([fingerprint_of(t, words) for t in texts], np.uint64).view(np.int64))]

    return map_texts(docs, text_col, setup, [StructField(out, LongType())], keep)


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of data words (shifted by 11) and the error pattern of each remainder, by the polynomial."""

    def remainder(v: int) -> int:
        for bit in range(22, 10, -1):
            if v >> bit & 1:
                v ^= _GENERATOR << (bit - 11)
        return v

    parity = np.array([remainder(d << 11) for d in range(4096)], np.uint32)
    errors = np.zeros(2048, np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            errors[remainder(e)] = e
    return parity, errors


def codeword_index(v: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the codeword within three bits of each 23-bit word."""
    parity, errors = _golay()
    data = v >> np.uint32(11)
    return data ^ (errors[parity[data] ^ (v & np.uint32(0x7FF))] >> np.uint32(11))


def segment_keys(v: np.ndarray, width: int) -> np.ndarray:
    """Distinct codeword indices of each word and its one-bit neighbours: six columns, -1 where there are fewer."""
    near = [codeword_index(v)] + [codeword_index(v ^ np.uint32(1 << b)) for b in range(width)]
    keys = np.sort(np.stack(near, axis=1).astype(np.int32), axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    rank = np.cumsum(new, axis=1) - 1
    out = np.full((len(v), max(6, int(rank.max(initial=0)) + 1)), -1, np.int32)
    out[np.arange(len(v))[:, None], rank] = keys
    return out


def pair_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row of ``fps``): all keys of two segments together, at most 108 per fingerprint."""
    keys = [segment_keys(((fps >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.uint32), width) for at, width in SEGMENTS]
    found, rows = [], []
    for p, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        a, b = keys[i][:, :, None], keys[j][:, None, :]
        both = np.where((a >= 0) & (b >= 0), (p << 24) | (a << 12) | b, -1).reshape(len(fps), -1)
        at = np.nonzero(both >= 0)
        found.append(both[at])
        rows.append(at[0])
    return np.concatenate(found).astype(np.int32), np.concatenate(rows)


def _stars(fps: np.ndarray, bits: int, others: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, int]]:
    """(members, seed) of each linked set of at least two; with ``others``, only links across the two count."""
    left = fps if others is None else np.concatenate((fps, others))
    side = np.zeros(len(left), np.int8)
    side[len(fps):] = 1
    while len(left):
        seed, queue, members = left[0], [(left[0], side[0])], []
        left, side = left[1:], side[1:]
        while queue:
            x, s = queue.pop()
            near = np.bitwise_count(left ^ x) <= bits
            if others is not None:
                near &= side != s
            if near.any():
                members.append(left[near])
                queue.extend(zip(left[near], side[near], strict=True))
                left, side = left[~near], side[~near]
        if members:
            yield np.concatenate(members), seed


def _run_links(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the runs of equal keys (sorted): verified pairs of short runs, stars of long ones."""
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    lens = np.diff(np.concatenate((begins, [len(keys)])))
    a, b = [], []
    short = np.repeat(lens <= _SHORT_RUN, lens)
    ks, fs = keys[short], fps[short]
    for d in range(1, int(min(lens[lens <= _SHORT_RUN].max(initial=0), len(ks)))):
        at = np.flatnonzero(ks[d:] == ks[:-d])
        at = at[np.bitwise_count(fs[at] ^ fs[at + d]) <= bits]
        a.append(fs[at + d])
        b.append(fs[at])
    for i, n in zip(begins[lens > _SHORT_RUN], lens[lens > _SHORT_RUN], strict=True):
        for members, seed in _stars(fps[i:i + n], bits):
            a.append(members)
            b.append(np.full(len(members), seed, np.uint64))
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, b = np.concatenate(a), np.concatenate(b)
    if len(a):
        a, b = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b)), axis=1), axis=0).T
    return a, b


def fingerprint_links(distinct: DataFrame, col: str = "simhash", bits: int = MAX_BITS, run_limit: int = RUN_LIMIT) -> DataFrame:
    """Links (a, b) between different fingerprints that join all pairs at most ``bits`` (up to 4) apart.

    ``distinct`` holds each fingerprint once. Keys are dealt by hash and sorted; a run of equal keys is
    read as a stream. Within a run only as many links are kept as join its groups (a star each), so a
    dense group of m gives fewer than m rows, not m squared. A run beyond ``run_limit`` is cut into blocks,
    and pairs of blocks go to separate tasks: nothing is dropped and no task holds more than two blocks.
    """
    if not 0 <= bits <= 4:
        raise ValueError("the keys meet for up to 4 differing bits")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fps), 4096):
                part = fps[i:i + 4096]
                keys, rows = pair_keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows].view(np.int64))], names=["key", "fp"])

    def rows(kind: int, key: np.ndarray | int, block: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, key, np.int32)), pa.array(np.full(n, block, np.int32)),
             pa.array(np.ascontiguousarray(a).view(np.int64)), pa.array(np.ascontiguousarray(b).view(np.int64))], names=["kind", "key", "block", "a", "b"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_f = np.zeros(0, np.int32), np.zeros(0, np.uint64)
        key, block = None, 0  # the run that is being handed on in blocks, and its next block
        for batch in _then_none(batches):
            if batch is not None:
                rest_k = np.concatenate((rest_k, batch.column(0).to_numpy(zero_copy_only=False)))
                rest_f = np.concatenate((rest_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if not len(rest_k):
                continue
            whole = len(rest_k) if batch is None else int(np.searchsorted(rest_k, rest_k[-1]))  # the last run may go on
            if whole:
                if rest_k[0] == key:
                    end = int(np.searchsorted(rest_k[:whole], key, side="right"))
                    yield rows(1, key, block + 1, rest_f[:end], rest_f[:end])
                key = None
                yield rows(0, 0, 0, *_run_links(rest_k[:whole], rest_f[:whole], bits))
                rest_k, rest_f = rest_k[whole:], rest_f[whole:]
            while batch is not None and len(rest_k) >= run_limit:  # all of one run
                key, block = (key, block + 1) if rest_k[0] == key else (rest_k[0], 0)
                yield rows(1, key, block, rest_f[:run_limit], rest_f[:run_limit])
                yield rows(0, 0, 0, *_run_links(rest_k[:run_limit], rest_f[:run_limit], bits))
                rest_k, rest_f = rest_k[run_limit:], rest_f[run_limit:]

    # up to 108 keys come of a fingerprint, so they are dealt evenly first; a given number of partitions is not merged
    width = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.select(column(col).alias("fp")).repartition(width, "fp").mapInArrow(emit, "key int, fp long")
    found = cut(keyed.repartition("key").sortWithinPartitions("key", "fp")
                .mapInArrow(link, "kind int, key int, block int, a long, b long").distinct())
    links = found.where("kind = 0").select("a", "b")
    blocks = found.where("kind = 1").select("key", "block", F.col("a").alias("fp"))
    if blocks.isEmpty():
        return links

    counts = blocks.groupBy("key").agg(F.max("block").alias("last"))
    pairs = (blocks.join(counts, "key").withColumn("other", F.explode(F.sequence(F.lit(0), "last"))).where("other <> block")
             .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     (F.col("block") < F.col("other")).alias("low"), "fp"))

    def across(group):
        import pandas as pd

        low, high = (np.ascontiguousarray(group.loc[group["low"] == x, "fp"].to_numpy(np.int64)).view(np.uint64) for x in (True, False))
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for members, seed in _stars(low, bits, high):
            a.append(members)
            b.append(np.full(len(members), seed, np.uint64))
        return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    return links.unionByName(pairs.groupBy("key", "i", "j").applyInPandas(across, "a long, b long"))


def _then_none(items: Iterator) -> Iterator:
    yield from items
    yield None


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = SHINGLE_WORDS,
                    bits: int = MAX_BITS) -> DataFrame:
    """(id, simhash, component): one row per document, ``component`` the least id that links reach.

    Texts of equal fingerprint are one group from the start (pre-aggregated by Spark), so copies never
    meet as pairs. Null, empty and all-space texts share fingerprint 0 and link like any other. Rows with
    equal ids are separate rows of the result; a null id never becomes a component unless all of the
    group's ids are null. Other columns are ignored.
    """
    rows = cut(fingerprints(docs.select(column(id_col).alias("id"), column(text_col).alias("text")), "text", words=words, keep=["id"]))
    # a fingerprint's node is ordered by its least id, so a component's least node names the component
    nodes = rows.groupBy("simhash").agg(F.min("id").alias("least")).withColumn("node", F.struct(F.col("least").isNull().alias("none"), "least", "simhash"))
    nodes = cut(nodes)
    end = lambda name: nodes.select(F.col("simhash").alias(name), F.col("node").alias(f"{name}_node"))
    links = fingerprint_links(nodes, "simhash", bits).join(end("a"), "a").join(end("b"), "b")
    roots = components(links.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))
    moved = roots.select(F.col("node.simhash").alias("simhash"), F.col("root.least").alias("reached"), F.lit(True).alias("linked"))
    by_print = nodes.join(moved, "simhash", "left").select("simhash", F.when(F.col("linked"), F.col("reached")).otherwise(F.col("least")).alias("component"))
    return rows.join(by_print, "simhash").select("id", "simhash", "component")
