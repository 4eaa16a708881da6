"""Toxicity: a support vector machine on the gapped subsequence kernel with Nystroem landmarks.

Words (lower case, inner signs dropped, single spaced letters joined) are compared by their common
subsequences of ``ORDER`` letters, edges included, that span at most ``SPAN`` places; each place more than
``ORDER`` costs a factor ``DECAY``. So a word with an inserted or a missing letter stays near. A word's
features are its kernel values to landmark words, whitened (Nystroem); a sentence counts as its worst word.
The labels mark whole texts: training alternates between fitting the machine and choosing, in each toxic
text, the words that make its sentences toxic, against the words of the sentences of clean texts. The fitted
machine is linear in subsequences, so what scoring needs is one weight per subsequence; a text's score is
its worst sentence, calibrated on the training texts.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from reviewlake.llm.batches import column, map_texts, slices

ORDER, SPAN, DECAY = 4, 6, 0.5
#: log2 of the number of buckets that subsequences are hashed into.
BUCKET_BITS = 20
#: The bounded training sample: at most about so many texts of either label, none longer than this.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_MAX_CHARS = 600, 900, 8_000
LANDMARKS = 240
ROUNDS = 4
#: Clean words of a round: so many at random and as many of the highest value.
CLEAN_WORDS = 5_000
#: Bent copies of each toxic word in training, with an inserted letter.
VARIANTS = 3
THRESHOLD = 0.7
_PATTERNS = [(0, *rest) for rest in combinations(range(1, SPAN), ORDER - 1)]
_EDGE_OPEN, _EDGE_CLOSE = np.uint64(0x2), np.uint64(0x3)


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: 1 letter or mark, 2 white space, 3 sentence end, 4 line feed, 0 other; and lower case."""
    kind = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x32400):  # no letter is assigned beyond
        ch = chr(c)
        if unicodedata.category(ch)[0] in "LM":
            kind[c] = 1
            lower[c] = ord(ch.lower()[0])
        elif ch.isspace():
            kind[c] = 2
    kind[[ord(x) for x in ".!?。！？"]] = 3
    kind[ord("\n")] = 4
    return kind, lower


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


@dataclass(frozen=True)
class Words:
    """Distinct words as runs of one letter array; every word of the texts as (text, sentence, distinct word)."""

    letters: np.ndarray
    first: np.ndarray
    size: np.ndarray
    text: np.ndarray
    sentence: np.ndarray
    which: np.ndarray


def read_words(texts: list[str]) -> Words:
    kinds, lower = _classes()
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds[cp]
    space = (kind == 2) | (kind == 4)
    ends = (kind == 4) | ((kind == 3) & np.concatenate((space[1:], [True])))
    sentence_at = np.cumsum(ends) - ends
    seen = np.flatnonzero((kind == 1) | space)  # signs inside a word are passed over
    is_letter = kind[seen] == 1
    opens = np.flatnonzero(is_letter & ~np.concatenate(([False], is_letter[:-1])))
    closes = np.flatnonzero(is_letter & ~np.concatenate((is_letter[1:], [False]))) + 1
    at = seen[opens]
    size = closes - opens
    sentence = sentence_at[at]
    single = size == 1
    joined = np.zeros(len(opens), bool)  # three or more single letters in a row are one word
    if len(opens) > 2:
        mid = single[1:-1] & single[:-2] & single[2:] & (sentence[1:-1] == sentence[:-2]) & (sentence[1:-1] == sentence[2:])
        joined[1:-1] |= mid
        joined[2:] |= mid
    letters = lower[cp[seen[is_letter]]].astype(np.uint64)
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    heads = np.flatnonzero(~joined)
    first, at, sentence = first[heads], at[heads], sentence[heads]
    size = np.diff(np.concatenate((first, [len(letters)])))
    if not len(first):
        none = np.zeros(0, np.int64)
        return Words(letters, none, none, none, none, none)
    place = np.arange(len(letters)) - np.repeat(first, size)
    h = np.add.reduceat(_mix((letters + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), first)
    _, example, which = np.unique(h, return_index=True, return_inverse=True)
    return Words(letters, first[example], size[example], np.searchsorted(begins, at, side="right") - 1, sentence, which)


def _by_pattern(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word, bucket, weight) of the gapped subsequences of the distinct words, pattern by pattern."""
    n = len(words.first)
    size = words.size + 2
    first = np.concatenate(([0], np.cumsum(size)))
    total = int(first[-1])
    owner = np.repeat(np.arange(n), size)
    place = np.arange(total) - first[owner]
    left = size[owner] - place
    x = np.zeros(total, np.uint64)
    inner = (place > 0) & (left > 1)
    x[inner] = words.letters[words.first[owner[inner]] + place[inner] - 1]
    x[place == 0] = _EDGE_OPEN
    x[left == 1] = _EDGE_CLOSE
    for pattern in _PATTERNS:
        at = np.flatnonzero(left > pattern[-1])
        h = np.zeros(len(at), np.uint64)
        for p in pattern:
            h = (h + x[at + p]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        yield owner[at], (_mix(h) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), DECAY ** (pattern[-1] + 1 - ORDER)


def subsequences(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, bucket, value) of all gapped subsequences; values have norm 1 per word."""
    parts = [(w, b, np.full(len(w), v, np.float32)) for w, b, v in _by_pattern(words)]
    who, bucket, value = (np.concatenate([p[i] for p in parts]) for i in range(3))
    norm = np.sqrt(np.bincount(who, value * value, minlength=len(words.first)))
    return who, bucket, value / np.maximum(norm, 1e-9)[who].astype(np.float32)


@dataclass(frozen=True)
class ToxicityModel:
    """``weights``: one per subsequence bucket; ``bias`` of a sentence; ``slope`` and ``shift`` of the calibration."""

    weights: np.ndarray = field(repr=False)
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0


def word_values(model: ToxicityModel, words: Words) -> np.ndarray:
    """Value of each distinct word."""
    n = len(words.first)
    sums, norm = np.zeros(n), np.zeros(n)
    for who, bucket, v in _by_pattern(words):
        sums += v * np.bincount(who, model.weights[bucket], minlength=n)
        norm += v * v * np.bincount(who, minlength=n)
    return sums / np.sqrt(np.maximum(norm, 1e-18)) + model.bias


def worst_sentences(model: ToxicityModel, texts: list[str]) -> np.ndarray:
    """The highest sentence value of each text, a sentence being its worst word; without a word, the bias."""
    words = read_words(texts)
    worst = np.full(len(texts), -np.inf)
    if len(words.first):
        g = word_values(model, words)
        begin = np.flatnonzero(np.concatenate(([True], words.sentence[1:] != words.sentence[:-1])))
        np.maximum.at(worst, words.text[begin], np.maximum.reduceat(g[words.which], begin))
    return np.where(np.isfinite(worst), worst, model.bias)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 4.0, steps: int = 25) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    active = None
    for _ in range(steps):
        now = y * (z @ w) < 1
        if active is not None and (now == active).all():
            break
        active = now
        a, t = z[now], weight[now]
        w = np.linalg.solve(ridge + c * (a * t[:, None]).T @ a, c * (a * t[:, None]).T @ y[now])
    return w[:-1], float(w[-1])


def _calibrate(worst: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, balanced between the labels, by Newton steps."""
    z = np.stack([worst, np.ones(len(worst))], axis=1)
    t = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (t * (p - (y > 0))) + 1e-4 * w
        step = np.linalg.solve((z * (t * p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(2), grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _pick(words: Words, chosen: np.ndarray) -> Words:
    """Some of the distinct words."""
    none = np.zeros(0, np.int64)
    return Words(words.letters, words.first[chosen], words.size[chosen], none, none, none)


def _bent(words: Words, chosen: np.ndarray) -> Words:
    """VARIANTS copies of each word with a letter put in: a strange one, or its neighbour again."""
    letters, sizes = [], []
    for u in chosen:
        w = words.letters[words.first[u]:words.first[u] + words.size[u]]
        for i in range(VARIANTS):
            at = 1 + (len(w) - 1) * (i + 1) // (VARIANTS + 1)
            letters.append(np.insert(w, min(at, len(w)), np.uint64(ord("x")) if i % 2 else w[min(at, len(w) - 1)]))
            sizes.append(len(w) + 1)
    size = np.array(sizes, np.int64)
    none = np.zeros(0, np.int64)
    return Words(np.concatenate(letters) if letters else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(size)))[:-1].astype(np.int64), size, none, none, none)


def fit(texts: list[str], toxic: list[int]) -> ToxicityModel:
    """Fits the machine on labelled texts; with only one label present every text scores that label."""
    y_text = np.where(np.array(toxic, np.int64) > 0, 1, -1)
    flat = ToxicityModel(np.zeros(1 << BUCKET_BITS, np.float32), 0.0, 1.0, -9.0 if not len(y_text) or y_text.max() < 0 else 9.0)
    if not len(y_text) or y_text.min() == y_text.max():
        return flat
    words = read_words(texts)
    if not len(words.first):
        return flat
    n, buckets = len(words.first), 1 << BUCKET_BITS
    who, bucket, value = subsequences(words)
    pairs = np.unique(np.stack((words.text, words.which)), axis=1)
    is_toxic = y_text[pairs[0]] > 0
    in_toxic, in_clean = np.bincount(pairs[1][is_toxic], minlength=n), np.bincount(pairs[1][~is_toxic], minlength=n)
    clean_total, toxic_total = (y_text < 0).sum(), (y_text > 0).sum()
    # how much more often a word's subsequences stand in toxic texts
    hot = (np.bincount(bucket, in_toxic[who], buckets) + 0.5) / (toxic_total + 1)
    cold = (np.bincount(bucket, in_clean[who], buckets) + 0.5) / (clean_total + 1)
    gain = np.bincount(who, value * value * np.log(hot / cold)[bucket], minlength=n)
    gain = np.where(in_clean == 0, gain, -np.inf)
    rng = np.random.default_rng(7)
    leaders = np.argsort(-gain, kind="stable")[:LANDMARKS // 2]
    others = np.setdiff1d(np.arange(n), leaders)
    marks = np.concatenate((leaders, np.sort(rng.permutation(others)[:LANDMARKS - len(leaders)])))
    number = np.full(n, -1)
    number[marks] = np.arange(len(marks))
    of_mark = number[who] >= 0
    used, column_of = np.unique(bucket[of_mark], return_inverse=True)
    psi = np.zeros((len(used), len(marks)), np.float32)  # the landmarks' subsequences
    np.add.at(psi, (column_of, number[who[of_mark]]), value[of_mark])

    def kernel(of: Words) -> np.ndarray:
        """Kernel of distinct words to the landmarks."""
        w, f, v = subsequences(of)
        slot = np.minimum(np.searchsorted(used, f), len(used) - 1)
        hit = np.flatnonzero(used[slot] == f)
        hit = hit[np.argsort(w[hit], kind="stable")]
        out = np.zeros((len(of.first), len(marks)), np.float32)
        for lo in range(0, len(hit), 100_000):
            part = hit[lo:lo + 100_000]
            begin = np.flatnonzero(np.concatenate(([True], np.diff(w[part]) != 0)))
            np.add.at(out, w[part][begin], np.add.reduceat(psi[slot[part]] * v[part][:, None], begin, axis=0))
        return out

    eig, vec = np.linalg.eigh(kernel(_pick(words, marks)).astype(np.float64))
    kept = eig > 1e-3 * eig.max()
    whiten = vec[:, kept] / np.sqrt(eig[kept])
    clean_words = np.flatnonzero(in_clean > 0)
    values, weights, b = gain, np.zeros(buckets, np.float32), 0.0
    toxic_pairs = pairs[:, is_toxic & (in_clean[pairs[1]] == 0)]
    for step in range(ROUNDS):
        # a toxic text's words on the toxic side, and its highest one in any case
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, toxic_pairs[0], values[toxic_pairs[1]])
        v = values[toxic_pairs[1]]
        witness = np.unique(toxic_pairs[1][(v >= top[toxic_pairs[0]]) | ((v > 0) & (step > 0))])
        hard = clean_words[np.argsort(-values[clean_words], kind="stable")[:CLEAN_WORDS]] if step else clean_words[:0]
        negative = np.union1d(hard, rng.permutation(clean_words)[:CLEAN_WORDS])
        bent = _bent(words, witness)
        x = np.concatenate([kernel(w) for w in (_pick(words, witness), bent, _pick(words, negative))]).astype(np.float64) @ whiten
        y = np.concatenate((np.ones(len(witness) + len(bent.first)), -np.ones(len(negative))))
        weight = np.concatenate((in_toxic[witness], np.repeat(in_toxic[witness], VARIANTS) * (0.3 / VARIANTS), np.ones(len(negative))))
        weight = np.where(y > 0, weight / max(1.0, weight[y > 0].sum()), 1.0 / max(1, len(negative))) * len(y) / 2
        w, b = _svm(x, y, weight)
        weights[used] = psi @ (whiten @ w).astype(np.float32)
        values = np.bincount(who, weights[bucket] * value, minlength=n) + b
    model = ToxicityModel(weights, b)
    slope, shift = _calibrate(np.concatenate([worst_sentences(model, part) for _, part in slices(texts)]), y_text)
    return ToxicityModel(weights, b, slope, shift)


def train_toxicity(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
                   toxic_rows: int = TRAIN_TOXIC, clean_rows: int = TRAIN_CLEAN, max_chars: int = TRAIN_MAX_CHARS) -> ToxicityModel:
    """Fits on a bounded sample: about ``toxic_rows`` and ``clean_rows`` labelled texts of at most ``max_chars``
    characters, chosen by a hash of the id. Null texts, ids and labels teach nothing."""
    marked = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    sizes = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    shares = {1: min(1.0, toxic_rows / max(1, sizes.get(1, 0))), 0: min(1.0, clean_rows / max(1, sizes.get(0, 0)))}
    place = F.pmod(F.xxhash64(F.lit("toxicity sample"), "id"), F.lit(1_000_000))
    chosen = marked.where(place < F.when(F.col("y") == 1, shares[1]).otherwise(shares[0]) * 1_000_000).distinct()
    # the same hash thins the texts before they meet the labels, so the join moves about a sample
    texts = docs.select(column(id_col).cast(marked.schema["id"].dataType).alias("id"), column(text_col).cast("string").alias("t"))
    texts = texts.where((place < max(shares.values()) * 1_000_000) & (F.length("t") <= max_chars) & F.col("id").isNotNull())
    rows = sorted((r["t"], r["y"]) for r in texts.join(chosen, "id").select("t", "y").collect())
    return fit([t for t, _ in rows], [y for _, y in rows])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: list[str] | None = None,
                   threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``score`` (0 to 1, the calibrated value of the worst sentence) and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored; a null or empty text, or one without a letter, gets the score of no words.
    Equal texts get equal scores. Input columns named like an output give way to it. No shuffle.
    """
    out = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: the buckets

    def setup():
        m = shared.value

        def run(texts: list) -> list:
            worst = np.concatenate([worst_sentences(m, part) for _, part in slices(texts)]) if texts else np.zeros(0)
            score = 1 / (1 + np.exp(-np.clip(m.slope * worst + m.shift, -500, 500)))
            return [pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))]

        return run

    return map_texts(docs, text_col, setup, out, keep)
