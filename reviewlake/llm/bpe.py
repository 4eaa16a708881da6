"""Byte-level BPE through a sentencepiece model that is serialised from the rank file.

Every rank becomes a piece: its bytes written as one printable character each, scored by the negative rank,
so that sentencepiece joins the pair of lowest rank first, leftmost first, as the ranks ask for. The model
has an identity normaliser and no dummy prefix. Texts are split by the tokenizer's pattern and each
distinct match is encoded by itself; decoding looks up the bytes of each id.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from reviewlake.llm.batches import map_texts, slices

#: Encoded matches that a task remembers; beyond it the memory starts afresh, with the same results.
CACHE_ENTRIES = 400_000


def byte_characters() -> str:
    """A printable character for each byte: itself where Latin-1 prints it, else one from U+0100 on."""
    shown = [b for r in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(r[0], r[1] + 1)]
    table, free = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in table:
            table[b] = chr(free)
            free += 1
    return "".join(table[b] for b in range(256))


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank per line) by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def _part(number: int, payload: bytes) -> bytes:
    """A length-delimited field of a protocol buffer message."""
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _flag(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece i is the token of rank i; the unknown piece comes behind them.

    Bytes that are no token of their own get a piece at the end (never joined, as their score is least).
    """
    chars = byte_characters()
    table = {b: c for b, c in enumerate(chars)}

    def piece(text: str, score: float, kind: int | None = None) -> bytes:
        body = _part(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score)
        return _part(1, body + (_flag(3, kind) if kind else b""))

    model = [piece("".join(table[b] for b in t), -float(i)) for i, t in enumerate(tokens)]
    model.append(piece("<unk>", 0.0, 2))
    have = set(tokens)
    model += [piece(table[b], -float(len(tokens) + b)) for b in range(256) if bytes([b]) not in have]
    trainer = _flag(3, 2) + _flag(4, len(model)) + _flag(35, 0) + _flag(40, len(tokens))  # model type BPE, size, no byte fallback, unknown id
    plain = _part(1, b"identity") + _flag(3, 0) + _flag(4, 0) + _flag(5, 0)  # no prefix, spaces as they are
    return b"".join(model) + _part(2, trainer) + _part(3, plain)


class ByteBpe:
    """Encoder and decoder for one rank file: texts in, ids as little-endian unsigned 32-bit integers out."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        import regex
        import sentencepiece

        self._tokens = tokens
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        self._split = regex.compile(pattern).findall
        self._chars = str.maketrans({b: c for b, c in enumerate(byte_characters())})
        self._whole = {t: i for i, t in enumerate(tokens)}
        self._memory: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        """Encodes matches that are not remembered; one that is a token by itself is that token."""
        rest = []
        for p in pieces:
            rank = self._whole.get(p.encode("utf-8"))
            if rank is None:
                rest.append(p)
            else:
                self._memory[p] = struct.pack("<I", rank)
        mapped = [p.encode("utf-8").decode("latin-1").translate(self._chars) for p in rest]
        for p, ids in zip(rest, self._model.encode(mapped, num_threads=1), strict=True):
            self._memory[p] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._split(t) for t in texts]
        memory = self._memory
        new = set().union(*split).difference(memory)
        if len(memory) + len(new) > CACHE_ENTRIES:
            memory.clear()
            new = set().union(*split)
        self._learn(list(new))
        return [b"".join([memory[p] for p in pieces]) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        tokens = self._tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def tokenizer(path: str, pattern: str) -> Callable[[], ByteBpe]:
    """A maker of the encoder for a rank file that every executor has at ``path``."""
    return lambda: ByteBpe(read_ranks(path), pattern)


def encode_texts(docs: DataFrame, make: Callable[[], ByteBpe], text_col: str = "text", keep: list[str] | None = None,
                 with_ids: bool = True) -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (of the bytes decoded from the ids) and, unless
    ``with_ids`` is off, ``ids`` (binary, little-endian unsigned 32-bit integers).

    The whole text is encoded; null counts as empty: no tokens, digests of nothing. Special tokens do not
    exist: their strings are ordinary text. Equal texts give equal rows. Input columns named like an
    output give way to it. No shuffle.
    """
    out = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    out += [StructField("ids", BinaryType())] if with_ids else []

    def setup():
        bpe = make()

        def run(texts: list) -> list:
            counts, digests, decoded, all_ids = [], [], [], []
            for ids in (x for _, part in slices(texts) for x in bpe.encode(part)):
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            arrays = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            return arrays + ([pa.array(all_ids, pa.binary())] if with_ids else [])

        return run

    return map_texts(docs, text_col, setup, out, keep)


def decode_ids(rows: DataFrame, make: Callable[[], ByteBpe], ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Adds the text decoded from ``ids_col`` (binary as made by ``encode_texts``); null gives an empty text.

    Bytes that are no UTF-8 (ids cut inside a character) become replacement characters.
    """
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def decode(batches):
        import pandas as pd

        bpe = make()
        return pd.Series([bpe.decode(b or b"").decode("utf-8", "replace") for b in batches])

    return rows.withColumn(out, decode(F.col(ids_col)))
