"""Shared helpers: Arrow batches of texts, names that do not clash, cutting lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from reviewlake.session import checkpoint_dir

#: Code points handled at once by the vectorised operators; bounds a task's memory, whatever the batch.
SLICE_CHARS = 500_000


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` that do not bear one of ``names`` (Spark resolves names without regard to case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(name: str):
    """The column of exactly this name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def map_texts(docs: DataFrame, text_col: str, setup: Callable[[], Callable[[list], list]],
              out: list[StructField], keep: list[str] | None = None) -> DataFrame:
    """Adds the columns ``out`` computed from ``text_col`` in Arrow batches, without a shuffle.

    ``setup()`` runs once per task and gives a function from a list of texts (None for null) to one
    Arrow array per output field. ``keep`` names the input columns that are kept (all by default);
    a kept column that bears an output's name gives way to the output.
    """
    names = [f.name for f in out]
    kept = [c for c in without(docs, names) if keep is None or c in keep]
    src = docs.select(*[column(c) for c in kept], column(text_col).cast("string").alias("__text"))
    schema = StructType([src.schema[i] for i in range(len(kept))] + out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = setup()
        for b in batches:
            arrays = fn(b.column(len(kept)).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(kept))] + arrays, names=kept + names)

    return src.mapInArrow(run, schema)


def slices(texts: list, limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) with about ``limit`` code points each; null counts as empty."""
    first, size, part = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if part and size + len(t) > limit:
            yield first, part
            first, size, part = i, 0, []
        part.append(t)
        size += len(t) + 1
    if part:
        yield first, part


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; later steps reread it and survive lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
