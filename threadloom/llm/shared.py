"""Helpers that several operators use inside tasks and on frames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A word is a run of bytes other than space and tab to carriage return. ``bytes.split()`` cuts at exactly these.
SPACE_CLASS = r"[\x20\x09-\x0D]"


_KEPT: dict[str, object] = {}


def kept_in_worker(key: str, make):
    """What ``make`` builds, kept in this Python worker for the next task of the same job."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that text operators need, under names of their own.

    Whatever else the table holds, clashing names included, is not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    at = batch.schema.get_field_index(column)
    return batch.column(at).cast(pa.binary()).to_pylist()


def pieces_of(batch: pa.RecordBatch, most_bytes: int = 2 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about this many text bytes at most; a longer text is a slice of its own.

    Keeps what a task holds at once independent of how long the texts are.
    """
    at = batch.schema.get_field_index(column)
    lengths = batch.column(at).cast(pa.binary())
    sizes = pa.compute.binary_length(lengths).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        size = 0 if size is None or size != size else int(size)
        if i > start and held + size > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
