"""Helpers that the operators of this subpackage share: tables, stored steps, and batches of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilematch.llm import hashing as H
from profilematch.session import materialize, shuffle_cleanup

SLICE_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer if ``df`` has a column called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files are dropped at once."""
    with shuffle_cleanup(df.sparkSession):
        return materialize(df, label)


def row_key(text: str = "text"):
    """Two rows with one doc_id are told apart by their texts; rows equal in both have equal results."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about ``limit`` bytes of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and where each text starts (one more entry at the end)."""
    column = pc.fill_null(pc.cast(column, pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


APART = np.ones(256, bool)
APART[128:] = False
APART[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = False


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and the text of each: runs of letters and digits in lower case.

    Every character beyond ASCII counts as a letter.
    """
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, doc = H.word_spans(data, offsets, APART)
    return H.word_hashes(data, starts, ends), doc


def int_lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list array with ``counts[i]`` of ``values`` in row i."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)
