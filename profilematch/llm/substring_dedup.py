"""Substring dedup on words: super-k-mers travel to the bucket of their minimiser, where sorting finds equal windows.

A window is WIDTH consecutive words of one text. A word goes when a window over it also starts in a document with a
smaller doc_id; windows are judged on the input. In its bucket every window has a fingerprint of 128 bits; sorting
puts equal ones together, and the least doc_id of each decides. See segments.py for how strings travel.

Null texts have no words. A row with a null doc_id is neither changed nor a reason to change others. Rows with one
doc_id don't affect each other, repeated or not. Texts of under WIDTH words are never changed. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.llm import hashing as H
from profilematch.llm.common import free_name, row_key, slices, stored, text_bytes
from profilematch.llm.segments import Kind, Strings, covered, hot_routes, marks_of, segments_of, spans_of

WIDTH = 50
KIND = Kind(width=WIDTH, gram=4, words=True, levels=(8, 2))


def _bucket(s: Strings):
    """Windows that some document has after the first one; single hot windows have no text here."""
    alone = np.asarray(s.packed.is_null())
    single = np.flatnonzero(alone & (s.high > s.low))
    zero = np.zeros(len(single), np.int64)
    data, offsets = text_bytes(s.packed)
    starts, ends, row = H.word_spans(data, offsets)
    n = len(starts) - WIDTH + 1
    if n <= 0:
        return single, zero, zero + 1, s.low[single]
    w1 = H.window_hashes(H.word_hashes(data, starts, ends), WIDTH)
    w2 = H.window_hashes(H.word_hashes(data, starts, ends, H.BASES[1]), WIDTH, H.BASES[1])
    at = np.flatnonzero(row[:n] == row[WIDTH - 1 :])
    w1, w2, own = w1[at], w2[at], row[at]
    order = np.argsort(w1, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = (w1[order][1:] != w1[order][:-1]) | (w2[order][1:] != w2[order][:-1])
    least = np.empty(len(order), np.int64)
    begin = np.flatnonzero(new)
    least[order] = np.repeat(
        np.minimum.reduceat(s.low[own[order]], begin), np.diff(np.append(begin, len(order)))
    )
    later = s.high[own] > least
    hit = np.flatnonzero(later)
    if not len(hit):
        return single, zero, zero + 1, s.low[single]
    joins = (np.diff(hit) == 1) & (own[hit][1:] == own[hit][:-1]) & (least[hit][1:] == least[hit][:-1])
    first = hit[np.concatenate([[True], ~joins])]
    last = hit[np.concatenate([~joins, [True]])]
    base = np.searchsorted(row, np.arange(len(offsets) - 1))
    r = own[first]
    return (
        np.concatenate([r, single]),
        np.concatenate([at[first] - base[r], zero]),
        np.concatenate([at[last] - base[r] + 1, zero + 1]),
        np.concatenate([least[first], s.low[single]]),
    )


_OUT = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]


def _remove(columns: list[str], spans_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, gone, kept = [], [], []
                for text, spans in zip(part.column("text").to_pylist(), part.column(spans_name).to_pylist()):
                    own = (text or "").encode().split()
                    words.append(len(own))
                    if spans:
                        drop = covered(spans, len(own), WIDTH)
                        gone.append(int(drop.sum()))
                        own = [own[i] for i in np.flatnonzero(~drop)]
                    else:
                        gone.append(0)
                    kept.append(b" ".join(own).decode())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in columns], pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                    [*columns, *[f.name for f in _OUT]],
                )

    return run


def dedup_substrings(docs: DataFrame, min_hot: int | None = None) -> DataFrame:
    """``docs`` (without columns named like the new ones) with n_words, n_removed and kept_text."""
    docs = docs.drop(*[f.name for f in _OUT])
    keyed = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    keyed = keyed.select(F.col("doc_id").cast("long").alias("who"), row_key().alias("row"), "text")
    hot = hot_routes(keyed, KIND, **({} if min_hot is None else {"least": min_hot}))
    marks = stored(marks_of(segments_of(keyed, KIND, hot), KIND, _bucket), "windows")
    who, key, own = (free_name(docs, name) for name in ("__who", "__row", "__spans"))
    spans = spans_of(keyed, KIND, hot, marks).select(F.col("who").alias(who), F.col("row").alias(key), F.col("spans").alias(own))
    same = (F.col("doc_id") == F.col(who)) & (row_key() == F.col(key))
    joined = docs.join(spans, same, "left").drop(who, key)
    return joined.mapInArrow(_remove(docs.columns, own), T.StructType([*docs.schema.fields, *_OUT]))
