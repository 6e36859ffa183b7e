"""Suffix-array dedup on bytes: maximal repeats from the common-prefix intervals of an enhanced suffix array.

A byte goes when a WIDTH-byte string over it also starts anywhere else, in the same text or another; matches never
cross texts. Strings meet in the bucket of their minimiser (segments.py). A string that is alone in its bucket has no
repeats, or is repeated whole if it occurs twice. Buckets with different strings get a suffix array with common-prefix
lengths, by prefix doubling over whole arrays; strings without any repeated window are left out before. A stack scan
visits the common-prefix intervals (the inner nodes of the suffix tree); one of WIDTH or more whose occurrences have
different bytes on their left is a maximal repeat, and all its occurrences are given, not just neighbours.

Null texts are empty; texts under WIDTH bytes never change. Repeated rows are copies of each other, so both lose what
they share. Null doc_ids are allowed; extra columns are kept. Repeats are maximal within the strings that meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.llm import hashing as H
from profilematch.llm.common import free_name, slices, stored, text_bytes
from profilematch.llm.segments import Kind, Strings, covered, hot_routes, marks_of, segments_of, spans_of

WIDTH = 400
KIND = Kind(width=WIDTH, gram=32, words=False, slice_bytes=1 << 20, group_bytes=2 << 20)
FIRST = 7  # bytes that fit into one 63-bit number, 9 bits each


def suffix_array(data: np.ndarray, ends: np.ndarray, candidates: np.ndarray):
    """The candidates in the order of their suffixes, and the common prefix of each with the one before it.

    ``ends[i]`` is where the text of position i ends; suffixes stop there. Prefix doubling: the rank by 2k bytes is
    the rank of a pair of ranks by k bytes.
    """
    n = len(data)
    at = np.arange(n)
    key = np.zeros(n, np.int64)
    for k in range(FIRST):
        there = at + k
        inside = there < ends
        key = (key << 9) | np.where(inside, data[np.minimum(there, n - 1)].astype(np.int64) + 1, 0)
    ranks = [np.unique(key, return_inverse=True)[1].astype(np.int32)]
    reach, longest = FIRST, int((ends - at).max())
    while reach < longest and ranks[-1].max() + 1 < n:
        r = ranks[-1].astype(np.int64)
        there = at + reach
        second = np.where(there < ends, r[np.minimum(there, n - 1)] + 1, 0)
        ranks.append(np.unique(r * (n + 1) + second, return_inverse=True)[1].astype(np.int32))
        reach *= 2
    order = candidates[np.argsort(ranks[-1][candidates], kind="stable")]
    i, j = order[:-1].copy(), order[1:].copy()
    room = np.minimum(ends[i] - i, ends[j] - j)
    lcp = np.zeros(len(i), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        a, b = np.minimum(i + lcp, n - 1), np.minimum(j + lcp, n - 1)
        same = (lcp < room) & (ranks[level][a] == ranks[level][b])
        lcp = np.where(same, np.minimum(lcp + (FIRST << level), room), lcp)
    for _ in range(FIRST - 1):
        a, b = np.minimum(i + lcp, n - 1), np.minimum(j + lcp, n - 1)
        lcp += (lcp < room) & (data[a] == data[b])
    return order, np.concatenate([[0], lcp])


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(first, last, length) in the suffix array of each repeat of ``least`` or more that can't be extended.

    ``left[i]`` is the byte before suffix i, or a number of its own at the start of a string. The stack holds open
    intervals as [length, first, left byte], the last being -1 once its occurrences have different ones.
    """
    out: list[tuple[int, int, int]] = []
    deep = lcp >= least
    starts = np.flatnonzero(deep & ~np.concatenate([[False], deep[:-1]])) - 1
    stops = np.flatnonzero(deep & ~np.concatenate([deep[1:], [False]]))
    for lo, hi in zip(starts.tolist(), stops.tolist()):
        lengths, lefts = lcp[lo : hi + 1].tolist(), left[lo : hi + 1].tolist()
        stack: list[list[int]] = []
        before = lefts[0]
        for k in range(1, len(lengths) + 1):
            length = lengths[k] if k < len(lengths) else 0
            first, seen = k - 1, before
            while stack and stack[-1][0] > length:
                ended, first, own = stack.pop()
                own = own if own == seen else -1
                if own == -1:
                    out.append((lo + first, lo + k - 1, ended))
                seen = own
            if k == len(lengths):
                break
            if stack and stack[-1][0] == length:
                if stack[-1][2] != seen:
                    stack[-1][2] = -1
            else:
                stack.append([length, first, seen])
            before = lefts[k]
    return out


def _repeated(s: Strings, data, offsets, row) -> np.ndarray:
    """Strings with a window that occurs twice among these, by fingerprint; only these go into the suffix array."""
    n = len(data) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    windows = H.window_hashes(H.BYTE_VALUES[data], WIDTH)
    at = np.flatnonzero(row[:n] == row[WIDTH - 1 :])
    order = np.argsort(windows[at], kind="stable")
    same = windows[at[order]][1:] == windows[at[order]][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.unique(row[at[twice]])


def _bucket(s: Strings):
    """Windows that start twice or more; single hot windows have no text here."""
    alone = np.asarray(s.packed.is_null())
    data, offsets = text_bytes(s.packed)
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - WIDTH + 1, 0)
    several = np.zeros(len(sizes), bool)
    several[1:] = s.route[1:] == s.route[:-1]
    several[:-1] |= s.route[1:] == s.route[:-1]
    whole = np.flatnonzero(s.n > 1)
    rows, firsts, lasts = [whole], [np.zeros(len(whole), np.int64)], [np.where(alone, 1, windows)[whole]]
    ask = np.flatnonzero(~alone & (several | s.twice))
    if len(ask):
        packed = s.packed.take(pa.array(ask))
        data, offsets = text_bytes(packed)
        row = np.repeat(np.arange(len(ask)), np.diff(offsets))
        found = _repeated(s, data, offsets, row)
        r, a, b = _scan(packed, found)
        keep = s.n[ask[r]] == 1
        rows.append(ask[r[keep]])
        firsts.append(a[keep])
        lasts.append(b[keep])
    row, a, b = np.concatenate(rows), np.concatenate(firsts), np.concatenate(lasts)
    return row, a, b, np.full(len(row), -1, np.int64)


def _scan(packed: pa.Array, found: np.ndarray):
    """Ranges of windows (string, first, after last) under the maximal repeats of the strings ``found``."""
    none = np.zeros(0, np.int64)
    if not len(found):
        return none, none, none
    data, offsets = text_bytes(packed.take(pa.array(found)))
    row = np.repeat(np.arange(len(found)), np.diff(offsets))
    ends = offsets[1:][row]
    at = np.arange(len(data))
    order, lcp = suffix_array(data, ends, at[ends - at >= WIDTH])
    begins = order == offsets[row[order]]
    left = np.where(begins, 256 + order, data[np.maximum(order - 1, 0)])
    best = np.zeros(len(order), np.int64)
    for first, last, length in maximal_repeats(lcp, left, WIDTH):
        np.maximum(best[first : last + 1], length, out=best[first : last + 1])
    hit = np.flatnonzero(best)
    if not len(hit):
        return none, none, none
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, order[hit], 1)
    np.add.at(change, order[hit] + best[hit] - WIDTH + 1, -1)
    inside = np.cumsum(change[:-1]) > 0
    starts, stops, text = H.word_spans((~inside).astype(np.uint8), offsets, np.array([False, True]))
    return found[text], starts - offsets[text], stops - offsets[text]


_OUT = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()),
    T.StructField("kept", T.BinaryType()),
]


def _remove(columns: list[str], spans_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                size, gone, runs, kept = [], [], [], []
                for text, spans in zip(part.column("text").to_pylist(), part.column(spans_name).to_pylist()):
                    raw = (text or "").encode()
                    size.append(len(raw))
                    if spans:
                        drop = covered(spans, len(raw), WIDTH)
                        gone.append(int(drop.sum()))
                        runs.append(int(drop[0]) + int((drop[1:] & ~drop[:-1]).sum()))
                        raw = np.frombuffer(raw, np.uint8)[~drop].tobytes()
                    else:
                        gone.append(0)
                        runs.append(0)
                    kept.append(raw)
                new = [pa.array(x, pa.int64()) for x in (size, gone, runs)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in columns], *new, pa.array(kept, pa.binary())],
                    [*columns, *[f.name for f in _OUT]],
                )

    return run


def _row(docs: DataFrame):
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def dedup_bytes(docs: DataFrame, min_hot: int | None = None) -> DataFrame:
    """``docs`` (without columns named like the new ones) with n_bytes, n_removed, n_spans and kept (bytes)."""
    docs = docs.drop(*[f.name for f in _OUT])
    keyed = docs.where(F.col("text").isNotNull()).select(F.lit(0).cast("long").alias("who"), _row(docs).alias("row"), "text")
    hot = hot_routes(keyed, KIND, **({} if min_hot is None else {"least": min_hot}))
    marks = stored(marks_of(segments_of(keyed, KIND, hot), KIND, _bucket), "windows")
    key, own = free_name(docs, "__row"), free_name(docs, "__spans")
    spans = spans_of(keyed, KIND, hot, marks).select(F.col("row").alias(key), F.col("spans").alias(own))
    joined = docs.join(spans, _row(docs) == F.col(key), "left").drop(key)
    return joined.mapInArrow(_remove(docs.columns, own), T.StructType([*docs.schema.fields, *_OUT]))
