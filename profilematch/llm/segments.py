"""Super-strings: consecutive windows of a text that share a minimiser, and what becomes of their windows.

A window is ``width`` consecutive units (words or bytes). Its minimiser is the least hash of its ``gram``-unit
substrings. Equal windows have equal minimisers, so a run of consecutive windows with one minimiser can travel to the
minimiser's bucket as one string, and equal windows still meet. Three steps:

1. ``segments_of``: each distinct string of a slice of rows goes out once, with a count and the range of its documents.
2. A bucket function (the operator's own) says, per string, which of its windows are affected: ``marks``.
3. ``spans_of``: the occurrences of the strings, small rows without text, take over the marks.

A minimiser with so many strings that its bucket would outgrow a task (a passage that many documents share, each with
its own surroundings) is *hot*. Its windows are told apart by where the minimiser lies in them: those in which it lies
in one range of LEVELS[0] places have a common core, and its hash is their bucket. Runs of them still travel as one
string. A core that is hot as well (it ends where the surroundings begin) is split by ranges of LEVELS[1] places, and
only the few windows of a range that is still hot travel one by one, as fingerprints of 128 bits, to buckets of their
own. There are at most 16 hot minimisers for each shuffle partition, and as many hot cores of each level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.llm import hashing as H
from profilematch.llm.common import int_lists, slices, stored, text_bytes

U = np.uint64
POSITION = U(24)
MIN_HOT = 1024
#: who: what a mark is compared with (document id, or 0); row: which row of the table
KEYS = ["who", "row"]


@dataclass(frozen=True)
class Kind:
    width: int
    gram: int
    words: bool
    #: Bytes of text, and of strings in whole buckets, that are worked on at a time.
    slice_bytes: int = 2 << 20
    group_bytes: int = 4 << 20
    #: Places of the minimiser that share a core, for hot minimisers and for hot cores.
    levels: tuple[int, int] = (32, 4)


@dataclass(frozen=True)
class Hot:
    """What outgrows a bucket: minimisers, and cores of both levels."""

    values: np.ndarray
    cores: tuple[np.ndarray, np.ndarray]


NONE = Hot(np.zeros(0, U), (np.zeros(0, U), np.zeros(0, U)))


def _normal(column: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of the texts; words are set one space apart."""
    if not words:
        return text_bytes(column)
    parts = [b" ".join(t.encode().split()) if t else b"" for t in column.to_pylist()]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _units(data: np.ndarray, offsets: np.ndarray, words: bool):
    """Two hashes of each unit, the text of each unit, and where units begin and end."""
    if words:
        starts, ends, doc = H.word_spans(data, offsets)
        return H.word_hashes(data, starts, ends), H.word_hashes(data, starts, ends, H.BASES[1]), doc, starts, ends
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(data))
    values = H.BYTE_VALUES[data]
    return values, values, doc, at, at + 1


def fingerprints(h1: np.ndarray, h2: np.ndarray) -> pa.Array:
    both = np.stack([h1, h2], axis=1).astype("<u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(h1), [None, pa.py_buffer(both)]).cast(pa.binary())


def numbers_of(column: pa.Array) -> np.ndarray:
    """The two halves of each fingerprint."""
    data, _ = text_bytes(column)
    return data.view("<u8").reshape(-1, 2)


@dataclass
class Found:
    first: np.ndarray  # first window of each segment, as a unit number
    last: np.ndarray
    doc: np.ndarray
    route: np.ndarray
    h1: np.ndarray
    h2: np.ndarray
    twice: np.ndarray  # the minimiser may occur twice in the segment
    hot: np.ndarray  # a single window
    level: np.ndarray


def _cores(u1: np.ndarray, at: np.ndarray, place: np.ndarray, kind: Kind, level: int) -> np.ndarray:
    """The hash of the units that windows ``at`` share with all windows whose minimiser lies in the same range of places."""
    size = kind.levels[level]
    starts, which = np.unique(at + place % size, return_inverse=True)
    return (H.span_hashes(u1, starts, starts + kind.width - size + 1) ^ U(level + 1))[which] & U(2**63 - 1)


def find(u1: np.ndarray, u2: np.ndarray, doc: np.ndarray, kind: Kind, hot: Hot, only: int | None = None) -> Found:
    """Segments of the texts. ``only``: put all windows of hot minimisers on this level, to count."""
    n = len(u1) - kind.width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Found(none, none, none, *[none.astype(U)] * 3, none.astype(bool), none.astype(bool), none)
    grams = H.window_hashes(u1, kind.gram)
    keys = (grams >> POSITION << POSITION) | (np.arange(len(grams), dtype=U) & U((1 << 24) - 1))
    least = H.sliding_min(keys, kind.width - kind.gram + 1)
    value = least >> POSITION
    whole = doc[:n] == doc[kind.width - 1 :]
    route, level = value & U(2**63 - 1), np.zeros(n, np.int8)
    at = np.flatnonzero(np.isin(value, hot.values) & whole) if len(hot.values) else np.zeros(0, np.int64)
    breaks = np.ones(n, bool)
    breaks[1:] = (value[1:] != value[:-1]) | ~whole[:-1]
    if len(at):
        part = np.zeros(n, np.int64)
        # where the minimiser lies in the window; the low 24 bits tell it, as it is less than a window away
        place = (least[at].astype(np.int64) - at) & ((1 << 24) - 1)
        for deep in (1, 2):
            if only not in (None, deep):
                continue
            cores = _cores(u1, at, place, kind, deep - 1)
            route[at], level[at], part[at] = cores, deep, at + place % kind.levels[deep - 1]
            still = np.isin(cores, hot.cores[deep - 1])
            at, place = at[still], place[still]
        level[at], part[at] = (3, at) if only is None else (only, part[at])
        breaks[1:] |= (level[1:] != level[:-1]) | (part[1:] != part[:-1]) | ((level[1:] > 0) & (least[1:] != least[:-1]))
    first = np.flatnonzero(breaks & whole)
    ends = np.ones(n, bool)
    ends[:-1] = breaks[1:] | ~whole[1:]
    last = np.flatnonzero(ends & whole)
    h1 = H.span_hashes(u1, first, last + kind.width, H.BASES[0])
    h2 = H.span_hashes(u2, first, last + kind.width, H.BASES[1])
    single = level[first] == 3
    route = np.where(single, h1 & U(2**63 - 1), route[first])
    return Found(first, last, doc[first], route, h1, h2, least[first] != least[last], single, level[first])


def _once(found: Found) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal segments together, and where each group of them begins."""
    order = np.lexsort((found.h2, found.h1))
    a, b = found.h1[order], found.h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


_SEGMENTS = T.StructType(
    [
        T.StructField("route", T.LongType()),
        T.StructField("fp", T.BinaryType()),
        T.StructField("packed", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("twice", T.BooleanType()),
    ]
)


def segments_of(docs: DataFrame, kind: Kind, hot: Hot) -> DataFrame:
    """(route, fp, packed, n, low, high, twice): each distinct segment of a slice of rows; who ranges from low to high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", kind.slice_bytes):
                data, offsets = _normal(part.column("text"), kind.words)
                u1, u2, doc, starts, ends = _units(data, offsets, kind.words)
                found = find(u1, u2, doc, kind, hot)
                if not len(found.first):
                    continue
                order, begin = _once(found)
                who = np.asarray(part.column("who"))[found.doc[order]]
                pick = order[begin]
                raw = data.tobytes()
                spans = zip(starts[found.first[pick]], ends[found.last[pick] + kind.width - 1], found.hot[pick])
                packed = [None if h else raw[a:b] for a, b, h in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.route[pick].astype(np.int64)),
                        fingerprints(found.h1[pick], found.h2[pick]),
                        pa.array(packed, pa.binary()),
                        pa.array(np.diff(np.append(begin, len(order)))),
                        pa.array(np.minimum.reduceat(who, begin)),
                        pa.array(np.maximum.reduceat(who, begin)),
                        pa.array(found.twice[pick]),
                    ],
                    _SEGMENTS.names,
                )

    return docs.select("who", "text").mapInArrow(run, _SEGMENTS)


#: The route under which the number of all strings is counted.
ALL = -1


def _units_of(kind: Kind, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for part in slices(batch, "text", kind.slice_bytes):
            yield _units(*_normal(part.column("text"), kind.words), kind.words)[:3]


def hot_routes(docs: DataFrame, kind: Kind, least: int = MIN_HOT) -> Hot:
    """Minimisers and cores with more strings than a sixteenth of a shuffle partition's share (and ``least``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for units in _units_of(kind, batches):
            found = find(*units, kind, NONE)
            order, begin = _once(found)
            routes, n = np.unique(found.route[order[begin]].astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([ALL, *routes.tolist()]), pa.array([len(begin), *n.tolist()])], ["route", "n"])

    spark = docs.sparkSession
    counted = docs.select("text").mapInArrow(count, "route long, n long").groupBy("route").agg(F.sum("n").alias("n"))
    many = stored(counted.where((F.col("n") > least) | (F.col("route") == ALL)), "routes")
    total = many.where(F.col("route") == ALL).agg(F.max("n")).first()[0] or 0
    bound = max(least, total / (16 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    over = lambda df: np.array([r.route for r in df.where((F.col("n") > bound) & (F.col("route") != ALL)).collect()], dtype=U)
    values = over(many)
    if not len(values):
        return NONE
    hot = Hot(values, NONE.cores)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The strings of hot minimisers by their cores, of both levels."""
        for units in _units_of(kind, batches):
            for level in (1, 2):
                found = find(*units, kind, hot, level)
                order, begin = _once(found)
                pick = order[begin]
                pick = pick[found.level[pick] == level]
                columns = [pa.array(np.full(len(pick), level, np.int32)), pa.array(found.route[pick].astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*columns, fingerprints(found.h1[pick], found.h2[pick])], ["level", "route", "fp"])

    strings = docs.select("text").mapInArrow(split, "level int, route long, fp binary").distinct()
    cores = stored(strings.groupBy("level", "route").agg(F.count("*").alias("n")).where(F.col("n") > bound), "cores")
    return Hot(values, tuple(over(cores.where(F.col("level") == level)) for level in (1, 2)))


_MARK = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("who", T.LongType())])
_MARKS = T.StructType([T.StructField("fp", T.BinaryType()), T.StructField("marks", T.ArrayType(_MARK))])


@dataclass
class Strings:
    """Distinct strings of whole buckets, in the order of their buckets."""

    route: np.ndarray
    fp: np.ndarray
    n: np.ndarray
    low: np.ndarray
    high: np.ndarray
    twice: np.ndarray
    packed: pa.Array


def _strings(table: pa.Table) -> Strings:
    fp = numbers_of(table.column("fp").combine_chunks())
    route = np.asarray(table.column("route"))
    order = np.lexsort((fp[:, 1], fp[:, 0], route))
    f = fp[order]
    new = np.ones(len(order), bool)
    new[1:] = (f[1:] != f[:-1]).any(axis=1)
    begin = np.flatnonzero(new)
    value = lambda c: np.asarray(table.column(c))[order]
    return Strings(
        route[order[begin]],
        f[begin],
        np.add.reduceat(value("n"), begin),
        np.minimum.reduceat(value("low"), begin),
        np.maximum.reduceat(value("high"), begin),
        value("twice")[begin],
        table.column("packed").combine_chunks().take(pa.array(order[begin])),
    )


#: From strings to (string number, first window, window after the last, who), each an array.
Bucket = Callable[[Strings], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def marks_of(segments: DataFrame, kind: Kind, bucket: Bucket) -> DataFrame:
    """(fp, marks): for each string with affected windows, their ranges. Sorted by bucket; whole buckets at a time."""

    def work(table: pa.Table) -> pa.RecordBatch | None:
        strings = _strings(table)
        row, a, b, who = bucket(strings)
        if not len(row):
            return None
        order = np.lexsort((a, row))
        rows, counts = np.unique(row, return_counts=True)
        marks = pa.StructArray.from_arrays(
            [pa.array(a[order], pa.int32()), pa.array(b[order], pa.int32()), pa.array(who[order], pa.int64())], ["a", "b", "who"]
        )
        fp = strings.fp[rows]
        return pa.RecordBatch.from_arrays([fingerprints(fp[:, 0], fp[:, 1]), int_lists(counts, marks)], ["fp", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for part in slices(batch, "packed", kind.slice_bytes):
                held.append(part)
                size += part.nbytes
                if size < kind.group_bytes:
                    continue
                table = pa.Table.from_batches(held)
                routes = np.asarray(table.column("route"))
                cut = int(np.searchsorted(routes, routes[-1], "left"))
                if cut:
                    if (out := work(table.slice(0, cut))) is not None:
                        yield out
                    held = table.slice(cut).combine_chunks().to_batches()
                    size = sum(b.nbytes for b in held)
        if held and (out := work(pa.Table.from_batches(held))) is not None:
            yield out

    return segments.repartition("route").sortWithinPartitions("route").mapInArrow(run, _MARKS)


def spans_of(docs: DataFrame, kind: Kind, hot: Hot, marks: DataFrame) -> DataFrame:
    """(who, row, spans): for each row of ``docs`` with affected windows, ranges of their first units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", kind.slice_bytes):
                u1, u2, doc, _, _ = _units(*_normal(part.column("text"), kind.words), kind.words)
                found = find(u1, u2, doc, kind, hot)
                begin = np.searchsorted(doc, np.arange(part.num_rows))
                of = pa.array(found.doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        fingerprints(found.h1, found.h2),
                        part.column("who").take(of),
                        part.column("row").take(of),
                        pa.array(found.first - begin[found.doc], pa.int32()),
                    ],
                    ["fp", "who", "row", "start"],
                )

    seen = docs.select(*KEYS, "text").mapInArrow(run, "fp binary, who long, row long, start int")
    # A string may occur in a third of all rows; these rows are small, and Spark splits such a partition of the join.
    own = F.expr(
        "transform(filter(marks, m -> m.who < who), m -> struct(start + m.a as a, start + m.b as b))"
    )
    ranges = seen.join(marks, "fp").select(*KEYS, own.alias("spans")).where(F.size("spans") > 0)
    return ranges.groupBy(*KEYS).agg(F.flatten(F.collect_list("spans")).alias("spans"))


def covered(spans, n: int, width: int) -> np.ndarray:
    """Which of ``n`` units lie in a window that begins in one of the spans."""
    change = np.zeros(n + 1, np.int32)
    for s in spans:
        change[s["a"]] += 1
        change[s["b"] + width - 1] -= 1
    return np.cumsum(change[:n]) > 0
