"""Quality rules with thresholds that follow the data: quantile sketches per language and source.

A sketch of a metric is a histogram whose buckets are exact below 64 and 1/32 wide (relative) above. Sketches merge
by adding counts, so a third of all rows under one source is counted inside the tasks first, and the sketches of
sources add up to those of languages and of the corpus. A group with few documents uses its language's sketch, then
the corpus's. A document is rejected where a metric is above q90 + SPREAD * (q90 - q50) of its group, or, for the
length of words, below q10 - SPREAD * (q50 - q10). So the tail of nine tenths of a group decides what is usual there;
what a tenth of a group or more does is usual. Values are compared as lower bounds of their buckets, as quantiles are.
UNITS of what a metric counts are no evidence: a text with that many or
fewer is not rejected by it. All numbers are integers, so results don't depend on the order of merging.

Null texts are empty. A document without words has all metrics 0 and fails the base rule. Null languages and sources
are groups of their own. Repeated rows are judged alike, each once. Extra columns are kept by ``quality_filter``,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.llm import hashing as H
from profilematch.llm.common import free_name, slices, stored, text_bytes
from profilematch.operators.skew import expand_join

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]
#: metric: (numerator, factor, denominator, lower fence as well)
METRICS = {
    "symbols": ("n_symbols", 1000, "n_words", False),
    "dup_lines": ("n_dup_lines", 1000, "n_lines", False),
    "repeats": ("n_repeat_words", 1000, "n_words", False),
    "upper": ("n_upper", 1000, "word_chars", False),
    "length": ("word_chars", 100, "n_words", True),
}
SPREAD = 6
UNITS = 3
MIN_DOCUMENTS = 200
MIN_WORDS = 50
MAX_BROADCAST_GROUPS = 100_000
_OUT = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
_COLUMN = "__rule_counts"

_symbols = np.zeros(256, bool)
_symbols[[ord(c) for c in "#*$%&|<>"]] = True
_upper = np.zeros(256, bool)
_upper[ord("A") : ord("Z") + 1] = True
_LINE_WHITE = " \t\v\f\r"


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many True values each text has."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(starts, doc, words, n_texts: int) -> np.ndarray:
    """Words of each text that lie in a 3-word window which the text holds twice or more."""
    if len(words) < 3:
        return np.zeros(n_texts, np.int64)
    at = np.flatnonzero(doc[:-2] == doc[2:])
    window = H.window_hashes(words, 3)[at]
    key = H.mix(window ^ (doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(words), bool)
    twice[at[order[1:][same]]] = True
    twice[at[order[:-1][same]]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:] |= twice[: len(words) - shift]
    return np.bincount(doc[covered], minlength=n_texts)


def _counts(column: pa.Array) -> pa.StructArray:
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    starts, ends, doc = H.word_spans(data, offsets)
    words = H.word_hashes(data, starts, ends)
    inside = ~H.WHITE[data] & ((data & 0xC0) != 0x80)
    lines, dup = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, text in enumerate(column.to_pylist()):
        if text:
            own = [line for line in text.split("\n") if line.strip(_LINE_WHITE)]
            lines[i], dup[i] = len(own), len(own) - len(set(own))
    values = {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": _sums(inside, offsets),
        "n_symbols": _sums(_symbols[data], offsets),
        "n_dup_lines": dup,
        "n_repeat_words": _repeats(starts, doc, words, n),
        "n_lines": lines,
        "n_upper": _sums(_upper[data], offsets),
    }
    return pa.StructArray.from_arrays([pa.array(values[c], pa.int64()) for c in COUNTS], COUNTS)


def with_counts(docs: DataFrame, text: str = "text", name: str = _COLUMN) -> DataFrame:
    """``docs`` with one more column, a struct of the counts of its text. It takes the place of a column called ``name``."""
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, _counts(part.column(text))], [*part.schema.names, name]
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, _OUT)]))


def _metric(name: str, counts: str):
    over, factor, under, _ = METRICS[name]
    n = F.col(f"{counts}.{under}")
    return F.when(n > 0, F.expr(f"{factor} * {counts}.{over} div {counts}.{under}")).otherwise(F.lit(0).cast("long"))


def base_failed(counts: str = _COLUMN):
    n, repeats = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeats > 50 * n)


def bucket(v):
    """The lower bound of the sketch's bucket of a count: exact below 64, five leading bits after the first above."""
    shift = F.length(F.bin(v)) - 6
    return F.when(v < 64, v).otherwise(F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift))


def sketches(counted: DataFrame, counts: str = _COLUMN) -> DataFrame:
    """(lang, source, metric, low, n): the sketch of each metric over the documents that pass the base rule."""
    each = F.array(
        *[F.struct(F.lit(m).alias("metric"), bucket(_metric(m, counts)).alias("low")) for m in METRICS]
    )
    rows = counted.where(~base_failed(counts)).select("lang", "source", F.explode(each).alias("m"))
    return rows.groupBy("lang", "source", "m.metric", "m.low").agg(F.count("*").alias("n"))


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group: documents, and a map from metric to (q10, q50, q90)."""
    merged = sketch.groupBy(*keys, "metric", "low").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    run = merged.withColumn("upto", F.sum("n").over(group.orderBy("low"))).withColumn("all", F.sum("n").over(group))
    quantile = lambda tenths: F.min(F.when(F.col("upto") * 10 >= F.col("all") * tenths, F.col("low")))
    found = run.groupBy(*keys, "metric").agg(
        F.max("all").alias("n"), quantile(1).alias("q10"), quantile(5).alias("q50"), quantile(9).alias("q90")
    )
    return found.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("metric", F.struct("q10", "q50", "q90")))).alias("quantiles"),
    )


def fences(sketch: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, source, fence): a map from metric to (low, high) for each language and source with a sketch."""
    own = _quantiles(sketch, ["lang", "source"])
    lang = _quantiles(sketch, ["lang"]).select(
        F.col("lang").alias("_lang"), F.col("n").alias("n_lang"), F.col("quantiles").alias("of_lang")
    )
    whole = _quantiles(sketch.withColumn("_all", F.lit(1)), ["_all"]).select(F.col("quantiles").alias("of_all"))
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").join(F.broadcast(whole), how="left")
    chosen = (
        F.when(F.col("n") >= min_documents, F.col("quantiles"))
        .when(F.col("n_lang") >= min_documents, F.col("of_lang"))
        .otherwise(F.col("of_all"))
    )
    entries = []
    for m, (_, _, _, lower) in METRICS.items():
        q10, q50, q90 = (F.col("q")[m][q] for q in ("q10", "q50", "q90"))
        low = q10 - SPREAD * (q50 - q10) if lower else F.lit(-1).cast("long")
        entries += [F.lit(m), F.struct(low.alias("low"), (q90 + SPREAD * (q90 - q50)).alias("high"))]
    return joined.withColumn("q", chosen).select("lang", "source", F.create_map(*entries).alias("fence"))


def _judged(counted: DataFrame, counts: str, limits: DataFrame) -> tuple[DataFrame, str]:
    """``counted`` with one more column, and its name: false if the base rule or a fence rejects the row."""
    group, limit, by, verdict = (free_name(counted, f"__{n}") for n in ("group", "fence", "by", "kept"))
    key = lambda: F.to_json(F.struct("lang", "source"))
    small = limits.count() <= MAX_BROADCAST_GROUPS
    one = limits.select(key().alias(group), F.col("fence").alias(limit))
    many = counted.withColumns({group: key(), by: F.xxhash64("doc_id")})
    joined = expand_join(many, one, group, by, small, "left")
    inside = F.lit(True)
    for m, (over, *_) in METRICS.items():
        v, fence = bucket(_metric(m, counts)), F.col(limit)[m]
        inside = inside & ((v <= fence["high"]) | (F.col(f"{counts}.{over}") <= UNITS)) & (v >= fence["low"])
    kept = ~base_failed(counts) & F.coalesce(inside, F.lit(True))
    return joined.withColumn(verdict, kept).drop(group, by, limit), verdict


def judge(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per document: doc_id, its counts, base_failed, and kept. The counts are stored once."""
    small = docs.select("doc_id", "lang", "source", "text")
    counted = stored(with_counts(small).drop("text"), "rules")
    limits = stored(fences(sketches(counted), min_documents), "fences")
    out, verdict = _judged(counted, _COLUMN, limits)
    return out.select("doc_id", f"{_COLUMN}.*", base_failed().alias("base_failed"), F.col(verdict).alias("kept"))


def quality_filter(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Counts are made twice, so that no text is stored."""
    narrow = with_counts(docs.select("lang", "source", "text")).drop("text")
    limits = stored(fences(sketches(narrow), min_documents), "fences")
    counts = free_name(docs, _COLUMN)
    out, verdict = _judged(with_counts(docs, name=counts), counts, limits)
    return out.where(F.col(verdict)).select(*docs.columns)
