"""Quality classifier: a linear-chain conditional random field labels every line of a text good or bad.

A line's features are its measures (METRICS), each in one of BUCKETS ranges, and those of the lines before and after.
Ranges are set by quantiles of the training lines. Labels exist for documents: each line of a training document has
its label. A document's quality is the mean of its lines' marginals, weighted by their length, through a logistic
function fitted on the training documents.

Training uses a sample of PER_CLASS documents of each label and MAX_BYTES of text; scoring covers every whole text.
Lines without words are passed over. Null, empty and blank texts have no good line: the mean is 0. Without training
rows all scores are 0. Repeated rows score alike; extra columns are kept, one named ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from profilematch.llm import crf
from profilematch.llm import hashing as H
from profilematch.llm.common import slices, text_bytes
from profilematch.llm.samples import labelled_sample

PER_CLASS = 2000
MAX_BYTES = 16 << 20
BUCKETS = 8
METRICS = ("bytes", "words", "word_bytes", "upper", "digits", "symbols", "marks", "distinct", "repeats_line", "ends")


def _set(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_UPPER, _DIGIT = _set(bytes(range(65, 91))), _set(b"0123456789")
_SYMBOL, _MARK = _set(b"#*$%&|<>{}[]=_~^\\/@+"), _set(b"!?;:")
_END = _set(b".!?:;\"')")
_BREAK = _set(b"\n")


@dataclass
class Model:
    edges: np.ndarray  # inner bounds of the ranges, one row per metric
    weights: crf.Weights
    score: np.ndarray


def measures(column: pa.Array):
    """Measures of each line that has a word, the text of each line, its length, and whether it is its text's first."""
    data, offsets = text_bytes(column)
    starts, ends, doc = H.word_spans(data, offsets, _BREAK)
    w_start, w_end, _ = H.word_spans(data, offsets)
    sums = lambda table: np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
    over = lambda total: total[ends] - total[starts]
    line = np.searchsorted(starts, w_start, "right") - 1
    n_words = np.bincount(line, minlength=len(starts))
    words = H.word_hashes(data, w_start, w_end)
    key = H.mix(words ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    distinct = np.bincount(line[np.unique(key, return_index=True)[1]], minlength=len(starts))
    whole = H.span_hashes(data, starts, ends, H.BASES[0], H.BYTE_VALUES)
    again = np.ones(len(starts), bool)
    again[np.unique(H.mix(whole ^ (doc.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))), return_index=True)[1]] = False
    solid = np.maximum(1, over(sums(~H.WHITE)))
    size = np.maximum(1, n_words)
    values = np.column_stack(
        [
            ends - starts,
            n_words,
            solid / size,
            over(sums(_UPPER)) / solid,
            over(sums(_DIGIT)) / solid,
            over(sums(_SYMBOL)) / solid,
            over(sums(_MARK)) / solid,
            distinct / size,
            again,
            _END[data[ends - 1]] if len(ends) else np.zeros(0),
        ]
    )
    keep = n_words > 0
    doc = doc[keep]
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    return values[keep], doc, (ends - starts)[keep], first


def _features(values: np.ndarray, first: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Feature numbers of each line: its ranges, then those of the lines before and after (a number of its own if none)."""
    ranges = np.column_stack([np.searchsorted(edges[k], values[:, k], "right") for k in range(len(METRICS))])
    none = np.full((1, len(METRICS)), BUCKETS)
    last = np.append(first[1:], True)
    before = np.where(first[:, None], BUCKETS, np.concatenate([none, ranges[:-1]])[: len(ranges)])
    after = np.where(last[: len(ranges), None], BUCKETS, np.concatenate([ranges[1:], none])[: len(ranges)])
    block = (BUCKETS + 1) * np.arange(3 * len(METRICS))
    return np.column_stack([ranges, before, after]) + block


N_FEATURES = 3 * len(METRICS) * (BUCKETS + 1)


def _mean(p: np.ndarray, doc: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """The length-weighted mean of the marginals of each text, 0 without lines."""
    return (np.bincount(doc, p * length, n) / np.maximum(1, np.bincount(doc, length, n)))[:, None]


def fit(docs: DataFrame, labels: DataFrame, train) -> Model | None:
    """A model from rows of ``labels`` (doc_id, quality) that the condition ``train`` allows."""
    sample = labelled_sample(docs, labels, "quality", train, PER_CLASS, MAX_BYTES).toArrow()
    if not sample.num_rows:
        return None
    good = np.asarray(sample.column("label")).astype(float)
    found, before = [], 0
    for batch in sample.to_batches():
        for part in slices(batch, "text"):
            values, doc, length, first = measures(part.column("text"))
            found.append((values, doc + before, length, first))
            before += part.num_rows
    values, doc, length, first = map(np.concatenate, zip(*found))
    if not len(values):
        return None
    edges = np.quantile(values, np.arange(1, BUCKETS) / BUCKETS, axis=0).T
    active = _features(values, first, edges)
    weights = crf.train(active, good[doc] == 1, first, N_FEATURES)
    p, _ = crf.marginals(weights, crf.emissions(weights, active), first)
    return Model(edges, weights, crf.logistic(_mean(p, doc, length, len(good)), good))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score``, from 0 (bad) to 1 (good)."""
    docs = docs.drop("score")
    names = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, model = part.num_rows, sent.value
                scores = np.zeros(n)
                if model is not None:
                    values, doc, length, first = measures(part.column("text"))
                    active = _features(values, first, model.edges)
                    p, _ = crf.marginals(model.weights, crf.emissions(model.weights, active), first)
                    scores = crf.probability(_mean(p, doc, length, n), model.score)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], [*names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
