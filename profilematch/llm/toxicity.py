"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals add up to a document score.

Labels exist for documents, not for tokens. Tokens are labelled from them: in a toxic training document a token is
toxic if its word, or a beginning of it (PREFIXES bytes), is in many more toxic than clean documents (``LIFT``) and in
enough of them (``SHARE``); all other tokens are clean. The field's features are the token's word, its two neighbours
and its beginnings, among those of the sample that say most (MAX_WORDS each, in LEAST_DOCUMENTS or more). A
document's score is a logistic function of its greatest marginal and of the expected number of toxic tokens among the
tagged ones, those with a marginal of 0.5 or more (the others' small marginals add up in long texts). Offending offsets
are the runs of tagged tokens.

Training uses a sample of PER_CLASS documents of each label and MAX_BYTES of text (crf.py, samples.py); scoring covers
every whole text. Null, empty and token-free texts have no toxic tokens and the score that goes with it. Without any
training rows all scores are 0. Repeated rows score alike; extra columns are kept, those named like new ones replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from profilematch.llm import crf
from profilematch.llm import hashing as H
from profilematch.llm.common import APART, int_lists, slices, text_bytes
from profilematch.llm.samples import labelled_sample

U = np.uint64
PER_CLASS = 1000
MAX_BYTES = 10 << 20
MAX_WORDS = 20_000
PREFIXES = (4, 5, 6, 7)
LEAST_DOCUMENTS = 4
SHARE = 0.01
LIFT = 8.0


@dataclass
class Model:
    known: list[np.ndarray]  # sorted hashes of words, then of beginnings of each length in PREFIXES
    weights: crf.Weights
    score: np.ndarray


def _numbers(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """k + 1 where a hash is known[k], 0 for any other. A table of leading bits spares most searches."""
    out = np.zeros(len(hashes), np.int64)
    if len(known):
        seen = np.zeros(1 << 20, bool)
        seen[known >> U(44)] = True
        here = np.flatnonzero(seen[hashes >> U(44)])
        at = np.minimum(np.searchsorted(known, hashes[here]), len(known) - 1)
        out[here] = np.where(known[at] == hashes[here], at + 1, 0)
    return out


def _features(attributes: list[np.ndarray], first: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """Feature numbers of each token: its word, the words before and after, and its beginnings."""
    own, *begins = [_numbers(h, k) for h, k in zip(attributes, known)]
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = np.where(first[1:], 0, own[:-1])
    after[:-1] = np.where(first[1:], 0, own[1:])
    sizes = [len(known[0]) + 1] * 3 + [len(k) + 1 for k in known[1:]]
    return (np.column_stack([own, before, after, *begins]) + np.cumsum([0, *sizes[:-1]])).astype(np.int32)


def _size(known: list[np.ndarray]) -> int:
    return 3 * (len(known[0]) + 1) + sum(len(k) + 1 for k in known[1:])


def _tokens(column: pa.Array):
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, doc = H.word_spans(data, offsets, APART)
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    attributes = [H.word_hashes(data, starts, ends)]
    for n in PREFIXES:
        begin = H.word_hashes(data, starts, np.minimum(ends, starts + n))
        attributes.append(np.where(ends - starts > n, begin, U(0)))
    return data, offsets, starts, ends, doc, attributes, first


def _totals(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Expected number of toxic tokens among the tagged ones (its logarithm), and greatest marginal, of each text."""
    most = np.zeros(n)
    np.maximum.at(most, doc, p)
    return np.column_stack([np.log1p(np.bincount(doc, np.where(p >= 0.5, p, 0), n)), most])


def fit(docs: DataFrame, labels: DataFrame, train) -> Model | None:
    """A model from rows of ``labels`` (doc_id, toxic) that the condition ``train`` allows."""
    sample = labelled_sample(docs, labels, "toxic", train, PER_CLASS, MAX_BYTES).toArrow()
    if not sample.num_rows:
        return None
    toxic = np.asarray(sample.column("label")).astype(float)
    _, _, _, _, doc, attributes, first = _tokens(sample.column("text").combine_chunks())
    known, marked = [], np.zeros(len(doc), bool)
    for hashes in attributes:
        distinct, number = np.unique(hashes, return_inverse=True)
        pairs = np.unique(number * len(toxic) + doc)
        of_toxic = np.bincount(pairs // len(toxic), toxic[pairs % len(toxic)], len(distinct))
        of_clean = np.bincount(pairs // len(toxic), 1 - toxic[pairs % len(toxic)], len(distinct))
        lift = (of_toxic + 0.5) / (toxic.sum() + 1) / ((of_clean + 0.5) / ((1 - toxic).sum() + 1))
        enough = np.flatnonzero((of_toxic + of_clean >= LEAST_DOCUMENTS) & (distinct != 0))
        tells = np.abs(np.log(lift[enough])) * np.sqrt((of_toxic + of_clean)[enough])
        known.append(np.sort(distinct[enough[np.argsort(-tells, kind="stable")[:MAX_WORDS]]]))
        marks = (of_toxic >= max(LEAST_DOCUMENTS, SHARE * toxic.sum())) & (lift >= LIFT) & (distinct != 0)
        marked |= marks[number]
    active = _features(attributes, first, known)
    weights = crf.train(active, marked & (toxic[doc] == 1), first, _size(known))
    p, _ = crf.marginals(weights, crf.emissions(weights, active), first)
    return Model(known, weights, crf.logistic(_totals(p, doc, len(toxic)), toxic))


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_OUT = [T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(_SPAN))]


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``spans`` (start and end of toxic runs, code points, end exclusive)."""
    docs = docs.drop(*[f.name for f in _OUT])
    names = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, model = part.num_rows, sent.value
                data, offsets, starts, ends, doc, attributes, first = _tokens(part.column("text"))
                p = np.zeros(len(doc))
                if model is not None:
                    active = _features(attributes, first, model.known)
                    p, _ = crf.marginals(model.weights, crf.emissions(model.weights, active), first)
                scores = crf.probability(_totals(p, doc, n), model.score) if model is not None else np.zeros(n)
                hit = np.flatnonzero(p >= 0.5)
                opens = np.ones(len(hit), bool)
                opens[1:] = (np.diff(hit) > 1) | first[hit[1:]]
                closes = np.append(opens[1:], True)[: len(hit)]
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                text = doc[hit[opens]]
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array(points[starts[hit[opens]]] - points[offsets[text]], pa.int32()),
                        pa.array(points[ends[hit[closes]]] - points[offsets[text]], pa.int32()),
                    ],
                    ["start", "end"],
                )
                lists = int_lists(np.bincount(text, minlength=n), spans)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores), lists], [*names, "score", "spans"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *_OUT]))
