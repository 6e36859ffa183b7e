"""Substring dedup on words and bytes against plain restatements."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from profilematch.llm import suffix_dedup, substring_dedup
from profilematch.llm.segments import covered
from tests.llm.fixtures import SCHEMA, matching, rows, table


def plain_words(data):
    split = [(i, (t or "").encode().split()) for i, t, *_ in data]
    first = {}
    for i, w in split:
        if i is not None:
            for k in range(len(w) - 49):
                window = tuple(w[k : k + 50])
                first[window] = min(i, first.get(window, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - 49 if i is not None else 0):
            if first[tuple(w[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def plain_bytes(data):
    raw = [(i, (t or "").encode()) for i, t, *_ in data]
    seen = {}
    for _, b in raw:
        for k in range(len(b) - 399):
            seen[b[k : k + 400]] = seen.get(b[k : k + 400], 0) + 1
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), runs, kept))
    return out


@pytest.mark.parametrize("min_hot", [None, 0, 2])
def test_words(spark, min_hot):
    """Whole strings, strings of hot minimisers split by cores, and single windows (all is hot) give one result."""
    out = substring_dedup.dedup_substrings(table(spark, extra=True), min_hot)
    got = [tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    matching(got, plain_words(rows()))


@pytest.mark.parametrize("min_hot", [None, 0, 2])
def test_bytes(spark, min_hot):
    out = suffix_dedup.dedup_bytes(table(spark, extra=True), min_hot).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    got = [(*r[:4], bytes(r.kept)) for r in out.collect()]
    matching(got, plain_bytes(rows()))


def test_partitioning_does_not_matter(spark):
    one = substring_dedup.dedup_substrings(table(spark).coalesce(1)).select("doc_id", F.sha2("kept_text", 256)).collect()
    many = substring_dedup.dedup_substrings(table(spark).repartition(7)).select("doc_id", F.sha2("kept_text", 256)).collect()
    matching([tuple(r) for r in one], [tuple(r) for r in many])


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.dedup_substrings(empty).collect() == []
    assert suffix_dedup.dedup_bytes(empty).collect() == []


def test_suffix_array_and_repeats():
    rng = np.random.default_rng(3)
    for _ in range(20):
        texts = [bytes(rng.integers(97, 100, rng.integers(5, 60)).astype(np.uint8)) for _ in range(4)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        row = np.repeat(np.arange(4), np.diff(offsets))
        ends = offsets[1:][row]
        order, lcp = suffix_dedup.suffix_array(data, ends, np.arange(len(data)))
        suffixes = [bytes(data[p : ends[p]]) for p in order]
        assert suffixes == sorted(suffixes)
        for a, b, n in zip(suffixes, suffixes[1:], lcp[1:]):
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])
        left = np.where(order == offsets[row[order]], 256 + order, data[np.maximum(order - 1, 0)])
        found = {}
        for first, last, n in suffix_dedup.maximal_repeats(lcp, left, 3):
            found[suffixes[first][:n]] = sorted(order[first : last + 1].tolist())
        expected = {}
        for p in range(len(data)):
            for n in range(3, ends[p] - p + 1):
                expected.setdefault(bytes(data[p : p + n]), []).append(p)
        for s, at in list(expected.items()):
            before = {int(data[p - 1]) if p != offsets[row[p]] else 256 + p for p in at}
            after = {int(data[p + len(s)]) if p + len(s) < ends[p] else 256 + p for p in at}
            if len(at) < 2 or len(before) < 2 or len(after) < 2:
                del expected[s]
        assert found == expected


def test_covered():
    assert covered([{"a": 1, "b": 2}, {"a": 5, "b": 7}], 12, 3).tolist() == [False] + [True] * 3 + [False] + [True] * 4 + [False] * 3


@pytest.mark.parametrize("min_hot", [3, 12])
def test_one_passage_in_many_surroundings(spark, min_hot):
    """Its minimisers are hot, and so are the cores where the surroundings begin."""
    import random

    from tests.llm.fixtures import prose

    r = random.Random(11)
    passage = prose(r, 150)
    data = [(k, f"{prose(r, 70)} {passage} {prose(r, 70)}", None, None, None) for k in range(60)]
    docs = table(spark, data)
    out = suffix_dedup.dedup_bytes(docs, min_hot).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    matching([(*r[:4], bytes(r.kept)) for r in out], plain_bytes(data))
    out = substring_dedup.dedup_substrings(docs, min_hot).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    matching([tuple(r) for r in out], plain_words(data))


def test_columns_named_like_the_operators_own(spark):
    docs = table(spark)
    for name in ("__row", "__spans", "__who", "__ROW_", "who", "row", "fp"):
        docs = docs.withColumn(name, F.lit(7))
    for out in (suffix_dedup.dedup_bytes(docs), substring_dedup.dedup_substrings(docs)):
        rows_out = out.collect()
        assert len(rows_out) == len(rows()) and out.columns[: len(docs.columns)] == docs.columns
        assert all(r[name] == 7 for r in rows_out for name in ("__row", "__spans", "__who", "__ROW_", "who", "row", "fp"))
