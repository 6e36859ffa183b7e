"""Postings by term: same lists as without, fewer rows read, no shuffle of postings."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from profilematch import fit_index, search
from profilematch.functions.text import tokens_ws
from profilematch.operators.similarity import rank_best, score_by_broadcast
from profilematch.operators.term_layout import lay_out, postings_of, score_by_terms


@pytest.fixture(scope="module")
def fitted(spark):
    r = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    common = [1 / (k + 1) for k in range(400)]
    rows = [(i, " ".join(r.choices(words, common, k=r.randint(0, 60)))) for i in range(600)]
    rows += [(1000 + i, rows[5][1]) for i in range(5)]
    docs = spark.createDataFrame(rows, "id long, text string").withColumn("tokens", tokens_ws("text"))
    index = fit_index(docs, "id", "tokens", "log2").stored()
    asked = [(i, " ".join(r.choices(words, common if i % 2 else None, k=r.randint(1, 12)))) for i in range(40)]
    asked += [(90, ""), (91, None), (92, "unknown words"), (93, "w399 unknown"), (94, rows[5][1])]
    return index, lay_out(index, slots=16), spark.createDataFrame(asked, "request_id long, query_text string")


def test_same_lists(fitted):
    index, layout, asked = fitted
    plain = search(index, asked, 7)
    by_term = search(index, asked, 7, layout=layout)
    key = lambda r: (r.request_id, r.rank, r.id, r.similarity)
    assert sorted(map(key, by_term.collect())) == sorted(map(key, plain.collect()))


@pytest.mark.parametrize("n", [1, 3, 10])
def test_candidates_hold_the_best(spark, fitted, n):
    """Whatever the split into essential terms and others, the best n and their whole scores are there."""
    index, layout, asked = fitted
    words = asked.where("query_text is not null").select("request_id", F.explode(F.split("query_text", " ")).alias("term")).distinct()
    terms = words.join(index.vocab, "term").select("request_id", "term", F.col("idf").alias("w"))
    expected = rank_best(score_by_broadcast(terms, index.weights), n)
    got = rank_best(score_by_terms(layout, terms, n), n)
    key = lambda r: (r.request_id, r.rank, r.id, round(r.sim, 9))
    assert sorted(map(key, got.collect())) == sorted(map(key, expected.collect()))


def test_few_terms_read_few_rows(spark, fitted):
    index, layout, _ = fitted
    total = layout.postings.count()
    assert total == index.weights.count()
    read = lambda *terms: postings_of(layout, spark.createDataFrame([(t,) for t in terms], "term string"))
    rare, two, none = read("w399"), read("w399", "w398"), read()
    assert rare.count() <= two.count() < total / 20 and none.count() == 0
    plan = rare._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slot" in plan and "PushedFilters: [" in plan


def test_postings_are_not_shuffled(spark, fitted):
    index, layout, _ = fitted
    found = postings_of(layout, spark.createDataFrame([("w1",), ("w2",)], "term string"))
    terms = spark.createDataFrame([(1, "w1", 1.0), (1, "w2", 1.0)], "request_id long, term string, w double")
    plan = score_by_broadcast(terms, found)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan
