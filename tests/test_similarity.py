import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from profilematch import find_similar, fit_index, search, similar_pairs, similar_profiles
from profilematch.operators.pairs import pairs_above
from profilematch.operators.tfidf import term_counts, unit_weights


def rows(df):
    return sorted((r.request_id, r["rank"], r.id, round(r.similarity, 4)) for r in df.collect())


def brute_weights(docs, formula):
    n, df = len(docs), Counter(t for words in docs.values() for t in set(words))
    out = {}
    for i, words in docs.items():
        idf = (lambda d: math.log2(n / d)) if formula == "log2" else (lambda d: math.log((1 + n) / (1 + d)) + 1)
        w = {t: c * idf(df[t]) for t, c in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        out[i] = {t: x / norm for t, x in w.items() if x > 1e-12} if norm > 1e-12 else {}
    return out


def dot(a, b):
    return sum(x * b.get(t, 0.0) for t, x in a.items())


@pytest.fixture(scope="module")
def random_docs():
    rng = random.Random(7)
    # 'hot' is in most documents and a third of them are copies of one text.
    docs = {i: ["hot"] * rng.randint(0, 2) + [f"w{min(int(rng.expovariate(0.2)), 25)}" for _ in range(rng.randint(0, 6))] for i in range(60)}
    for i in range(0, 60, 3):
        docs[i] = ["hot", "copy", "w3"]
    return docs


@pytest.fixture(scope="module")
def random_frame(spark, random_docs):
    frame = spark.createDataFrame(list(random_docs.items()), "id long, tokens array<string>")
    return frame.withColumn("profile", F.array_join(F.array_sort("tokens"), " ")).cache()


@pytest.mark.parametrize("limit", [256, 0])
def test_golden_search(spark, indexes, limit):
    asked = spark.createDataFrame([(7, "python cloud java rust"), (8, "rust")], "request_id long, query_text string")
    a = rows(search(indexes["A"], asked, 3, "A", max_broadcast_requests=limit))
    assert a == [(7, 1, 3, 0.7019), (7, 2, 1, 0.5396), (7, 3, 0, 0.3497), (8, 1, 0, 0), (8, 2, 1, 0), (8, 3, 2, 0)]
    b = rows(search(indexes["B"], asked, 3, "B", max_broadcast_requests=limit))
    assert b == [(7, 1, 3, 0.7452), (7, 2, 1, 0.6234), (7, 3, 0, 0.5623), (8, 1, 3, 0), (8, 2, 2, 0), (8, 3, 1, 0)]


@pytest.mark.parametrize("limit", [256, 0])
def test_golden_find(spark, indexes, limit):
    asked = spark.createDataFrame([(70, 0), (71, 0), (72, 99)], "request_id long, company_id long")
    a = rows(find_similar(indexes["A"], asked, 5, "A", max_broadcast_requests=limit))
    assert a == [(q, r, i, s) for q in (70, 71) for r, i, s in ((1, 3, 0.4549), (2, 1, 0.0514), (3, 2, 0.0))]
    b = rows(find_similar(indexes["B"], asked, 5, "B", max_broadcast_requests=limit))
    assert b[:4] == [(70, 1, 3, 0.6721), (70, 2, 1, 0.2226), (70, 3, 2, 0.0), (70, 4, 0, -1.0)]


def test_top_n_is_checked_and_per_request(spark, indexes):
    asked = spark.createDataFrame([(1, "java", 1), (2, "java", 3)], "request_id long, query_text string, top_n int")
    assert Counter(r[0] for r in rows(search(indexes["A"], asked))) == {1: 1, 2: 3}
    with pytest.raises(ValueError):
        search(indexes["A"], asked.drop("top_n"), 11)
    with pytest.raises(Exception, match="top_n must be"):
        search(indexes["A"], asked.withColumn("top_n", F.lit(0))).collect()


@pytest.mark.parametrize("model,formula", [("A", "log2"), ("B", "smooth")])
@pytest.mark.parametrize("limit", [256, 0])
def test_find_equals_brute_force(spark, random_docs, random_frame, model, formula, limit):
    w = brute_weights(random_docs, formula)
    sign = 1 if model == "A" else -1
    expected = []
    for q in random_docs:
        others = sorted((i for i in w if i != q), key=lambda i: (-round(dot(w[q], w[i]), 10), sign * i))
        expected += [(q, r + 1, i, round(dot(w[q], w[i]), 4)) for r, i in enumerate(others[:7])]
    asked = random_frame.select(F.col("id").alias("request_id"), F.col("id").alias("company_id"))
    index = fit_index(random_frame, "id", "tokens", formula)
    found = rows(find_similar(index, asked, 7, model, max_broadcast_requests=limit))
    assert [x[:3] for x in found] == [x[:3] for x in sorted(expected)]
    assert all(abs(x[3] - y[3]) < 2e-4 for x, y in zip(found, sorted(expected), strict=True))
    collapsed = rows(similar_profiles(random_frame, 7, model, max_broadcast_requests=limit))
    assert [x[:3] for x in collapsed] == [x[:3] for x in sorted(expected)]


@pytest.mark.parametrize("model,own", [("A", []), ("B", [-1.0])])
def test_whole_profiles_of_a_small_corpus(spark, model, own):
    """All others come in the order of ties, copies included; the row itself is last, at -1, for model B only."""
    docs = [(0, "x y"), (1, "z"), (2, "x y"), (3, "x y"), (4, "q")]
    frame = spark.createDataFrame(docs, "id long, profile string").withColumn("tokens", F.split("profile", " "))
    found = rows(similar_profiles(frame, 6, model))
    ids = [i for i, _ in docs] if model == "A" else [i for i, _ in reversed(docs)]
    for i, text in docs:
        others = [(k, 1.0) for k in ids if k != i and dict(docs)[k] == text] + [(k, 0.0) for k in ids if dict(docs)[k] != text]
        expected = others + [(i, s) for s in own]
        assert [(x[2], x[3]) for x in found if x[0] == i] == expected


def test_hot_and_rare_terms_join_apart(random_docs, random_frame):
    index = fit_index(random_frame, "id", "tokens", "smooth")
    split = unit_weights(term_counts(random_frame), index.vocab, max_broadcast_terms=3)
    expected = brute_weights(random_docs, "smooth")
    found = {(r.id, r.term): r.w for r in split.collect()}
    assert set(found) == {(i, t) for i, w in expected.items() for t in w}
    assert all(abs(x - expected[i][t]) < 1e-9 for (i, t), x in found.items())


def test_pairs_both_ways_equal_brute_force(random_docs, random_frame):
    index = fit_index(random_frame, "id", "tokens", "smooth").stored()
    w = brute_weights(random_docs, "smooth")
    expected = {(a, b) for a in w for b in w if a < b and dot(w[a], w[b]) > 0.5}
    for prefixes, block in ((False, 1000), (False, 7), (True, 1000), (True, 5)):
        pairs = pairs_above(index.weights, index.vocab, 0.5, prefixes, block, cell_rows=40).collect()
        assert len(pairs) == len(expected) and {(r.id_a, r.id_b) for r in pairs} == expected
    collapsed = similar_pairs(random_frame, 0.5, "B").collect()
    whole = sum(r.n_a * r.n_b if r.id_a != r.id_b else r.n_a * (r.n_a - 1) // 2 for r in collapsed)
    assert whole == len(expected)


def test_no_nested_loop_and_no_python_in_search(spark, indexes, capsys):
    asked = spark.createDataFrame([(7, "python cloud")], "request_id long, query_text string")
    search(indexes["A"], asked, 3).explain()
    plan = capsys.readouterr().out
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "PandasUDF"):
        assert bad not in plan
    assert "WindowGroupLimit" in plan


def test_salted_expansion_equals_broadcast(spark):
    from profilematch.operators.skew import expand_join

    many = spark.range(200).withColumn("k", F.when(F.col("id") < 150, 0).otherwise(F.col("id") % 5))
    one = spark.createDataFrame([(k, f"v{k}") for k in range(4)], "k long, v string")
    for how in ("inner", "left"):
        found = [sorted(map(tuple, expand_join(many, one, "k", "id", s, how).collect()), key=str) for s in (True, False)]
        assert found[0] == found[1]
