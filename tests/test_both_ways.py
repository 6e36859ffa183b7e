"""Both ways of a job give one result: thresholds that equal a rounded score, mixed types, repeated and null ids."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from profilematch import fit_index
from profilematch.functions.text import tokens_ws
from profilematch.operators.lookup import Dictionaries, normalize_text
from profilematch.operators.pairs import pairs_above
from profilematch.operators.tfidf import attach_idf
from profilematch.plans import models
from profilematch.plans.find import find_similar
from profilematch.plans.recommend import retrieve
from profilematch.plans.search import search
from profilematch.sources.dictionaries import term_map, word_list

WORDS = [f"w{i:02d}" for i in range(40)]


@pytest.fixture(scope="module")
def index(spark):
    rows = [(i, " ".join(WORDS[(i * k + k * k) % 40] for k in range(1, 9))) for i in range(120)]
    docs = spark.createDataFrame(rows, "id long, t string").withColumn("tokens", tokens_ws("t"))
    return fit_index(docs, "id", "tokens", "smooth").stored()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("left,right", [("int", "long"), ("long", "int"), ("string", "string")])
def test_clusters_of_any_type_and_thresholds_at_a_score(spark, index, left, right):
    clusters = index.ids.withColumn("cluster", (F.col("id") % 3).cast(right))
    asked = spark.createDataFrame([(1, "w01 w05 w09"), (2, "w02 w30")], "request_id long, t string")
    asked = asked.select("request_id", tokens_ws("t").alias("tokens"), (F.col("request_id") % 3).cast(left).alias("cluster"))
    scores = [r.similarity_score for r in retrieve(index, asked.withColumn("threshold", F.lit(0.01)), clusters).collect()]
    for score in sorted(scores)[:3]:
        at = asked.withColumn("threshold", F.lit(round(score, 10)))
        few, many = (rows_of(retrieve(index, at, clusters, max_broadcast_requests=n)) for n in (256, 0))
        key = lambda found: [(r[0], r[1], r[2], round(r[5], 9)) for r in found]
        assert key(few) == key(many) and any(round(r[5], 10) == round(score, 10) for r in few)


def test_pairs_at_a_threshold_that_equals_a_score(index):
    found = pairs_above(index.weights, index.vocab, 0.3, use_prefixes=False).where("sim < 0.99")
    scores = sorted(r.sim for r in found.collect())
    for at in (round(scores[len(scores) // 3], 10), round(scores[-2], 10), scores[len(scores) // 2]):
        grid, prefixes = ({tuple(r)[:2] for r in pairs_above(index.weights, index.vocab, at, way, 7, 50).collect()} for way in (False, True))
        assert grid == prefixes


def test_normalising_by_join_keeps_each_row(spark):
    d = Dictionaries(term_map(spark, {"x": "a b"}), term_map(spark, {"b": "d"}), word_list(spark, ["z"]), word_list(spark, ["q"]))
    df = spark.createDataFrame([(1, "x z"), (1, "q x"), (None, "b"), (2, None)], "id long, t string")
    one, other = (rows_of(normalize_text(df, "id", "t", d, max_constant_terms=n)) for n in (50_000, 0))
    assert one == other and len(one) == 4


def test_split_vocabulary(spark, index):
    counts = index.weights.select("id", "term")
    whole, split = (rows_of(attach_idf(counts, index.vocab, n).select("id", "term", "idf")) for n in (10**6, 20))
    assert whole == split


def test_few_and_many_requests(spark, index):
    asked = spark.createDataFrame([(i, f"w{i:02d} w{i + 3:02d}") for i in range(9)], "request_id long, query_text string")
    found = [rows_of(search(index, asked, 4, "B", max_broadcast_requests=n).withColumn("similarity", F.round("similarity", 9))) for n in (256, 0)]
    assert found[0] == found[1]
    ids = spark.createDataFrame([(i, i) for i in range(9)], "request_id long, company_id long")
    near = [rows_of(find_similar(index, ids, 4, "B", max_broadcast_requests=n).withColumn("similarity", F.round("similarity", 9))) for n in (256, 0)]
    assert near[0] == near[1]


def test_top_clusters_in_the_row_and_by_blocks(spark):
    data = spark.createDataFrame([(i, [float(i % 7), float(i % 5)]) for i in range(40)], "id long, v array<double>")
    centres = spark.createDataFrame([(k, [float(k), float(k % 3)]) for k in range(6)], "label int, centroid array<double>")
    one, other = (rows_of(models.top_clusters(data, "id", "v", centres, 2, n).withColumn("distance", F.round("distance", 9))) for n in (10, 1))
    assert one == other and len(one) == 80


def test_vectors_of_unknown_words_are_like_nothing(spark):
    vectors = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [0.6, 0.8])], "id long, vector array<double>")
    found = {(r.request_id, r.id): r.similarity for r in models.word2vec_similar(vectors, vectors.select("id"), 3).collect()}
    assert found[(1, 2)] == 0 and found[(1, 3)] == 0 and found[(3, 4)] == 0.6 and (1, 1) not in found


@pytest.mark.parametrize("model", ["A", "B"])
def test_similar_by_bounds(spark, index, model, monkeypatch):
    """Blocks of few documents, most of which a row never meets; copies tie with each other."""
    from profilematch.operators import similarity

    monkeypatch.setattr(similarity, "KIND_ROWS", 5)
    asked = index.ids.where("id % 3 <> 1").select(F.col("id").alias("request_id"), F.col("id").alias("company_id"))
    asked = asked.union(spark.createDataFrame([(900, 5000), (901, None), (902, 7), (903, 7)], asked.schema))
    ways = [
        find_similar(index, asked, 4, model, max_broadcast_requests=n, bounded_from=b) for n, b in ((1000, 0), (0, 10**9), (0, 0))
    ]
    plain, blocks, bounded = ([(*r[:3], round(r[3], 8)) for r in rows_of(x)] for x in ways)
    assert plain == blocks == bounded and len(plain) == 4 * 82


def test_rows_meet_only_blocks_they_need(spark, index):
    """Documents of two languages: the bound keeps each row in the blocks of its own."""
    from profilematch.operators.similarity import needed_blocks

    rows = [(i, [f"{'ab'[i % 2]}{(i + k) % 9}" for k in range(4)], [0.5] * 4, "ab"[i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "id long, terms array<string>, ws array<double>, block string")
    needed = needed_blocks(docs, docs.withColumn("line", F.lit(0.0))).collect()
    assert sorted((r.id, r.rb) for r in needed) == [(i, "ab"[i % 2]) for i in range(40)]
    assert needed_blocks(docs, docs.withColumn("line", F.lit(1.01))).count() == 0


def test_blocks_of_clusters(spark, index, monkeypatch):
    """A cluster of nine tenths is cut into blocks of its own; clusters never share a cell."""
    from profilematch.operators import blocks

    monkeypatch.setattr(blocks, "BLOCK_ROWS", 10)
    clusters = index.ids.withColumn("cluster", F.when(F.col("id") % 10 == 0, "small").otherwise("large"))
    asked = [(i, f"w{i % 40:02d} w{i * 7 % 40:02d} w05", "small" if i % 4 == 0 else "large") for i in range(60)]
    asked += [(90, "w01", "none"), (91, "w01", None), (92, "", "small")]
    asked = spark.createDataFrame(asked, "request_id long, t string, cluster string").withColumn("tokens", tokens_ws("t"))
    for threshold in (0.05, 0.0):
        at = asked.withColumn("threshold", F.lit(threshold))
        few, many = (rows_of(retrieve(index, at, clusters, max_broadcast_requests=n)) for n in (256, 0))
        key = lambda found: [(*r[:5], round(r[5], 9)) for r in found]
        assert key(few) == key(many) and few
    sides = [spark.createDataFrame([("small", 2), ("large", k)], "grp string, blocks int") for k in (5, 11)]
    assert blocks.group_cells(*sides).count() == 2 * 2 + 5 * 11


def test_a_company_that_many_rows_name(spark):
    from profilematch.plans.requests import attach_companies

    ranked = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(300)] + [(300, None), (301, 999)], "request_id long, id long")
    companies = spark.createDataFrame([(i, f"c{i}") for i in range(300)], "key long, name string")
    got = attach_companies(ranked, companies, "name", id_col="key").collect()
    assert len(got) == 300 and all(r.name == f"c{r.id}" for r in got)
    assert attach_companies(ranked, companies, "name", id_col="key", how="left").count() == 302
