import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from profilematch import fit_index, retrieve
from profilematch.operators import features
from profilematch.plans import models, reports
from profilematch.plans.requests import route_requests, unmatched_requests


@pytest.mark.parametrize("limit", [256, 0])
def test_retrieve_by_cluster_and_threshold(spark, limit):
    words = {0: "a b c d", 1: "a x y z u v w q", 2: "a a", 3: "a b", 4: "k l"}
    docs = spark.createDataFrame([(i, t.split()) for i, t in words.items()], "id long, tokens array<string>")
    clusters = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 1), (4, 1)], "id long, cluster int")
    index = fit_index(docs, "id", "tokens", "smooth")
    asked = spark.createDataFrame(
        [("strict", ["a", "b"], 1, 0.3), ("all", ["b"], 1, 0.0), ("none", ["k"], 2, 0.1), ("lost", ["a"], 9, 0.0)],
        "request_id string, tokens array<string>, cluster int, threshold double",
    )
    found = retrieve(index, asked, clusters, max_broadcast_requests=limit)
    by_request = {}
    for r in sorted(found.collect(), key=lambda r: (r.request_id, r["rank"])):
        assert r.display_no == r.id + 1
        by_request.setdefault(r.request_id, []).append(r.id)
    assert by_request == {"strict": [3, 0], "all": [3, 0, 1, 4]}
    assert {r.request_id for r in unmatched_requests(asked, found).collect()} == {"none", "lost"}


def test_routing(spark):
    asked = spark.createDataFrame(
        [(1, " x ", 5), (2, " \t", 5), (3, None, None)], "request_id long, query_text string, company_id long"
    )
    assert [r.route for r in route_requests(asked).orderBy("request_id").collect()] == ["search", "find", "rejected"]


def test_one_hot(spark):
    fitted = features.encoded_columns(spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "f string"), ["f"])
    asked = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id long, f string")
    wide = features.one_hot_wide(asked, "id", ["f"], fitted)
    assert [tuple(r) for r in wide.orderBy("id").collect()] == [(1, 1, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0)]
    assert [tuple(r) for r in features.one_hot_long(asked, "id", ["f"], fitted).collect()] == [(1, "f_a")]


def test_reports(spark):
    companies = spark.createDataFrame([(0, "A", 1, "x"), (1, "B", 2, None), (2, "A", 2, "x")], "id long, company_name string, cluster int, country string")
    assert {r.name: r.id for r in reports.name_to_id(companies).collect()} == {"A": 2, "B": 1}
    assert [r.name for r in reports.sorted_names(companies).collect()] == ["A", "B"]
    assert tuple(reports.overview_metrics(companies).first()) == (3, 2)
    assert tuple(reports.category_distribution(companies, ["country"]).first()) == ("country", "x", 2, 1.0)
    card = reports.company_card(companies).first()
    assert card.country == "x" and card.company_size == "N/A" and "company_overview" not in card.asDict()
    shown = reports.score_display(spark.createDataFrame([(0, -1.0), (1, 0.12344)], "id long, similarity double"))
    assert [(r.clipped, r.score_text, r.short_text) for r in reports.chart_rows(shown).collect()] == [
        (0.0, "-1.0000", "-1.000"),
        (0.12344, "0.1234", "0.123"),
    ]


@pytest.fixture(scope="module")
def points(spark):
    import random

    rng = random.Random(3)
    data = [(i, [rng.gauss(3 * (i % 3 == k), 1) for k in range(4)], i % 3) for i in range(150)]
    return spark.createDataFrame(data, "id long, vector array<double>, label int").cache()


def test_knn_equals_brute_force(points):
    rows = points.collect()
    train, test = points.where("id >= 50"), points.where("id < 50")
    expected = {}
    for t in rows[:50]:
        def far(r, t=t):
            return (round(sum((x - y) ** 2 for x, y in zip(t.vector, r.vector, strict=True)) ** 0.5, 8), r.id)
        near = sorted(rows[50:], key=far)[:5]
        labels = [r.label for r in near]
        expected[t.id] = min(set(labels), key=lambda x: (-labels.count(x), x))
    found = {r.id: r.prediction for r in models.knn_classify(train, test, 5).collect()}
    assert found == expected


def test_pca_is_centred_and_ordered(points):
    data = points.withColumn("v", array_to_vector("vector"))
    pca = models.pca_project(data, "id", "v", 3)
    cols = [F.col("pca")[k] for k in range(3)]
    stats = pca.agg(*[F.avg(c) for c in cols], *[F.var_samp(c) for c in cols]).first()
    assert all(abs(x) < 1e-9 for x in stats[:3])
    assert stats[3] >= stats[4] >= stats[5]


def test_classifiers_beat_the_majority(points):
    data = points.select("id", array_to_vector("vector").alias("features"), "label")
    results = models.compare(data, ["Decision Tree", "Naive Bayes"]).results
    assert all(r.accuracy > 0.5 for r in results.collect())
    assert models.best_model(results).count() == 1
    clusters = models.kmeans_cluster(data, "id", "features", 3)
    assert {r.cluster for r in clusters.collect()} <= {0, 1, 2}


def test_top_clusters_and_split(points):
    top = models.top_clusters(points, "id", "vector", models.centroids(points, "vector", "label"), 2)
    assert top.count() == 300
    pairs = top.groupBy("id").agg(F.min_by("distance", "rank").alias("a"), F.max_by("distance", "rank").alias("b"))
    assert pairs.where("a > b").isEmpty()
    a = {r.id for r in points.where(models.is_train("id")).collect()}
    assert a == {r.id for r in points.repartition(7).where(models.is_train("id")).collect()}


def test_sentiment(spark):
    docs = spark.createDataFrame([("g", ["good", "bad", "good", "x"]), ("h", ["x"])], "k string, tokens array<string>")
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1)], "term string, polarity int")
    rows = {r.group: r for r in reports.sentiment(docs, "k", lexicon).collect()}
    assert (rows["g"].positive, rows["g"].negative, rows["g"].sentiment) == (0.5, 0.25, "positive")
    assert rows["h"].neutral == 1.0 and rows["h"].sentiment == "neutral"
