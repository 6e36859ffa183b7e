"""One job for unlike requests against the jobs that answer each kind alone; models beside a user's Observation."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from profilematch import fit_index
from profilematch.functions.text import tokens_word, tokens_ws
from profilematch.plans import mixed, models
from profilematch.plans.find import find_similar
from profilematch.plans.recommend import retrieve
from profilematch.plans.search import search

WORDS = "java spring cloud python data ai rust go web api team lead".split()
SCHEMA = (
    "request_id long, job string, model string, query_text string, company_id long, top_n int, cluster string, threshold double"
)


@pytest.fixture(scope="module")
def companies(spark):
    rows = [(i, " ".join(WORDS[(i * k) % 12] for k in range(1, 2 + i % 6)), "even" if i % 3 else "odd") for i in range(14)]
    return spark.createDataFrame([*rows, (14, "", "odd"), (15, "zz zz", None)], "id long, text string, cluster string").repartition(3)


@pytest.fixture(scope="module")
def index(companies):
    a = companies.withColumn("tokens", tokens_ws("text"))
    b = companies.withColumn("tokens", tokens_word("text"))
    own = [fit_index(a, "id", "tokens", "log2"), fit_index(b, "id", "tokens", "smooth"), fit_index(b, "id", "tokens", "smooth", 6)]
    return own, mixed.mixed_index(*own, companies.where("cluster is not null").select("id", "cluster"))


@pytest.fixture(scope="module")
def requests(spark):
    rows = []
    for i in range(60):
        job, model = ("recommend" if i % 4 == 3 else "similar"), "AB"[i % 2]
        text = [None, " ", "java cloud", "python data java", "nowhere", "zz"][i % 6]
        rows.append((i, job, model, text, (i * 3) % 20 if i % 5 else None, i % 10 + 1, ["even", "odd", "none", None][i % 4 if i < 40 else i % 3], None if i % 9 else 0.0))
    rows += [(90, "other", "A", "java", 1, None, None, None), (91, "similar", "C", "java", 1, None, None, None), (92, None, None, None, None, None, None, None)]
    rows += [(100 + k, "similar", "A", "java cloud", None, 3, None, None) for k in range(20)]
    return spark.createDataFrame(rows, SCHEMA)


def expected(index, companies, requests):
    """From the single jobs; request_id to [(rank, id, score)]."""
    (a, b, r), _ = index
    asked = mixed.routed(requests).select("request_id", "route", "space")
    rows = requests.join(asked, "request_id")
    out = {}
    for model, fitted in (("A", a), ("B", b)):
        own = rows.where(F.col("space") == model)
        found = search(fitted, own.where("route = 'search'").select("request_id", "query_text", "top_n"), model=model)
        near = find_similar(fitted.stored(), own.where("route = 'find'").select("request_id", "company_id", "top_n"), model=model)
        for x in [*found.collect(), *near.collect()]:
            out.setdefault(x.request_id, []).append((x.rank, x.id, round(x.similarity, 8)))
    own = rows.where("route = 'recommend'").withColumn("tokens", tokens_word("query_text"))
    clusters = companies.where("cluster is not null").select("id", "cluster")
    for x in retrieve(r, own.select("request_id", "tokens", "cluster", "threshold"), clusters).collect():
        out.setdefault(x.request_id, []).append((x.rank, x.id, round(x.similarity_score, 8)))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("few", [1000, 0])
def test_equals_the_single_jobs(index, companies, requests, few):
    rows = mixed.answer(index[1], requests, max_broadcast_requests=few).collect()
    got = {}
    for x in rows:
        if x.rank is not None:
            got.setdefault(x.request_id, []).append((x.rank, x.id, round(x.similarity, 8)))
            assert x.status == "found" and len(x.similarity_text) >= 5
        else:
            assert x.status in ("rejected", "unmatched") and x.matches == 0 and x.id is None and x.similarity_text is None
    assert {k: sorted(v) for k, v in got.items()} == expected(index, companies, requests)
    assert {x.request_id for x in rows} == {x.request_id for x in requests.collect()}
    assert {x.status for x in rows if x.request_id in (90, 91, 92)} == {"rejected"}


def test_columns_and_clusters(index, companies, requests):
    shown = mixed.answer(index[1], requests, companies=companies, columns=["text"]).collect()
    texts = {x.id: x.text for x in companies.collect()}
    assert all(x.text == texts.get(x.id) for x in shown)
    assert {x.predicted_cluster for x in shown if x.route == "recommend"} <= {"even", "odd", "none", None}
    assert all((x.display_no == x.id + 1) if x.route == "recommend" and x.id is not None else x.display_no is None for x in shown)


def test_each_posting_is_read_once(spark, index, requests):
    """The plan that scores all requests scans the postings once, and no request brings a scan of its own."""
    units = mixed._units(mixed.routed(requests), None, None, requests.columns)
    rules = units.select(F.col("unit").alias("request_id"), *mixed.RULES)
    terms = spark.createDataFrame([("u", "A:java", 1.0)], "request_id string, term string, w double")
    plan = mixed.score_units(index[1], terms, rules, True)._jdf.queryExecution().optimizedPlan().toString()
    name = index[1].weights._jdf.queryExecution().analyzed().toString().split("\n")[0]
    table = name.split("profilematch_")[1][:32]
    assert plan.count(table) == 1


def test_no_requests(index, requests):
    assert mixed.answer(index[1], requests.where("false")).collect() == []


def test_models_beside_an_observation(spark):
    """An Observation gives the session a part that can't be sent to tasks; fitted models must not carry it along."""
    seen = Observation()
    spark.range(5).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 5
    rows = [(i, [float(i % 2), float(i % 3)], i % 2) for i in range(120)]
    data = spark.createDataFrame(rows, "id long, v array<double>, label int")
    data = data.select("id", array_to_vector("v").alias("features"), "label")
    for name in ("Logistic Regression", "Random Forest", "SVM"):
        predicted = models.classify(data, name).collect()
        assert predicted and all(r.label == r.prediction for r in predicted)
    compared = models.compare(data, ["SVM", "Decision Tree"]).results.collect()
    assert [r.accuracy for r in compared] == [1.0, 1.0]
