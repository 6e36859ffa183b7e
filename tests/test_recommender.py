"""A recommender is saved and loaded as a whole; lost jobs and damage are noticed."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from profilematch.functions.text import tokens_word
from profilematch.plans import mixed
from profilematch.plans.recommender import fit_recommender, load_recommender, versions

FIELDS = ["kind", "country"]


@pytest.fixture(scope="module")
def fitted(spark):
    words = "java spring cloud python data ai rust go web api".split()
    rows = [(i, "ab"[i % 2], ["vn", "jp", None][i % 3], " ".join(words[(i % 2) * 5 + k % 5] for k in range(i % 7 + 1))) for i in range(120)]
    docs = spark.createDataFrame(rows, "id long, kind string, country string, text string")
    return fit_recommender(docs.withColumn("tokens", tokens_word("text")), FIELDS, 2, ["Decision Tree", "Logistic Regression"])


@pytest.fixture(scope="module")
def asked(spark):
    rows = [(1, "a", "vn", "java cloud", 0.1), (2, "b", None, "ai data", 0.1), (3, "new", "jp", "java", None), (4, "a", "vn", " ", 0.1), (5, "a", "vn", "unknown", 0.1)]
    return spark.createDataFrame(rows, "request_id long, kind string, country string, query_text string, threshold double")


def listed(df):
    return sorted((r.request_id, r.rank, r.id, r.predicted_cluster, round(r.similarity_score, 8)) for r in df.collect())


def test_saved_and_loaded(spark, fitted, asked, tmp_path):
    path = f"{tmp_path}/r"
    first = fitted.save(path)
    loaded = load_recommender(spark, path)
    before = listed(fitted.recommend(asked))
    assert before and listed(loaded.recommend(asked)) == before
    assert loaded.fields == FIELDS and loaded.best_model == fitted.best_model and loaded.best_accuracy == fitted.best_accuracy
    assert {r[0] for r in before} == {1, 2, 3}
    second = fitted.save(path)
    assert [r.version for r in versions(spark, path).collect()] == [second, first]
    assert listed(load_recommender(spark, path, first).recommend(asked)) == before


def test_a_lost_job_leaves_no_version(spark, fitted, tmp_path):
    path = f"{tmp_path}/r"
    with pytest.raises(FileNotFoundError, match="fit and save it first"):
        load_recommender(spark, path)
    whole = fitted.save(path)
    lost = f"{path}/99990101T000000000000-aaaaaaaa"
    fitted.clusters.write.parquet(f"{lost}/clusters")
    assert [r.version for r in versions(spark, path).collect()] == [whole]
    assert load_recommender(spark, path).clusters.count() == 120
    with pytest.raises(FileNotFoundError, match="fit and save it first"):
        load_recommender(spark, path, lost.rsplit("/", 1)[1])


def test_damage_is_noticed(spark, fitted, tmp_path):
    path = f"{tmp_path}/r"
    folder = f"{path}/{fitted.save(path)}"
    fitted.clusters.where("id < 50").write.mode("overwrite").parquet(f"{folder}/clusters")
    with pytest.raises(ValueError, match="broken: 50 companies instead of 120"):
        load_recommender(spark, path)
    shutil.rmtree(f"{folder}/clusters")
    with pytest.raises(ValueError, match="broken: clusters missing"):
        load_recommender(spark, path)


def test_mixed_job_predicts(spark, fitted, asked):
    """The pipeline predicts clusters in the mixed job too, and shows them for requests without companies."""
    own = fitted.index
    index = mixed.mixed_index(own, own, own, fitted.clusters)
    requests = asked.select("*", F.lit("recommend").alias("job"), F.lit("A").alias("model"), F.lit(None).cast("long").alias("company_id"))
    rows = mixed.answer(index, requests, fitted.pipeline).collect()
    got = sorted((r.request_id, r.rank, r.id, int(r.predicted_cluster), round(r.similarity, 8)) for r in rows if r.rank)
    assert got == listed(fitted.recommend(asked))
    by_id = {r.request_id: r for r in rows}
    assert by_id[5].status == "unmatched" and by_id[5].predicted_cluster is not None and by_id[5].matches == 0
    assert by_id[4].status == "rejected" and by_id[4].predicted_cluster is None
    assert all(r.matches == sum(x.request_id == r.request_id for x in rows) for r in rows if r.rank)
