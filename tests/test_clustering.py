"""K-means under several partitionings, beside a plain version; PCA beside NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from profilematch.operators import features
from profilematch.plans import clustering, models


@pytest.fixture(scope="module")
def blobs(spark):
    r = np.random.default_rng(5)
    centres = np.array([[0, 0, 0], [9, 0, 1], [0, 9, 2], [9, 9, 3]], float)
    sizes = [120, 80, 60, 40]
    x = np.concatenate([c + r.normal(size=(n, 3)) for c, n in zip(centres, sizes)])
    rows = [(i, [float(v) for v in own]) for i, own in enumerate(x)]
    return x, sizes, spark.createDataFrame(rows, "id long, vector array<double>")


def test_one_result_under_any_partitioning(blobs):
    x, sizes, data = blobs
    results = []
    for own in (data.coalesce(1), data.repartition(7), data.repartition(4, F.col("id") % 3)):
        points = clustering.prepared(own, "id", "vector")
        fitted = clustering.fit(points, 4)
        results.append({r.id: r.cluster for r in clustering.assign(points, fitted).collect()})
        assert fitted.sizes == sizes
    assert results[0] == results[1] == results[2]
    labels = np.array([results[0][i] for i in range(len(x))])
    means = np.array([x[labels == k].mean(axis=0) for k in range(4)])
    assert np.allclose(means, fitted.centres)
    far = np.linalg.norm(x[:, None] - means[None], axis=2)
    assert (far.argmin(axis=1) == labels).all()
    near, second = np.sort(far, axis=1)[:, :2].T
    assert fitted.silhouette == pytest.approx(np.mean((second - near) / second))


def test_choice_of_k(blobs):
    points = clustering.prepared(blobs[2], "id", "vector")
    best, report = clustering.choose(points, [2, 3, 4, 6])
    assert len(best.sizes) == 4
    assert {r.k: r.clusters for r in report.collect()} == {2: 2, 3: 3, 4: 4, 6: 6}


def test_odd_rows_of_kmeans(spark):
    rows = [(1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [5.0, 5.0]), (4, None), (5, [1.0, 1.0])]
    data = spark.createDataFrame(rows, "id long, vector array<double>")
    points = clustering.prepared(data, "id", "vector")
    fitted = clustering.fit(points, 5)
    assert fitted.sizes == [3, 1]
    assert {r.id: r.cluster for r in clustering.assign(points, fitted).collect()} == {1: 0, 2: 0, 5: 0, 3: 1}
    none = clustering.prepared(data.limit(0), "id", "vector")
    assert clustering.fit(none, 3).sizes == [] and clustering.assign(none, clustering.fit(none, 3)).count() == 0
    with pytest.raises(ValueError):
        clustering.fit(points, clustering.MAX_NUMBERS)


def test_pca_equals_numpy_with_fixed_signs(blobs):
    x, _, data = blobs
    named = data.withColumn("v", array_to_vector("vector"))
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(np.cov(centred.T))
    vectors = vectors[:, np.argsort(-values)]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, range(3)])
    for own in (named.coalesce(1), named.repartition(5)):
        scores = {r.id: r.pca for r in models.pca_project(own, "id", "v", 3).collect()}
        assert np.allclose([scores[i] for i in range(len(x))], centred @ vectors, atol=1e-6)


def test_width_is_checked_before_pca(blobs, monkeypatch):
    monkeypatch.setattr(features, "MAX_PCA_WIDTH", 2)
    with pytest.raises(ValueError):
        models.pca_project(blobs[2].withColumn("v", array_to_vector("vector")), "id", "v", 2)
