"""A recommender as one artefact: fitted, chosen, saved and loaded as a whole.

It holds the text index, the feature stages and the chosen classifier as one pipeline, the clustered companies, and what
was measured when it was fitted. A saved recommender is a folder with one folder for each version. The parts of a version
are written first and its manifest last, so a version without a manifest is one whose job was lost: loading passes over
it. A manifest names the parts with their row counts, and loading checks them.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilematch.operators.features import MAX_TERMS, SEED, fit_features
from profilematch.operators.lookup import Dictionaries
from profilematch.operators.tfidf import Index, fit_index
from profilematch.plans import models
from profilematch.plans.recommend import recommend
from profilematch.plans.requests import RECOMMEND_LIMIT
from profilematch.session import materialize
from profilematch.sources.artefacts import exists, load_pipeline, require, save_pipeline

PARTS = ("index", "pipeline", "clusters", "results")
MANIFEST = "version string, fields array<string>, best_model string, best_accuracy double, companies long, terms long, models long"


@dataclass(frozen=True)
class Recommender:
    """``pipeline`` predicts the cluster of a request from ``fields`` and ``tokens``; ``results`` has (model, accuracy)."""

    index: Index
    pipeline: PipelineModel
    clusters: DataFrame
    results: DataFrame
    fields: list[str]
    best_model: str
    best_accuracy: float

    def recommend(
        self, requests: DataFrame, limit: int = RECOMMEND_LIMIT, dictionaries: Dictionaries | None = None
    ) -> DataFrame:
        return recommend(self.index, self.pipeline, requests, self.clusters, limit, dictionaries)

    def save(self, path: str) -> str:
        """Write a new version under ``path`` and return its name. Versions are ordered by their names."""
        version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        folder = os.path.join(path, version)
        self.index.save(os.path.join(folder, "index"))
        save_pipeline(self.pipeline, os.path.join(folder, "pipeline"))
        self.clusters.select("id", "cluster").write.parquet(os.path.join(folder, "clusters"))
        self.results.select("model", "accuracy").write.parquet(os.path.join(folder, "results"))
        counts = [
            self.clusters.agg(F.count(F.lit(1))).scalar().alias("companies"),
            self.index.vocab.agg(F.count(F.lit(1))).scalar().alias("terms"),
            self.results.agg(F.count(F.lit(1))).scalar().alias("models"),
        ]
        manifest = self.index.vocab.sparkSession.range(1).select(
            F.lit(version).alias("version"),
            F.array(*[F.lit(f) for f in self.fields]).cast("array<string>").alias("fields"),
            F.lit(self.best_model).alias("best_model"),
            F.lit(self.best_accuracy).alias("best_accuracy"),
            *counts,
        )
        manifest.write.json(os.path.join(folder, "manifest"))
        return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The manifests of all whole versions under ``path``, newest first."""
    try:
        found = spark.read.schema(MANIFEST).json(os.path.join(path, "*", "manifest"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{path} has no whole recommender: fit and save it first") from error
    return found.orderBy(F.desc("version"))


def load_recommender(spark: SparkSession, path: str, version: str | None = None) -> Recommender:
    """The newest whole version under ``path``, or the one named. Its parts are checked against its manifest."""
    listed = versions(spark, path)
    meta = (listed if version is None else listed.where(F.col("version") == version)).first()
    if meta is None:
        raise FileNotFoundError(f"{path} has no whole recommender {version or ''}: fit and save it first")
    folder = os.path.join(path, meta["version"])
    missing = [part for part in PARTS if not exists(spark, os.path.join(folder, part))]
    if missing:
        raise ValueError(f"the recommender {folder} is broken: {', '.join(missing)} missing")
    index = Index.load(spark, os.path.join(folder, "index"))
    pipeline = load_pipeline(spark, os.path.join(folder, "pipeline"))
    clusters = spark.read.schema("id long, cluster int").parquet(require(spark, os.path.join(folder, "clusters")))
    results = spark.read.schema("model string, accuracy double").parquet(os.path.join(folder, "results"))
    for name, df in (("companies", clusters), ("terms", index.vocab), ("models", results)):
        if (n := df.count()) != meta[name]:
            raise ValueError(f"the recommender {folder} is broken: {n} {name} instead of {meta[name]}")
    return Recommender(index, pipeline, clusters, results, list(meta["fields"]), meta["best_model"], meta["best_accuracy"])


def fit_recommender(
    companies: DataFrame,
    fields: list[str],
    clusters: int = 5,
    names: list[str] | None = None,
    max_terms: int = MAX_TERMS,
) -> Recommender:
    """From companies (id, the categorical ``fields``, tokens): index, features, clusters, and the best of the classifiers.

    Classifiers are compared on the held-out fifth of the companies; the best one (ties: the smaller name) is fitted on
    that split and kept. ``names`` limits the candidates.
    """
    companies = companies.select("id", *fields, "tokens")
    index = fit_index(companies, "id", "tokens", "smooth", max_terms)
    prepared = fit_features(companies, fields, index.vocab)
    # every pass of the fits below reads the features
    data = materialize(prepared.transform(companies).select("id", "features"), "features")
    kmeans = KMeans(k=clusters, seed=SEED, featuresCol="features", predictionCol="label").fit(data)
    labelled = materialize(kmeans.transform(data), "labelled")
    compared = models.compare(labelled, names)
    results = materialize(compared.results, "results")
    best = models.best_model(results).first()
    pipeline = PipelineModel(stages=[*prepared.stages, compared.models[best["best_model"]]])
    assigned = labelled.select("id", F.col("label").cast("int").alias("cluster"))
    return Recommender(index, pipeline, assigned, results, fields, best["best_model"], best["best_accuracy"])
