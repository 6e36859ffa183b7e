"""Queries over files: each writes rows of a given table to the shared folder and reads them back with the library."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from catalogue import queries as Q
from profilematch.operators.tfidf import Index
from profilematch.plans import reports
from profilematch.plans.search import search
from profilematch.session import job, shared_folder
from profilematch.sources.artefacts import require, write_results
from profilematch.sources.dictionaries import read_term_map, read_word_list
from profilematch.sources.tables import read_companies


def folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "profilematch", f"{name}-{uuid.uuid4().hex}")


def term_map_file(spark, sf):
    """One term per part, among lines without a tab."""
    parts = Q.table(spark, sf, "part")
    lines = parts.select(F.concat_ws("\t", F.concat_ws("-", "p_name", "p_partkey"), F.concat_ws("\t", "p_brand", "p_type")).alias("value"))
    lines.unionByName(parts.select(F.col("p_type").alias("value"))).write.text(path := folder(spark, "terms"))
    return read_term_map(spark, path)


def term_map_file_trimmed(spark, sf):
    parts = Q.table(spark, sf, "part")
    value = F.concat(F.lit("  "), F.concat_ws("-", "p_name", "p_partkey"), F.lit("\t"), F.col("p_brand"), F.lit(" \t "))
    parts.select(value.alias("value")).write.text(path := folder(spark, "terms"))
    return read_term_map(spark, path, strip=True)


def word_list_file(spark, sf):
    Q.table(spark, sf, "part").select(F.col("p_name").alias("value")).write.text(path := folder(spark, "words"))
    return read_word_list(spark, path)


def _customers(spark, sf):
    return Q.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Id"),
        F.col("c_name").alias("Company name"),
        F.concat("c_mktsegment", F.lit('\n"quoted", second line')).alias("Company overview"),
        F.col("c_mktsegment").alias("Company type"),
    )


def companies_csv(spark, sf):
    _customers(spark, sf).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path := folder(spark, "csv"))
    return read_companies(spark, path, "csv").select("id", "company_name", "company_overview", "company_type")


def companies_parquet(spark, sf):
    _customers(spark, sf).write.parquet(path := folder(spark, "parquet"))
    return read_companies(spark, path).select("id", "company_name", "company_overview", "company_type")


def search_a_loaded(spark, sf):
    """The index of search_a, saved and loaded before it is asked."""
    Q.index(spark, sf, "A").save(path := folder(spark, "index"))
    found = search(Index.load(spark, path), Q.benchmark_requests(spark, sf), 5, "A", Q.dictionaries(spark))
    return found.withColumn("similarity", F.round("similarity", 6))


def search_a_in_job(spark, sf):
    """search_a as a job that drops its steps and keeps its result."""
    with job(spark) as running:
        return running.keep(Q.QUERIES["search_a"](spark, sf))


def written_results(spark, sf):
    write_results(Q.point_lookup(spark, sf), path := folder(spark, "results"))
    return spark.read.parquet(require(spark, path))


def model_report_files(spark, sf):
    """The two families of model_report as CSV and flat JSON files, read by the report job."""
    results = Q.materialize(Q.model_report(spark, sf), "families")
    neighbours = results.where("family = 'neighbours'").select(F.col("model").alias(" "), "accuracy")
    neighbours.write.option("header", True).csv(csv := folder(spark, "csv"))
    pairs = F.map_from_entries(F.collect_list(F.struct("model", "accuracy")))
    results.where("family = 'centroids'").agg(F.to_json(pairs).alias("value")).write.text(flat := folder(spark, "json"))
    best = Q.models.best_model(results).withColumns({"sklearn_models": F.array(F.lit("KNN 1")), "pyspark_models": F.array(F.lit("x"))})
    best.write.json(meta := folder(spark, "meta"))
    report = reports.model_report(spark, csv, flat, meta)
    recorded = report["best"].select(F.col("best_model").alias("recorded_best"), "best_accuracy_text")
    rounded = report["results"].select("family", "model", F.round("accuracy", 8).alias("accuracy"))
    return rounded.join(F.broadcast(recorded), how="cross")


FILE_QUERIES = {
    "term_map_file": term_map_file,
    "term_map_file_trimmed": term_map_file_trimmed,
    "word_list_file": word_list_file,
    "companies_csv": companies_csv,
    "companies_parquet": companies_parquet,
    "search_a_loaded": search_a_loaded,
    "search_a_in_job": search_a_in_job,
    "written_results": written_results,
    "model_report_files": model_report_files,
}
