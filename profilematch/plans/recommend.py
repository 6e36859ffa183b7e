"""Recommendation: predict a cluster for each request, then rank that cluster's companies."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, LongType, StringType

from profilematch.functions.text import is_blank
from profilematch.operators.lookup import Dictionaries
from profilematch.operators.similarity import (
    MAX_BROADCAST_REQUEST_TERMS,
    MAX_BROADCAST_REQUESTS,
    best_in_groups,
    fill_short_lists,
    rank_best,
)
from profilematch.operators.skew import MAX_BROADCAST_ROWS, expand_join
from profilematch.operators.tfidf import Index, request_counts, request_weights
from profilematch.plans.requests import RECOMMEND_LIMIT, threshold_column
from profilematch.plans.search import tokenize
from profilematch.session import fits


def retrieve(
    index: Index,
    requests: DataFrame,
    clusters: DataFrame,
    limit: int = RECOMMEND_LIMIT,
    max_broadcast_requests: int = MAX_BROADCAST_REQUESTS,
) -> DataFrame:
    """(request_id, rank, id, display_no, predicted_cluster, similarity_score).

    ``requests``: (request_id, tokens, cluster[, threshold]); ``clusters``: (id, cluster). The cluster is
    part of the join key, so companies of other clusters are never scored. Scores at the threshold stay.
    """
    asked = requests.select("request_id", "tokens", "cluster", threshold_column(requests).alias("threshold"))
    shared = _shared_type(asked.schema["cluster"].dataType, clusters.schema["cluster"].dataType)
    clusters = clusters.withColumn("cluster", F.col("cluster").cast(shared))
    shown = asked.select("request_id", F.col("cluster").alias("predicted_cluster"))
    asked = asked.withColumn("cluster", F.col("cluster").cast(shared))
    counts = request_counts(asked)
    small = fits(asked.select("request_id"), max_broadcast_requests) and fits(counts, MAX_BROADCAST_REQUEST_TERMS)
    terms = request_weights(counts, index.vocab, small)
    per_request = asked.select("request_id", "cluster", "threshold")
    if small:
        keyed = terms.withColumnRenamed("w", "request_w").join(F.broadcast(per_request), "request_id")
        scored = (
            index.weights.join(clusters.select("id", "cluster"), "id")
            .join(F.broadcast(keyed), ["cluster", "term"])
            .groupBy("id", "request_id", "threshold")
            .agg(F.sum(F.col("w") * F.col("request_w")).alias("sim"))
            # Compared after the rounding that also ranks, so that summation order cannot decide.
            .where(F.round("sim", 10) >= F.col("threshold"))
            .select("request_id", "id", "sim")
        )
    else:
        extra = per_request.select("request_id", F.col("cluster").alias("grp"), "threshold")
        groups = clusters.select("id", F.col("cluster").alias("grp"))
        scored = best_in_groups(terms, index.weights, extra, groups, limit)
    ranked = rank_best(scored, limit)
    # Only a threshold of 0 lets companies without a common term in.
    first = W.partitionBy("cluster").orderBy("id")
    heads = (
        clusters.select("cluster", "id")
        .withColumn("k", F.row_number().over(first))
        .where(F.col("k") <= 2 * limit)
        .groupBy("cluster")
        .agg(F.sort_array(F.collect_list("id")).alias("head"))
    )
    few_clusters = fits(clusters.select("cluster").distinct(), MAX_BROADCAST_ROWS)
    wanted = expand_join(per_request, heads, "cluster", "request_id", few_clusters, how="left")
    wanted = wanted.withColumn("top_n", F.lit(limit))
    padding = F.when((F.col("threshold") <= 0) & F.col("head").isNotNull(), F.col("head"))
    filled = fill_short_lists(ranked, wanted, padding)
    return filled.join(shown, "request_id").select(
        "request_id",
        "rank",
        "id",
        (F.col("id") + 1).alias("display_no"),
        "predicted_cluster",
        F.col("sim").alias("similarity_score"),
    )


def _shared_type(a: DataType, b: DataType) -> DataType:
    """The type in which clusters of both sides are compared, whichever way the rows meet."""
    if a == b:
        return a
    return LongType() if isinstance(a, IntegralType) and isinstance(b, IntegralType) else StringType()


def recommend(
    index: Index,
    pipeline: PipelineModel,
    requests: DataFrame,
    clusters: DataFrame,
    limit: int = RECOMMEND_LIMIT,
    dictionaries: Dictionaries | None = None,
) -> DataFrame:
    """Requests: (request_id, the categorical fields of the pipeline, query_text[, threshold]).

    Blank texts are rejected. ``pipeline`` predicts from the fields and ``tokens``.
    """
    asked = requests.where(~is_blank("query_text"))
    asked = tokenize(asked, "request_id", "query_text", "B", dictionaries)
    predicted = pipeline.transform(asked).withColumn("cluster", F.col("prediction").cast("int"))
    columns = ["request_id", "tokens", "cluster"] + [c for c in ("threshold",) if c in requests.columns]
    return retrieve(index, predicted.select(*columns), clusters, limit)
