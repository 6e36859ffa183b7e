"""Reports: distributions, term counts, sentiment, company cards, model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilematch.functions.scores import clip01, fixed, percent
from profilematch.operators.features import field_values
from profilematch.operators.tfidf import exploded
from profilematch.plans.models import best_model
from profilematch.session import fits
from profilematch.sources.results import read_results_csv, read_results_json, read_training_meta

# What a card shows for a field that the table does not have.
MISSING_FIELD = "N/A"
CARD_FIELDS = (
    "company_industry", "company_size", "country", "company_type",
    "working_days", "overtime_policy", "location", "href",
)
CARD_TEXTS = ("company_overview", "why_youll_love_working_here", "our_key_skills")

MAX_LEXICON = 1_000_000


def overview_metrics(clustered: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """(total_companies, n_clusters)."""
    return clustered.agg(
        F.count(F.lit(1)).alias("total_companies"), F.count_distinct(cluster_col).alias("n_clusters")
    )


def with_share(counts: DataFrame, *within: str) -> DataFrame:
    """Add ``share`` of ``n`` in its group. The counts are joined to their own total, not put in one task."""
    if not within:
        return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())
    totals = counts.groupBy(*within).agg(F.sum("n").alias("_total"))
    return counts.join(totals, list(within)).withColumn("share", F.col("n") / F.col("_total")).drop("_total")


def cluster_distribution(clustered: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """(cluster, n, share)."""
    counts = clustered.groupBy(F.col(cluster_col).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts)


def category_distribution(companies: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, n, share) over the non-null values of each field."""
    counts = field_values(companies, fields).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, "field")


def category_values(companies: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value): the choices of each field."""
    return field_values(companies, fields).distinct()


def name_to_id(companies: DataFrame, name_col: str = "company_name", id_col: str = "id") -> DataFrame:
    """(name, id): a repeated name maps to its last row, which has the largest id."""
    return companies.groupBy(F.col(name_col).alias("name")).agg(F.max(id_col).alias("id"))


def sorted_names(companies: DataFrame, name_col: str = "company_name") -> DataFrame:
    return companies.select(F.col(name_col).alias("name")).distinct().orderBy("name")


def company_card(companies: DataFrame, fields=CARD_FIELDS, texts=CARD_TEXTS, keep=("id", "company_name")) -> DataFrame:
    """Card columns. A short field that the table lacks shows a default; a lacking text block is left out."""
    shown = [F.col(f) if f in companies.columns else F.lit(MISSING_FIELD).alias(f) for f in fields]
    return companies.select(*keep, *shown, *[t for t in texts if t in companies.columns])


def score_display(ranked: DataFrame, score_col: str = "similarity") -> DataFrame:
    """Add the clipped score and its texts with 4 and 3 decimals; the score itself stays."""
    return (
        ranked.withColumn("clipped", clip01(score_col))
        .withColumn("score_text", fixed(score_col, 4))
        .withColumn("short_text", fixed(score_col, 3))
    )


def chart_rows(ranked: DataFrame, score_col: str = "similarity") -> DataFrame:
    """Ascending by score, as a bar chart is drawn."""
    return ranked.orderBy(F.asc(score_col), "id")


def sentiment(docs: DataFrame, group_col: str, lexicon: DataFrame) -> DataFrame:
    """(group, positive, neutral, negative, sentiment) from (group, tokens) and a (term, polarity) lexicon.

    Shares of tokens by the sign of their polarity; a token outside the lexicon is neutral. The label
    is the sign of the summed polarity.
    """
    tokens = exploded(docs.withColumnRenamed(group_col, "group"), "group")
    # Words are counted before the lookup, so a large group shuffles its distinct words only.
    counts = tokens.groupBy("group", "term").agg(F.count(F.lit(1)).alias("n"))
    known = F.broadcast(lexicon) if fits(lexicon, MAX_LEXICON) else lexicon
    polarity = F.coalesce("polarity", F.lit(0))
    scored = counts.join(known, "term", "left").withColumn("p", polarity)
    total = F.sum("n")
    sums = scored.groupBy("group").agg(
        (F.sum(F.when(F.col("p") > 0, F.col("n")).otherwise(0)) / total).alias("positive"),
        (F.sum(F.when(F.col("p") == 0, F.col("n")).otherwise(0)) / total).alias("neutral"),
        (F.sum(F.when(F.col("p") < 0, F.col("n")).otherwise(0)) / total).alias("negative"),
        F.sum(F.col("p") * F.col("n")).alias("_sum"),
    )
    label = F.when(F.col("_sum") > 0, "positive").when(F.col("_sum") < 0, "negative").otherwise("neutral")
    return sums.withColumn("sentiment", label).drop("_sum")


def combine_results(**families: DataFrame) -> DataFrame:
    """(family, model, accuracy, accuracy_pct) of several result tables."""
    out = None
    for family, results in families.items():
        rows = results.select(F.lit(family).alias("family"), "model", "accuracy")
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("accuracy_pct", percent("accuracy"))


def model_report(spark: SparkSession, csv_path: str, json_path: str, meta_path: str) -> dict[str, DataFrame]:
    """``results``: both families; ``best``: the recorded best model; ``computed_best``: over ``results``."""
    results = combine_results(
        sklearn=read_results_csv(spark, csv_path), pyspark=read_results_json(spark, json_path)
    )
    meta = read_training_meta(spark, meta_path)
    recorded = meta.select(
        "best_model",
        "best_accuracy",
        F.format_string("%.2f%%", percent("best_accuracy")).alias("best_accuracy_text"),
    )
    return {"results": results, "best": recorded, "computed_best": best_model(results)}
