"""Request tables: parameters, routing, requests without a result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilematch.functions.text import is_blank
from profilematch.operators.skew import MAX_BROADCAST_ROWS, expand_join
from profilematch.session import fits, materialize

# Fixed values.
MIN_TOP_N, MAX_TOP_N, DEFAULT_TOP_N = 1, 10, 5
DEFAULT_THRESHOLD = 0.1
RECOMMEND_LIMIT = 10


@dataclass(frozen=True)
class Model:
    """A: log2 weighting, whitespace tokens, ties to the smaller id, scores to 4 places.
    B: smooth weighting, word tokens, ties to the larger id, scores as they are."""

    formula: str
    ties: str
    places: int | None


MODELS = {"A": Model("log2", "asc", 4), "B": Model("smooth", "desc", None)}


def model_named(name: str) -> Model:
    if name not in MODELS:
        raise ValueError(f"model must be one of {sorted(MODELS)}, not {name!r}")
    return MODELS[name]


def top_n_column(requests: DataFrame, top_n: int) -> tuple[Column, int]:
    """The per-request number of results and its largest possible value."""
    if "top_n" not in requests.columns:
        if not MIN_TOP_N <= top_n <= MAX_TOP_N:
            raise ValueError(f"top_n must be {MIN_TOP_N}..{MAX_TOP_N}")
        return F.lit(top_n), top_n
    wanted = F.coalesce(F.col("top_n").cast("int"), F.lit(DEFAULT_TOP_N))
    message = F.lit(f"top_n must be {MIN_TOP_N}..{MAX_TOP_N}")
    return F.when(wanted.between(MIN_TOP_N, MAX_TOP_N), wanted).otherwise(F.raise_error(message)), MAX_TOP_N


def threshold_column(requests: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> Column:
    if "threshold" not in requests.columns:
        if not 0 <= threshold <= 1:
            raise ValueError("threshold must be 0..1")
        return F.lit(float(threshold))
    wanted = F.coalesce(F.col("threshold").cast("double"), F.lit(DEFAULT_THRESHOLD))
    return F.when(wanted.between(0, 1), wanted).otherwise(F.raise_error(F.lit("threshold must be 0..1")))


def route_requests(requests: DataFrame) -> DataFrame:
    """Add ``route``: non-blank text is searched, else a chosen company is looked up, else rejected."""
    return requests.withColumn(
        "route",
        F.when(~is_blank("query_text"), "search").when(F.col("company_id").isNotNull(), "find").otherwise("rejected"),
    )


def unmatched_requests(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests that got no row."""
    return requests.join(results.select("request_id").distinct(), "request_id", "left_anti")


def attach_companies(
    ranked: DataFrame, companies: DataFrame, *columns: str, id_col: str = "id", how: str = "inner"
) -> DataFrame:
    """Company columns for ranked ids. Only these columns of the company table are read, and only asked companies move.

    One company may be in a third of all rows, so the rows are not shuffled by its id alone.
    """
    ranked = materialize(ranked, "ranked")
    asked = ranked.where(F.col("id").isNotNull()).select("id").distinct()
    wanted = companies.select(F.col(id_col).alias("id"), *columns).join(asked, "id", "left_semi")
    wanted = materialize(wanted, "asked-companies")
    return expand_join(ranked, wanted, "id", F.struct(*ranked.columns), fits(wanted, MAX_BROADCAST_ROWS), how)
