"""Free-text search: request texts against a fitted corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilematch.functions.text import tokens_word, tokens_ws
from profilematch.operators.lookup import Dictionaries, normalize_text
from profilematch.operators.similarity import (
    MAX_BROADCAST_REQUEST_TERMS,
    MAX_BROADCAST_REQUESTS,
    best_by_blocks,
    fill_short_lists,
    rank_best,
    score_by_broadcast,
    smallest_ids,
)
from profilematch.operators.term_layout import TermLayout, score_by_terms
from profilematch.operators.tfidf import Index, request_counts, request_weights
from profilematch.plans.requests import DEFAULT_TOP_N, model_named, top_n_column
from profilematch.session import fits


def tokenize(df: DataFrame, id_col: str, text_col: str, model: str, dictionaries: Dictionaries | None) -> DataFrame:
    """``df`` plus ``tokens``: normalised when dictionaries are given, then split as the model does."""
    split = tokens_ws if model == "A" else tokens_word
    if dictionaries is None:
        return df.withColumn("tokens", split(text_col))
    clean = normalize_text(df, id_col, text_col, dictionaries, "_normalized")
    return clean.withColumn("tokens", split("_normalized")).drop("_normalized")


def corpus_sizes(index: Index) -> tuple[int, int]:
    """Documents and postings."""
    entries = index.vocab.agg(F.sum("df")).first()[0]
    return index.ids.count(), int(entries or 0)


def search(
    index: Index,
    requests: DataFrame,
    top_n: int = DEFAULT_TOP_N,
    model: str = "A",
    dictionaries: Dictionaries | None = None,
    max_broadcast_requests: int = MAX_BROADCAST_REQUESTS,
    layout: TermLayout | None = None,
) -> DataFrame:
    """(request_id, rank, id, similarity) from requests (request_id, query_text[, top_n]).

    Each request gets ``top_n`` rows (or the whole corpus, if smaller); rows beyond its matches score 0. With the
    index's ``layout`` by term, few requests read only the postings of their terms.
    """
    m = model_named(model)
    wanted, n = top_n_column(requests, top_n)
    asked = tokenize(requests, "request_id", "query_text", model, dictionaries).select(
        "request_id", wanted.alias("top_n"), "tokens"
    )
    counts = request_counts(asked)
    small = fits(asked.select("request_id"), max_broadcast_requests) and fits(counts, MAX_BROADCAST_REQUEST_TERMS)
    terms = request_weights(counts, index.vocab, small)
    if small and layout is not None:
        scored = score_by_terms(layout, terms, n)
    elif small:
        scored = score_by_broadcast(terms, index.weights)
    else:
        sizes = (asked.count(), counts.count(), *corpus_sizes(index))
        scored = best_by_blocks(terms, index.weights, sizes, n, m.ties)
    ranked = rank_best(scored, n, m.ties)
    filled = fill_short_lists(ranked, asked.select("request_id", "top_n"), smallest_ids(index.ids, 2 * n, m.ties))
    return filled.select("request_id", "rank", "id", rounded("sim", m.places).alias("similarity"))


def rounded(score: str, places: int | None):
    return F.col(score) if places is None else F.round(score, places)
