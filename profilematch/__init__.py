"""Profile matching on Spark: text normalisation, TF-IDF retrieval, recommendation, reports.

Every job takes tables and returns tables; requests come in batches as a request table.
"""

from profilematch.operators.lookup import Dictionaries, normalize_text
from profilematch.operators.tfidf import Index, fit_index
from profilematch.plans.find import find_similar, similar_pairs, similar_profiles
from profilematch.plans.recommend import recommend, retrieve
from profilematch.plans.search import search

__all__ = [
    "Dictionaries",
    "Index",
    "find_similar",
    "fit_index",
    "normalize_text",
    "recommend",
    "retrieve",
    "search",
    "similar_pairs",
    "similar_profiles",
]
