"""Term counts, document frequencies, TF-IDF weights.

Two weightings:

* ``log2``:   tf * log2(N / df); a term found in every document has weight 0 and is left out.
* ``smooth``: tf * (ln((1 + N) / (1 + df)) + 1).

Both give unit-length documents. N counts every document, those without any term included.

The corpus is hash-partitioned by document id once. Its term counts are written as a table bucketed by
id: the text is tokenised once, and weighting, norms and later scoring, which all group by id, do not
shuffle the postings again.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profilematch.session import bucket_count, fits, materialize, materialize_by, partition_by, read_bucketed, sizes_for, write_bucketed

FORMULAS = ("log2", "smooth")
# A vocabulary up to this many rows is broadcast whole; of a larger one, its frequent terms are, at most this many.
MAX_BROADCAST_TERMS = 2_000_000


def _idf(formula: str, n: Column) -> Column:
    if formula == "log2":
        return F.log2(n / F.col("df"))
    if formula == "smooth":
        return F.log((1 + n) / (1 + F.col("df"))) + 1
    raise ValueError(f"formula must be one of {FORMULAS}, not {formula!r}")


def exploded(docs: DataFrame, *keep: str, tokens: str | Column = "tokens") -> DataFrame:
    """One row (keep..., term) per token.

    The outer form of explode: the inner one makes the optimizer test the size of the array in a filter of
    its own, which tokenises every text a second time.
    """
    return docs.select(*keep, F.explode_outer(tokens).alias("term")).where("term is not null")


def term_counts(docs: DataFrame, partitioned: bool = False) -> DataFrame:
    """(id, term, tf) from (id, tokens), partitioned by id; ``partitioned`` says that ``docs`` already is."""
    docs = docs.select("id", "tokens")
    terms = exploded(docs if partitioned else partition_by(docs, "id"), "id")
    return terms.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df). Repeats are dropped inside the row, so only map-side combined counts shuffle."""
    terms = exploded(docs, tokens=F.array_distinct("tokens"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_counts(tokens: DataFrame) -> DataFrame:
    """(term, n): how often each term occurs in the whole corpus."""
    return exploded(tokens).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def top_terms(docs: DataFrame, k: int) -> DataFrame:
    """(term, n): the ``k`` most frequent terms; ties go to the smaller term."""
    return corpus_counts(docs).orderBy(F.desc("n"), "term").limit(k)


def with_idf(df_counts: DataFrame, n_docs: Column, formula: str) -> DataFrame:
    vocab = df_counts.withColumn("idf", _idf(formula, n_docs))
    return vocab.where("idf > 1e-12") if formula == "log2" else vocab


@dataclass(frozen=True)
class Index:
    """A fitted corpus.

    ``ids`` (id) every document; ``vocab`` (term, df, idf); ``weights`` (id, term, w) unit length, in ``buckets`` by id
    (as many as shuffle partitions, if none are given).
    """

    ids: DataFrame
    vocab: DataFrame
    weights: DataFrame
    formula: str
    buckets: int | None = None

    def save(self, path: str) -> None:
        spark = self.vocab.sparkSession
        self.ids.write.mode("overwrite").parquet(os.path.join(path, "ids"))
        self.vocab.write.mode("overwrite").parquet(os.path.join(path, "vocab"))
        buckets = self.buckets or bucket_count(spark)
        write_bucketed(self.weights, os.path.join(path, "weights"), "id", buckets)
        meta = spark.range(1).select(F.lit(self.formula).alias("formula"), F.lit(buckets).alias("buckets"))
        meta.write.mode("overwrite").json(os.path.join(path, "meta"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Index:
        from profilematch.sources.artefacts import require

        parts = {name: require(spark, os.path.join(path, name)) for name in ("meta", "ids", "vocab", "weights")}
        meta = spark.read.schema("formula string, buckets int").json(parts["meta"]).first()
        return Index(
            ids=spark.read.parquet(parts["ids"]),
            vocab=spark.read.schema("term string, df long, idf double").parquet(parts["vocab"]),
            weights=read_bucketed(spark, parts["weights"], "id", meta["buckets"]),
            formula=meta["formula"],
            buckets=meta["buckets"],
        )

    def stored(self) -> Index:
        """The same index with its weights written to the shared folder, for jobs that read them twice."""
        return replace(self, weights=materialize_by(self.weights, "weights", "id", self.buckets))


def fit_index(
    docs: DataFrame,
    id_col: str,
    tokens_col: str,
    formula: str = "log2",
    max_terms: int | None = None,
    partitioned: bool = False,
    max_broadcast_terms: int = MAX_BROADCAST_TERMS,
    buckets: int | None = None,
) -> Index:
    """Fit on a token column. ``max_terms`` keeps the most frequent terms of the corpus only.

    ``partitioned``: ``docs`` is already hash-partitioned by its id, as ``partition_by`` or ``repartition`` leave it, and
    ``buckets`` is what ``sizes_for`` told beside the number of partitions. A task holds a count for each term of each of
    its texts, and later a bucket.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(tokens_col).alias("tokens"))
    ids = docs.select("id")
    if not partitioned:
        parts, buckets = sizes_for(docs)
        docs = docs.repartition(parts, "id")
    counts = materialize_by(term_counts(docs, partitioned=True), "counts", "id", buckets)
    terms = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n"))
    if max_terms is not None:
        terms = terms.orderBy(F.desc("n"), "term").limit(max_terms)
    n_docs = ids.agg(F.count(F.lit(1))).scalar()
    # Written once: the query side and the weights both read it, and its size decides the join.
    vocab = materialize(with_idf(terms, n_docs, formula).select("term", "df", "idf"), "vocab")
    return Index(ids, vocab, unit_weights(counts, vocab, max_broadcast_terms, buckets), formula, buckets)


def unit_weights(
    counts: DataFrame, vocab: DataFrame, max_broadcast_terms: int = MAX_BROADCAST_TERMS, buckets: int | None = None
) -> DataFrame:
    """(id, term, w) from (id, term, tf): terms outside the vocabulary are dropped. ``buckets``: those of ``counts``."""
    weighed = attach_idf(counts, vocab, max_broadcast_terms, buckets).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("id")))
    return weighed.select("id", "term", F.try_divide(F.col("w"), norm).alias("w"))


def attach_idf(counts: DataFrame, vocab: DataFrame, max_broadcast_terms: int, parts: int | None = None) -> DataFrame:
    """Inner join of postings with ``idf`` on term. What is shuffled gets ``parts`` partitions, if given, by id at last.

    A hot term may be in most documents, so the postings are never shuffled by hot terms: those with more
    than a ``max_broadcast_terms``-th of all postings are broadcast (there cannot be more of them than
    that), and only the rest is joined by a shuffle.
    """
    small = vocab.select("term", "idf")
    if fits(small, max_broadcast_terms):
        return counts.join(F.broadcast(small), "term")
    # At most max_broadcast_terms terms can have more than this share of all postings.
    postings = vocab.agg(F.sum("df")).first()[0]
    is_hot = F.col("df") > postings / max_broadcast_terms
    hot = F.broadcast(vocab.where(is_hot).select("term", "idf"))
    rare = vocab.where(~is_hot).select("term", F.col("idf").alias("rare_idf"))
    marked = counts.join(hot, "term", "left")
    from_hot = marked.where("idf is not null")
    by_term = (lambda df: df.repartition(parts, "term")) if parts else (lambda df: df)
    from_rare = by_term(marked.where("idf is null").drop("idf")).join(by_term(rare), "term")
    both = from_hot.unionByName(from_rare.withColumnRenamed("rare_idf", "idf"))
    return both.repartition(parts, "id") if parts else both


def request_counts(requests: DataFrame) -> DataFrame:
    """(request_id, term, tf) from (request_id, tokens)."""
    terms = exploded(requests, "request_id")
    return terms.groupBy("request_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def request_weights(counts: DataFrame, vocab: DataFrame, small: bool) -> DataFrame:
    """(request_id, term, w) from request counts and the fitted idf; unknown terms are dropped.

    ``small`` says that the counts were checked to fit a broadcast.
    """
    if small:
        weighed = vocab.select("term", "idf").join(F.broadcast(counts), "term")
    else:
        weighed = attach_idf(counts, vocab, MAX_BROADCAST_TERMS)
    weighed = weighed.withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("request_id")))
    return weighed.select("request_id", "term", F.try_divide(F.col("w"), norm).alias("w"))
