"""A second layout of the postings, for requests with few terms: only the terms' own part of the index is read.

Postings lie in *slots* by a hash of the term (folders of the table, so a filter on the slot skips files), in buckets by
id inside each slot (so a document's postings still lie in one task, and its score and the best n of a task need no
shuffle), and sorted by term inside a file (so the statistics of row groups and pages skip the rest of a slot). A frequent
term is spread over all buckets of its slot.

Each term also has its greatest weight. It bounds what a term can add to any score: a request's terms are *essential*
from the greatest bound down, and if the n-th best score of these alone exceeds what all others can add together, no
document without an essential term can be among the best. Frequent terms then only meet documents found already.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profilematch.operators.tfidf import Index
from profilematch.session import bucket_count, materialize, step_path, table_name

#: Postings of a bucket of a slot, which is a file, on average, and the bounds of the number of slots: more slots would
#: make files of a few kilobytes, whose number grows with the postings times the buckets.
FILE_ENTRIES, MIN_SLOTS, MAX_SLOTS = 500_000, 4, 4_096
#: Terms up to this number are named in the scan itself.
MAX_NAMED_TERMS = 1_000
#: Share of a request's possible score that its essential terms make up.
ESSENTIAL = 0.85


@dataclass(frozen=True)
class TermLayout:
    """``postings`` (id, term, w, slot) and ``bounds`` (term, max_w)."""

    postings: DataFrame
    bounds: DataFrame
    slots: int


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(slots)).cast("int")


def slots_for(entries: int, buckets: int) -> int:
    """Slots of a table of ``entries`` postings in ``buckets`` buckets."""
    return min(MAX_SLOTS, max(MIN_SLOTS, entries // (FILE_ENTRIES * buckets)))


def lay_out(index: Index, path: str | None = None, slots: int | None = None) -> TermLayout:
    """Write the postings of ``index`` by term to ``path`` (a folder of the job, if none is given)."""
    spark = index.vocab.sparkSession
    buckets = index.buckets or bucket_count(spark)
    if slots is None:
        entries = index.vocab.agg(F.sum("df")).first()[0] or 0
        slots = slots_for(int(entries), buckets)
    path = path or step_path(spark, "by-term")
    name = table_name()
    # the weights are partitioned by id already: a task writes one bucket of each slot
    rows = index.weights.select("id", "term", "w", _slot(slots).alias("slot"))
    writer = rows.write.mode("overwrite").option("path", path).partitionBy("slot")
    writer.bucketBy(buckets, "id").sortBy("term").saveAsTable(name)
    postings = spark.table(name)
    bounds = materialize(postings.groupBy("term").agg(F.max("w").alias("max_w")), "term-bounds")
    return TermLayout(postings, bounds, slots)


def postings_of(layout: TermLayout, terms: DataFrame) -> DataFrame:
    """(id, term, w) of the slots that hold one of ``terms`` (a column term, of a checked size)."""
    wanted = terms.select("term", _slot(layout.slots).alias("slot")).distinct()
    # no more slots than the layout has
    slots = [r.slot for r in wanted.select("slot").distinct().collect()]
    found = layout.postings.where(F.col("slot").isin(slots)) if slots else layout.postings.where(F.lit(False))
    named = [r.term for r in wanted.select("term").limit(MAX_NAMED_TERMS + 1).collect()]
    if 0 < len(named) <= MAX_NAMED_TERMS:
        found = found.where(F.col("term").isin(named))
    return found.select("id", "term", "w")


def _split(layout: TermLayout, request_terms: DataFrame) -> DataFrame:
    """(request_id, term, w, bound, others): the bound of each term, and that of all that are not essential (null if it is)."""
    bounded = request_terms.join(layout.bounds, "term").withColumn("bound", F.col("w") * F.col("max_w"))
    order = W.partitionBy("request_id").orderBy(F.desc("bound"), "term")
    before = F.coalesce(F.sum("bound").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    total = F.sum("bound").over(W.partitionBy("request_id"))
    marked = bounded.withColumn("essential", before < ESSENTIAL * total)
    others = F.sum(F.when(~F.col("essential"), F.col("bound"))).over(W.partitionBy("request_id"))
    return marked.withColumn("others", F.coalesce(others, F.lit(0.0)))


def score_by_terms(layout: TermLayout, request_terms: DataFrame, n: int) -> DataFrame:
    """(request_id, id, sim): a superset of the best n of each request, with whole scores. ``request_terms`` was size-checked.

    Two steps. The essential terms are scored first, in the buckets of their documents; the n-th best of these partial
    scores is a line that the final n-th best can't fall below. Then the other terms are added for documents that may
    still reach the line. Requests whose other terms alone could reach it are scored with all their terms.
    """
    marked = materialize(_split(layout, request_terms), "marked-terms")
    first = marked.where("essential")
    partial = _sums(postings_of(layout, first), first)
    partial = materialize(partial.select("request_id", "id", F.col("sim").alias("part")), "partial-scores")
    best = W.partitionBy("request_id").orderBy(F.desc("part"), "id")
    line = partial.withColumn("k", F.row_number().over(best)).where(F.col("k") == n).select("request_id", F.col("part").alias("line"))
    others = marked.groupBy("request_id").agg(F.max("others").alias("others"))
    # a little room, so that the order of summation decides nothing
    lines = others.join(line, "request_id", "left").withColumn("settled", F.coalesce(F.col("line") > F.col("others") + 1e-9, F.lit(False)))
    lines = materialize(lines, "score-lines")
    open_terms = marked.join(F.broadcast(lines.where("NOT settled").select("request_id")), "request_id", "left_semi")
    whole = _sums(postings_of(layout, open_terms), open_terms)

    kept = partial.join(F.broadcast(lines.where("settled")), "request_id")
    kept = kept.where(F.col("part") + F.col("others") >= F.col("line") - 1e-9).select("request_id", "id", "part")
    rest_terms = marked.where("NOT essential").join(F.broadcast(lines.where("settled").select("request_id")), "request_id", "left_semi")
    rest = postings_of(layout, rest_terms).join(kept.select("id").distinct(), "id", "left_semi")
    added = _sums(rest, rest_terms).withColumnRenamed("sim", "more")
    settled = kept.join(added, ["request_id", "id"], "left").select(
        "request_id", "id", (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("sim")
    )
    return whole.select("request_id", "id", "sim").unionByName(settled)


def _sums(postings: DataFrame, request_terms: DataFrame) -> DataFrame:
    terms = F.broadcast(request_terms.select("request_id", "term", F.col("w").alias("request_w")))
    joined = postings.join(terms, "term")
    return joined.groupBy("id", "request_id").agg(F.sum(F.col("w") * F.col("request_w")).alias("sim"))
