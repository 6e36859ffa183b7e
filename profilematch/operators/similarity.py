"""Best n documents per request by cosine, and the rows that make a short list whole.

Scores are sums over shared terms. Few requests: their terms are broadcast against the weights, which
are partitioned by document, so a document is scored and locally ranked where it lies and only
n rows per request and partition shuffle. Many requests: both sides are scored block against block.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profilematch.functions.scores import rank_score
from profilematch.operators.blocks import (
    ROUND_ROWS,
    block_name,
    bound_kernel,
    cosine_kernel,
    group_blocks,
    group_cells,
    hashed_terms,
    n_blocks,
    score_cells,
    score_grid,
    vectors,
)
from profilematch.operators.packed import Store, best_of_blocks, best_of_pairs, own_best, pack_blocks, summaries_of, unpacked
from profilematch.operators.skew import MAX_BROADCAST_ROWS, expand_join
from profilematch.session import fits, in_rounds, job, materialize

# The broadcast path writes one row per document, request and shared term before summing.
MAX_BROADCAST_REQUESTS = 256
MAX_BROADCAST_REQUEST_TERMS = 200_000


def tie_order(ties: str) -> Column:
    if ties not in ("asc", "desc"):
        raise ValueError("ties must be 'asc' or 'desc'")
    return F.asc("id") if ties == "asc" else F.desc("id")


def rank_best(scored: DataFrame, n: int, ties: str = "asc") -> DataFrame:
    """(request_id, rank, id, sim): the best n per request from (request_id, id, sim)."""
    best = W.partitionBy("request_id").orderBy(F.desc(rank_score("sim")), tie_order(ties))
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select("request_id", "rank", "id", "sim")
    )


def best_of(n: int, ties: str) -> Callable[[DataFrame], DataFrame]:
    """What a round of blocks keeps: the best n per request."""
    return lambda scored: rank_best(scored, n, ties).drop("rank")


def score_by_broadcast(request_terms: DataFrame, weights: DataFrame) -> DataFrame:
    """(request_id, id, sim) for every pair with a shared term. ``request_terms`` was size-checked.

    An optional column ``self_id`` names a document that the request must not be scored against.
    """
    terms = F.broadcast(request_terms.withColumnRenamed("w", "request_w"))
    joined = weights.join(terms, "term")
    if "self_id" in request_terms.columns:
        joined = joined.where("id != self_id")
    return (
        joined.groupBy("id", "request_id")
        .agg(F.sum(F.col("w") * F.col("request_w")).alias("sim"))
    )


def best_by_blocks(
    request_terms: DataFrame,
    weights: DataFrame,
    sizes: tuple[int, int, int, int],
    n: int,
    ties: str,
    extra: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """(request_id, id, sim), the best n of each cell.

    ``sizes``: requests, request entries, documents, document entries. ``extra`` has per-request
    columns (request_id, self_id) or (request_id, grp, threshold); ``groups`` has (id, grp).
    """
    n_requests, n_request_entries, n_docs, n_entries = sizes
    id_type = dict(weights.dtypes)["id"]
    request_type = dict(request_terms.dtypes)["request_id"]
    left = vectors(hashed_terms(request_terms.withColumnRenamed("request_id", "id")))
    if extra is not None:
        left = left.join(extra.withColumnRenamed("request_id", "id"), "id")
    right = vectors(hashed_terms(weights))
    schema = f"request_id {request_type}, id {id_type}, sim double"
    if groups is None:
        return packed_best(left, right, n, ties, schema, best_of(n, ties))
    kernel = cosine_kernel(n, ties, exclude_self=extra is not None and "self_id" in extra.columns, grouped=True)
    blocks = n_blocks(n_requests, n_request_entries), n_blocks(n_docs, n_entries)
    return score_grid(left, right.join(groups, "id"), *blocks, kernel, schema, best_of(n, ties))


def packed_best(
    left: DataFrame, right: DataFrame, n: int, ties: str, schema: str, best: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """(request_id, id, sim), a superset of the best n of each left vector: see ``best_of_blocks``.

    Vectors are packed for that, and their blocks go when the best are found.
    """
    with job(left.sparkSession) as running:
        sides = pack_blocks(left, "left-blocks"), pack_blocks(right, "right-blocks")
        return running.keep(best_of_blocks(*sides, n, ties, schema, best), "grid-scores")


def best_among(asked_ids: DataFrame, weights: DataFrame, vocab: DataFrame, n: int, ties: str) -> DataFrame:
    """(request_id, id, sim) for asked documents (id) against all others: a superset of the best n.

    All documents are packed once, for both sides. What is found for a document that is asked twice comes twice.
    """
    schema = f"request_id {dict(weights.dtypes)['id']}, id {dict(weights.dtypes)['id']}, sim double"
    with job(weights.sparkSession) as running:
        store = packed_documents(asked_ids, weights, vocab)
        found = best_of_blocks(store, store, n, ties, schema, best_of(n, ties), "asked")
        times = asked_ids.groupBy(F.col("id").alias("request_id")).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
        times = materialize(times, "asked-again")
        if not times.isEmpty():
            again = F.explode(F.sequence(F.lit(1), F.coalesce("times", F.lit(1))))
            found = found.join(times, "request_id", "left").withColumn("_time", again).drop("times", "_time")
        return running.keep(found, "grid-scores")


def packed_documents(asked_ids: DataFrame, weights: DataFrame, vocab: DataFrame) -> Store:
    """All documents in blocks of their kinds; those of ``asked_ids`` are marked as ``asked``.

    A document's kind is the most frequent of the corpus's most frequent terms that it holds.
    """
    top = vocab.orderBy(F.desc("df"), "term").limit(MAX_KINDS).select(F.xxhash64("term")).collect()
    marked = asked_ids.select("id").distinct().withColumn("asked", F.lit(True))
    rows = vectors(hashed_terms(weights)).join(marked, "id", "left")
    return pack_blocks(rows, "block-rows", "asked", [r[0] for r in top], KIND_ROWS)


def best_in_groups(
    request_terms: DataFrame, weights: DataFrame, per_request: DataFrame, groups: DataFrame, n: int
) -> DataFrame:
    """(request_id, id, sim), the best n of each cell, ties to the smaller id. Only blocks of equal groups meet.

    ``per_request``: (request_id, grp, threshold); ``groups``: (id, grp). Each group has blocks by its own size on both
    sides, so a group of most rows is cut into many, and no two groups share a cell.
    """
    types = dict(weights.dtypes)["id"], dict(request_terms.dtypes)["request_id"]
    left = vectors(request_terms.withColumnRenamed("request_id", "id")).join(
        per_request.withColumnRenamed("request_id", "id"), "id"
    )
    left, right = materialize(left, "group-requests"), vectors(weights).join(groups, "id")
    left_blocks, right_blocks = materialize(group_blocks(left), "left-blocks"), materialize(group_blocks(right), "right-blocks")
    few = fits(right_blocks, MAX_BROADCAST_ROWS) and fits(left_blocks, MAX_BROADCAST_ROWS)
    sides = [
        expand_join(side, blocks, "grp", "id", few).withColumn("block", block_name("grp", "blocks")).drop("blocks")
        for side, blocks in ((left, left_blocks), (right, right_blocks))
    ]
    cells = materialize(group_cells(left_blocks, right_blocks), "group-cells")
    kernel = cosine_kernel(n, "asc", grouped=True)
    schema = f"request_id {types[1]}, id {types[0]}, sim double"
    return score_cells(*sides, cells, kernel, schema, fits(cells, MAX_BROADCAST_ROWS))


#: Kinds of documents at most, and documents of a kind at least, on average.
MAX_KINDS, KIND_ROWS = 64, 100
#: Pairs of an asked row and a block that lie on disk at a time, for each row of the corpus.
PAIRS_A_ROW = 20


def block_summaries(rows: DataFrame) -> DataFrame:
    """(id, terms, ws) of each block of ``rows`` (terms, ws, block): the greatest weight of each term in it."""
    entries = rows.select("block", F.explode(F.arrays_zip("terms", "ws")).alias("e")).groupBy("block", F.col("e.terms").alias("term"))
    return vectors(entries.agg(F.max("e.ws").alias("w")).withColumnRenamed("block", "id"))


def needed_blocks(
    rows: DataFrame, asked: DataFrame, summaries: DataFrame | None = None, but_own: bool = False
) -> DataFrame:
    """(id, rb): the blocks in which an asked row could still find one of its best, with ``but_own`` its own left out.

    ``rows``: (id, terms, ws, block) all documents; ``asked``: the same with ``line``, the n-th best score so far. The
    product of a block's summary with a row bounds the row's scores there; ``summaries`` are stored ones of ``rows``.
    """
    summaries = materialize(block_summaries(rows), "block-summaries") if summaries is None else summaries
    n, size = summaries.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    asked = asked.select("id", "terms", "ws", "line", *["block"] * but_own)
    left, entries = asked.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    id_type = dict(asked.dtypes)["id"]
    schema = f"id {id_type}, rb string"
    blocks = n_blocks(left, entries or 0), n_blocks(n, size or 0)
    return score_grid(asked, summaries, *blocks, bound_kernel, schema, right_stored=True)


def best_by_bounds(asked_ids: DataFrame, weights: DataFrame, vocab: DataFrame, n: int, ties: str) -> DataFrame:
    """(request_id, id, sim) for asked documents (id) against all others: a superset of the best n, exact.

    Documents lie in blocks of their kind. First each asked row meets its own block; the n-th best score found there is
    its line. Then it meets only those blocks that could bring it a score of its line.
    """
    # What is stored on the way goes when the best are found.
    with job(weights.sparkSession) as running:
        return running.keep(_bounded(asked_ids, weights, vocab, n, ties), "bounded-scores")


def _bounded(asked_ids: DataFrame, weights: DataFrame, vocab: DataFrame, n: int, ties: str) -> DataFrame:
    # The vectors are stored once, for both sides.
    store = packed_documents(asked_ids, weights, vocab)
    id_type = dict(weights.dtypes)["id"]
    schema = f"request_id {id_type}, id {id_type}, sim double"
    best, spark = best_of(n, ties), weights.sparkSession
    vector = f"id {id_type}, terms array<bigint>, ws array<double>, block string"
    rows, asked = unpacked(store, vector), unpacked(store, vector, "asked")
    n_rows, n_asked = (sum(b[k] for b in store.blocks) for k in (2, 4))
    first = materialize(own_best(store, "asked", n, ties, schema), "own-block-scores")
    order = W.partitionBy("request_id").orderBy(F.desc("sim"))
    line = first.withColumn("k", F.row_number().over(order)).where(F.col("k") == n)
    line = line.select(F.col("request_id").alias("id"), F.col("sim").alias("line"))
    line = materialize(line, "lines")
    summaries = materialize(summaries_of(store), "block-summaries")
    turns = asked_turns(n_asked, len(store.blocks), n_rows)
    own = unpacked(store, f"id {id_type}, block string", "asked", vectors=False)

    def rest_scores(turn: int) -> DataFrame:
        # The pairs of a turn go when its best are found.
        mine = F.lit(True) if turns == 1 else F.pmod(F.xxhash64("id", F.lit("turn")), F.lit(turns)) == turn
        with job(spark) as running:
            lined = asked.where(mine).join(line, "id", "left").withColumn("line", F.coalesce("line", F.lit(0.0)))
            needed = needed_blocks(rows, lined, summaries, but_own=True)
            needed = needed.join(line, "id", "left").withColumn("line", F.coalesce("line", F.lit(0.0))).join(own, "id")
            needed = materialize(needed, "needed-blocks")
            found = best_of_pairs(store, needed, n_asked, 1 / turns, "asked", n, ties, schema, best)
            return running.keep(found, "turn-scores")

    return first.unionByName(in_rounds(spark, turns, rest_scores, "rest-scores"))


def asked_turns(asked: int, blocks: int, rows: int) -> int:
    """Turns in which asked rows look for blocks: their pairs would grow with the square of the rows.

    A turn has PAIRS_A_ROW pairs for each row at most (100,000 rows at least), if each asked row needs all blocks.
    """
    return max(1, -(-asked * blocks // (PAIRS_A_ROW * max(rows, ROUND_ROWS))))


def smallest_ids(ids: DataFrame, n: int, ties: str) -> Column:
    """The first n ids in tie order, as one array value."""
    first = ids.orderBy(tie_order(ties)).limit(n)
    return first.agg(F.sort_array(F.collect_list("id"), asc=ties == "asc")).scalar()


def fill_short_lists(
    ranked: DataFrame, requests: DataFrame, padding: Column, self_id: Column | None = None
) -> DataFrame:
    """(request_id, rank, id, sim) with ``top_n`` rows per request where the corpus has that many.

    A request with fewer matches gets further ids at score 0, in tie order. ``padding`` holds the first
    2n ids: at most n of them are matches, so enough unmatched ones are left. ``requests`` has
    (request_id, top_n) and what ``padding`` and ``self_id`` need.
    """
    matches = ranked.groupBy("request_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "sim"))).alias("m")
    )
    found = F.coalesce("m", F.array().cast("array<struct<rank:int,id:bigint,sim:double>>"))
    spare = F.array_except(F.coalesce(padding, F.array().cast("array<bigint>")), F.coalesce("m.id", F.array().cast("array<bigint>")))
    if self_id is not None:
        spare = F.array_remove(spare, self_id)
    lists = (
        requests.join(matches, "request_id", "left")
        .withColumn("_found", F.slice(found, F.lit(1), F.col("top_n")))
        .withColumn("_spare", spare)
        .withColumn("_missing", F.greatest(F.lit(0), F.col("top_n") - F.size("_found")))
    )
    rows = F.concat(
        F.transform("_found", lambda x: F.struct(x["id"].alias("id"), x["sim"].alias("sim"))),
        F.transform(
            F.slice("_spare", F.lit(1), F.col("_missing")),
            lambda x: F.struct(x.alias("id"), F.lit(0.0).alias("sim")),
        ),
    )
    return lists.select("request_id", F.posexplode(rows).alias("p", "r")).select(
        "request_id", (F.col("p") + 1).alias("rank"), "r.id", "r.sim"
    )
