"""Near-duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

Tokens are runs of letters and digits in lower case, shingles are SHINGLE of them (all tokens of a shorter text). A
shingle weighs tf * (1 + IDF_WEIGHT * idf), with idf from 0 to 1. Document frequencies come from a count sketch over
all documents: WIDTH counters, added up over tasks. Counters grow with the corpus, and so does the frequency that
counts as frequent (FREQUENT of all documents), so the sketch serves any size; rarer shingles have idf 1.

Improved consistent weighted sampling (Ioffe, 2010) draws SAMPLES pairs (shingle, level) per text; two texts agree in a
sample with their weighted Jaccard similarity as probability. Its random numbers come from a fixed table by shingle
hash. ROWS samples make a band. Texts with equal tokens are one node; nodes that share a band are candidates:

- Each band first compares its pivot, the node with most neighbours in all its bands, with the others. Links are
  verified on the texts, and their components are classes. This settles bands that hold one class.
- A band that holds several classes after that is compared whole: its nodes are dealt into blocks, every two blocks
  meet in a task of their own, and each pair of nodes from different classes is compared there. Blocks of one and the
  same class don't meet. So every pair that shares a band has been compared or was in one class before.

A class is named by its least doc_id.

Null, empty and token-free texts are classes of their own, as are rows with a null doc_id (class null). Rows with one
doc_id and different texts are told apart. Repeated rows are in one class. Extra columns are ignored or kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilematch.llm import hashing as H
from profilematch.llm.common import free_name, row_key, slices, stored, tokens
from profilematch.llm.components import components

U = np.uint64
SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
IDF_WEIGHT = 0.25
LEVELS = 16
WIDTH = 1 << 18
BLOCKS = 64
FREQUENT = 0.005
TABLE = 1 << 14
PIECE = 2048
#: Keys with more than this part of all rows, so fewer keys than this, meet their rows by a broadcast.
HOT_SHARE = 1024
#: Nodes, and weight of their shingles, in a block of a band.
BLOCK_NODES, BLOCK_WEIGHT = 256, 200_000

_random = np.random.default_rng(20240609)
_R = _random.gamma(2.0, 1.0, (TABLE, SAMPLES)).astype(np.float32)
_LOG_C = np.log(_random.gamma(2.0, 1.0, (TABLE, SAMPLES))).astype(np.float32)
_BETA = _random.random((TABLE, SAMPLES)).astype(np.float32)
_SAMPLE = np.arange(1, SAMPLES + 1, dtype=U) * U(0x9E3779B97F4A7C15)
_FACTOR = H.mix(np.arange(1, ROWS + 1, dtype=U)) | U(1)
_by_weight: dict[float, np.ndarray] = {}


def shingles(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """For each text its shingle hashes (with repeats), and a hash of its tokens (0 without tokens)."""
    units, doc = tokens(column)
    bounds = np.searchsorted(doc, np.arange(len(column) + 1))
    windows = H.window_hashes(units, SHINGLE)
    whole = H.span_hashes(units, bounds[:-1], bounds[1:])
    out = []
    for a, b, h in zip(bounds[:-1], bounds[1:], whole):
        out.append(windows[a : b - SHINGLE + 1] if b - a >= SHINGLE else np.full(int(b > a), h))
    return out, np.where(np.diff(bounds) > 0, whole, U(0))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """The count sketch of document frequencies, WIDTH numbers whatever the corpus, and the number of documents."""
    size = WIDTH // BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(WIDTH, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                distinct = [np.unique(own) for own in shingles(part.column("text"))[0] if len(own)]
                if distinct:
                    n += len(distinct)
                    total += np.bincount((np.concatenate(distinct) >> U(46)).astype(np.int64), minlength=WIDTH)
        yield _blocks(total, n)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        seen: dict[int, int] = {}
        for batch in batches:
            for block, n, values in zip(*[batch.column(c).to_pylist() for c in ("block", "n", "counts")]):
                sums[block] = sums.get(block, 0) + np.frombuffer(values, "<i8")
                seen[block] = seen.get(block, 0) + n
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), pa.array([seen[k] for k in keys], pa.int64()), pa.array([sums[k].tobytes() for k in keys], pa.binary())],
            ["block", "n", "counts"],
        )

    def _blocks(total: np.ndarray, n: int) -> pa.RecordBatch:
        parts = [total[k * size : (k + 1) * size].tobytes() for k in range(BLOCKS)]
        return pa.RecordBatch.from_arrays(
            [pa.array(range(BLOCKS), pa.int32()), pa.array([n] * BLOCKS, pa.int64()), pa.array(parts, pa.binary())], ["block", "n", "counts"]
        )

    kind = "block int, n long, counts binary"
    rows = docs.select("text").mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).collect()  # BLOCKS rows
    out, n = np.zeros(WIDTH, np.int64), 0
    for r in rows:
        out[r.block * size : (r.block + 1) * size] = np.frombuffer(bytes(r.counts), "<i8")
        n = r.n
    return out, n


def idf_levels(counts: np.ndarray, n: int) -> np.ndarray:
    """The idf of each counter as a number of 1/LEVELS; counters within chance of the mean load are rare: LEVELS."""
    extra = counts - counts.mean()
    frequent = extra > np.maximum(FREQUENT * n, 6 * np.sqrt(counts.mean() + 1))
    df = np.where(frequent, np.minimum(extra, n), 1)
    idf = np.log((n + 1) / (df + 1)) / np.log((n + 1) / 2) if n > 1 else np.ones(len(counts))
    return np.clip(np.rint(idf * LEVELS), 0, LEVELS).astype(np.int8)


def weigh(own: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in order, and their weights."""
    distinct, tf = np.unique(own, return_counts=True)
    return distinct, tf * (1 + IDF_WEIGHT / LEVELS * levels[(distinct >> U(46)).astype(np.int64)])


def _costs(rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
    r, log_w = _R[rows], np.log(weight).astype(np.float32)[:, None]
    return _LOG_C[rows] - r * (np.floor(log_w / r + _BETA[rows]) - _BETA[rows] + 1)


def _costs_at(weight: float) -> np.ndarray:
    """The costs of all table rows at a common weight; the few commonest stay in the worker."""
    if weight not in _by_weight:
        if len(_by_weight) >= 4:
            _by_weight.clear()
        _by_weight[weight] = _costs(np.arange(TABLE), np.full(TABLE, weight))
    return _by_weight[weight]


def samples(distinct: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """SAMPLES hashes of (shingle, level). Long texts go piece by piece."""
    rows = (distinct & U(TABLE - 1)).astype(np.int64)
    best = np.full(SAMPLES, np.inf, np.float32)
    pick = np.zeros(SAMPLES, np.int64)
    for a in range(0, len(rows), PIECE):
        own, weight = rows[a : a + PIECE], weights[a : a + PIECE]
        common = weight == 1 + IDF_WEIGHT
        cost = _costs_at(1 + IDF_WEIGHT)[own]
        if not common.all():
            other = np.flatnonzero(~common)
            cost[other] = _costs(own[other], weight[other])
        least = cost.argmin(axis=0)
        value = cost[least, np.arange(SAMPLES)]
        better = value < best
        best[better] = value[better]
        pick[better] = least[better] + a
    at = (rows[pick], np.arange(SAMPLES))
    level = np.floor(np.log(weights[pick]).astype(np.float32) / _R[at] + _BETA[at]).astype(np.int64)
    return H.mix(distinct[pick] ^ H.mix(level.astype(U) + _SAMPLE))


def bands(drawn: np.ndarray) -> np.ndarray:
    return H.mix((drawn.reshape(BANDS, ROWS) * _FACTOR).sum(axis=1, dtype=U) + np.arange(BANDS, dtype=U))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: the sum of lesser weights over the sum of greater ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum()
    return float(least / (a[1].sum() + b[1].sum() - least))


def signatures(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(doc_id, row, node, weight, bands) of each document with tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own, nodes = shingles(part.column("text"))
                keep = [i for i, x in enumerate(own) if len(x)]
                weight, drawn = [], []
                for i in keep:
                    distinct, w = weigh(own[i], sent.value)
                    weight.append(float(w.sum()))
                    drawn.append(bands(samples(distinct, w)).astype(np.int64))
                at = pa.array(keep, pa.int64())
                lists = pa.array(drawn, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("row").take(at), pa.array((nodes[keep] >> U(1)).astype(np.int64)), pa.array(weight, pa.float64()), lists],
                    ["doc_id", "row", "node", "weight", "bands"],
                )

    return docs.select("doc_id", "row", "text").mapInArrow(
        run, "doc_id long, row long, node long, weight double, bands array<long>"
    )


def _verified(pairs: DataFrame, texts: DataFrame, levels: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least ``threshold`` alike. A node in many pairs is read in parts."""
    sent = pairs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None
        for batch in batches:
            for part in slices(batch, "text_b"):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                others = shingles(part.column("text_b"))[0]
                linked = []
                for i, node in enumerate(a):
                    if node != last:
                        last, first = node, weigh(shingles(part.column("text_a").slice(i, 1))[0][0], sent.value)
                    if similarity(first, weigh(others[i], sent.value)) >= threshold:
                        linked.append(i)
                at = pa.array(linked, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("a").take(at), part.column("b").take(at)], ["a", "b"])

    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / 256).cast("int").alias("parts"))
    left = parts.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    left = left.select("a", "text_a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    both = dealt.join(right, "b").join(left, ["a", "part"])
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _held(rows: DataFrame) -> DataFrame:
    """Rows of keys with two nodes or more, without the pivot itself: (key, node, weight, band, score, pivot)."""
    most = F.max(F.struct("score", (-F.col("node")).alias("less")))
    of = rows.groupBy("key").agg((-most["less"]).alias("pivot"), F.count("*").alias("size")).where("size > 1")
    return rows.join(of.drop("size"), "key").where("node <> pivot")


def _cells(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, side, node, root): the blocks that meet, of keys whose three or more nodes are in several classes.

    A class that fills a block in its key has blocks of its own, other classes share blocks; no class is cut there.
    """
    own = rows.select("key", "node", "weight").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = stored(own, "rooted")
    count = lambda n, w: F.ceil(F.greatest(n / BLOCK_NODES, w / BLOCK_WEIGHT)).cast("int")
    sized = own.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    sized = sized.withColumn("own_parts", count(F.col("n"), F.col("w")))
    small = F.col("own_parts") == 1
    of_key = sized.groupBy("key").agg(
        F.count("*").alias("roots"), F.sum("n").alias("size"),
        count(F.sum(F.when(small, F.col("n"))), F.sum(F.when(small, F.col("w")))).alias("small_parts"),
    ).where("roots > 1 and size > 2")
    dealt = sized.join(of_key.select("key", "small_parts"), "key").select("key", "root", "own_parts", "small_parts")
    part = F.when(small, F.pmod(F.xxhash64("root"), F.col("small_parts"))).otherwise(F.pmod(F.xxhash64("node"), F.col("own_parts")))
    of = F.when(~small, F.col("root"))  # null: a block of several classes
    blocked = stored(own.join(dealt, ["key", "root"]).select("key", "node", "root", of.alias("of"), part.alias("part")), "blocked")
    blocks = blocked.groupBy("key", "of", "part").agg(F.count("*").alias("n")).withColumn("block", F.xxhash64("of", "part"))
    one, two = (blocks.select("key", F.col("block").alias(f"block_{k}"), F.col("of").alias(f"of_{k}")) for k in (0, 1))
    meet = one.join(two, "key").where("block_0 <= block_1 and (of_0 is null or of_1 is null or of_0 <> of_1)")
    meet = meet.withColumn("cell", F.xxhash64("key", "block_0", "block_1"))
    side = lambda k: F.struct(F.lit(k).alias("side"), F.col(f"block_{k}").alias("block"))
    sides = F.when(F.col("block_0") == F.col("block_1"), F.array(side(0))).otherwise(F.array(side(0), side(1)))
    meet = meet.select("key", "cell", F.explode(sides).alias("s")).select("key", "cell", "s.*")
    return meet.join(blocked.withColumn("block", F.xxhash64("of", "part")), ["key", "block"]).select("cell", "side", "node", "root")


def cell_links(own: list[tuple[np.ndarray, np.ndarray]], root: np.ndarray, side: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Pairs of texts that link the classes of a cell; with two sides, only pairs across them are compared.

    All pairs of different classes are compared, but those that links found here have brought into one class.
    """
    group = np.unique(root, return_inverse=True)[1]
    total = np.array([w.sum() for _, w in own])
    text = np.repeat(np.arange(len(own)), [len(d) for d, _ in own])
    _, shingle, often = np.unique(np.concatenate([d for d, _ in own]), return_inverse=True, return_counts=True)
    weight = np.concatenate([w for _, w in own])
    shared = often[shingle] > 1
    text, shingle, weight = text[shared], shingle[shared], weight[shared]
    bounds = np.searchsorted(text, np.arange(len(own) + 1))
    first = np.zeros(len(often))
    across = side.min() < side.max()
    lesser = 0 if (side == 0).sum() <= (side == 1).sum() else 1
    out = []
    for i in np.flatnonzero(side == lesser) if across else range(len(own)):
        alike = np.minimum(total[i], total) >= (threshold - 1e-9) * np.maximum(total[i], total)
        alike &= (group != group[i]) & ((side != lesser) if across else (np.arange(len(own)) > i))
        if not alike.any():
            continue
        a, b = bounds[i], bounds[i + 1]
        first[shingle[a:b]] = weight[a:b]
        low = 0 if across else b
        least = np.bincount(text[low:], np.minimum(first[shingle[low:]], weight[low:]), minlength=len(own))
        first[shingle[a:b]] = 0
        for j in np.flatnonzero(alike & (least >= threshold * (total[i] + total - least))):
            if group[j] != group[i]:
                out.append((int(i), int(j)))
                group[group == group[j]] = group[i]
    return out


def _compared(cells: DataFrame, texts: DataFrame, levels: np.ndarray, threshold: float) -> DataFrame:
    """Links (a, b) between the classes of each cell."""
    sent = cells.sparkSession.sparkContext.broadcast(levels)

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        cell = pa.Table.from_batches(parts)
        own = []
        for part in parts:
            for few in slices(part, "text"):
                own += [weigh(x, sent.value) for x in shingles(few.column("text"))[0]]
        node = cell.column("node").to_numpy()
        found = np.array(cell_links(own, cell.column("root").to_numpy(), cell.column("side").to_numpy(), threshold), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else []
            for a, b in zip(starts, [*starts[1:], len(cell)]):
                if held and held[0].column("cell")[0].as_py() != cell[a]:
                    yield links(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield links(held)

    rows = cells.join(texts.select("node", "text"), "node").repartition("cell").sortWithinPartitions("cell")
    return rows.select("cell", "side", "node", "root", "text").mapInArrow(run, "a long, b long")


def link_classes(signed: DataFrame, docs: DataFrame, levels: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """(node, root) of each node with a verified link; the root is the least node of its class."""
    one = signed.groupBy("node").agg(F.min(F.struct("doc_id", "row", "weight", "bands")).alias("one"))
    each = one.select("node", "one.*").select("node", "doc_id", "row", "weight", F.posexplode("bands").alias("band", "hash"))
    sizes = each.groupBy("hash").agg(F.count("*").alias("size")).where("size > 1")
    bands_of = stored(each.join(sizes, "hash"), "bands")  # bands that two nodes share
    scores = bands_of.groupBy("node").agg(F.sum("size").alias("score"), F.min(F.struct("doc_id", "row", "weight")).alias("of"))
    scores = stored(scores.select("node", "score", "of.*"), "scores")
    rows = bands_of.select(F.col("hash").alias("key"), "node", "weight", "band").join(scores.select("node", "score"), "node")
    held = stored(_held(rows), "held")
    # Never broadcast: what is moved follows the input at every size.
    texts = docs.join(scores.select("node", "doc_id", "row", "weight").hint("merge"), ["doc_id", "row"])
    texts = stored(texts.groupBy("node").agg(F.first("text").alias("text"), F.first("weight").alias("weight")), "texts")
    heavy = texts.select(F.col("node").alias("a"), F.col("weight").alias("weight_a"))
    pairs = held.select(F.col("pivot").alias("a"), F.col("node").alias("b"), F.col("weight").alias("weight_b")).distinct()
    alike = F.least("weight_a", "weight_b") >= (threshold - 1e-9) * F.greatest("weight_a", "weight_b")
    pairs = stored(pairs.join(heavy, "a").where(alike).select("a", "b"), "pairs")
    found = stored(_verified(pairs, texts, levels, threshold), "found")
    roots = stored(components(found), "roots")
    cells = stored(_cells(rows, roots), "cells")
    if cells.isEmpty():
        return roots
    more = stored(_compared(cells, texts, levels, threshold), "more")
    return roots if more.isEmpty() else stored(components(found.unionByName(more)), "roots")


def _hot_join(many: DataFrame, one: DataFrame, key: str, rows: str) -> DataFrame:
    """Stored ``many`` with the row of ``one`` for its key; ``one.rows`` is how many rows of ``many`` the key has.

    A key with more than 1/HOT_SHARE of all rows is broadcast, so no task gets more than that from one key.
    """
    total = one.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    hot = F.col(rows) * HOT_SHARE > total
    few = F.broadcast(one.where(hot))
    rest = many.join(few.select(key), key, "left_anti").join(one.where(~hot), key)
    return many.join(few, key).unionByName(rest)


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row, class_id, class_size, kept): one row for each row of ``docs``; one text of each class is kept."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), "text")
    counts, n = document_frequencies(keyed)
    levels = idf_levels(counts, n)
    named = keyed.where(F.col("doc_id").isNotNull())
    signed = stored(signatures(named, levels), "signatures")
    roots = link_classes(signed, named, levels, threshold)
    nodes = signed.groupBy("node").agg(F.min(F.struct("doc_id", "row")).alias("least"), F.count("*").alias("copies"))
    nodes = nodes.join(roots, "node", "left").select("node", "least", "copies", F.coalesce("root", "node").alias("root"))
    nodes = stored(nodes, "nodes")
    sizes = nodes.groupBy("root").agg(
        F.min("least").alias("head"), F.sum("copies").alias("class_size"), F.count("*").alias("nodes")
    )
    of_node = _hot_join(nodes.select("node", "copies", "root"), stored(sizes, "sizes"), "root", "nodes").drop("root", "nodes")
    known = _hot_join(signed.select("doc_id", "row", "node"), stored(of_node, "of_node"), "node", "copies")
    kept = (F.struct("doc_id", "row") == F.col("head")).alias("kept")
    known = known.select("doc_id", "row", F.col("head.doc_id").alias("class_id"), "class_size", kept)
    known = stored(known, "classes")
    rest = keyed.select("doc_id", "row").join(known.select("doc_id", "row").distinct(), ["doc_id", "row"], "left_anti")
    alone = rest.select("doc_id", "row", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    return known.unionByName(alone)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class, that with the least doc_id, with all its columns.

    Rows without tokens or doc_id are classes of their own and stay; of rows equal in doc_id and text one stays.
    """
    names = ("doc", "row", "id", "text")
    doc, row, own_id, own_row = (free_name(docs, f"__{name}") for name in names)
    drop = classes(docs, threshold).where(~F.col("kept"))
    drop = drop.select(F.col("doc_id").alias(doc), F.col("row").alias(row)).distinct()
    keyed = docs.withColumns({own_id: F.col("doc_id").cast("long"), own_row: row_key()})
    same = (F.col(own_id) == F.col(doc)) & (F.col(own_row) == F.col(row))
    return keyed.join(drop, same, "left_anti").dropDuplicates([own_id, own_row]).select(*docs.columns)
