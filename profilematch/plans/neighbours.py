"""The k nearest rows by Euclidean distance, exact, without meeting rows that are too far to matter.

Right rows go to their nearest pivot and, within it, to blocks by their distance to it. A block knows its least and
greatest distance and how many rows it has. For a left row two bounds hold: by the triangle inequality no row of a block
is nearer than the gap between the left row's distance to the pivot and the block's ring, nor than the plane half way
between that pivot and the left row's own. A left row first meets the one block with the least bound, which gives a
distance that its k nearest can't exceed; then it meets those blocks only whose bound is within that distance.

Pivots decide what moves, never the result. They are a bounded sample, as are the blocks' summaries: blocks grow with the
table, so that their number stays below MAX_BLOCKS. Of equal right vectors only the k first can be neighbours, of equal
left ones one is asked. Vectors that are null or hold a null, a NaN or an infinite number are left out on both sides; fewer
than k right rows give fewer neighbours, none give no rows; vectors of unequal width raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from profilematch.operators.blocks import BLOCK_ROWS, distance_kernel, score_pairs
from profilematch.operators.features import SEED
from profilematch.operators.skew import MAX_BROADCAST_ROWS, hot_join
from profilematch.session import materialize

#: Right rows for each pivot, as long as the pivots' number and width allow.
PIVOT_ROWS = 250
MAX_PIVOTS, MAX_NUMBERS = 1024, 1_000_000
#: Rings of all pivots together; salting rings of many rows at most doubles that.
MAX_BLOCKS = 100_000
#: Bounds (left rows times blocks) and distances to pivots that a task holds at a time.
CELL_BOUNDS = 200_000
#: Copies of points that a round may always make: a point is much shorter than the terms of a text.
ROUND_POINTS = 20_000_000
#: Error of a distance by matrix product, relative to the lengths of the vectors; pivots nearer than CLOSE have no plane.
SLACK, CLOSE = 1e-6, 1e-4


@dataclass(frozen=True)
class Pruned:
    neighbours: DataFrame  # id, rank, neighbour, label, distance
    report: DataFrame  # one row: asked, blocks, meetings, all_meetings, distances, all_distances


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0))


def _in_parts(right: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``right`` with its nearest pivot and the distance to it."""
    sent = right.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELL_BOUNDS // len(sent.value))
        for batch in batches:
            for some in (batch.slice(start, step) for start in range(0, batch.num_rows, step)):
                d = _distances(_matrix(some.column("vector")), sent.value)
                part = d.argmin(axis=1)
                new = [pa.array(part, pa.int32()), pa.array(d[np.arange(len(d)), part])]
                yield pa.RecordBatch.from_arrays([*some.columns, *new], [*some.schema.names, "part", "d"])

    types = dict(right.dtypes)
    return right.mapInArrow(run, f"id {types['id']}, vector array<double>, label {types['label']}, part int, d double")


def _in_blocks(right: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Right rows (id, vector, label, d, block), and (block, part, lo, hi, n): rings of a part, salted if many rows fall in one."""
    parts = right.groupBy("part").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count(F.lit(1)).alias("n"))
    parts = parts.select("part", "lo", ((F.col("hi") - F.col("lo")) / F.ceil(F.col("n") / rows)).alias("step"))
    ring = F.when(F.col("step") > 0, F.floor((F.col("d") - F.col("lo")) / F.col("step"))).otherwise(0)
    ringed = right.join(F.broadcast(parts), "part").withColumn("ring", ring.cast("int")).drop("lo", "step")
    sizes = ringed.groupBy("part", "ring").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("id"), F.col("salts")).cast("string")
    block = F.concat_ws("#", F.col("part").cast("string"), F.col("ring").cast("string"), salt)
    small = F.broadcast if sizes.count() <= MAX_BROADCAST_ROWS else (lambda df: df)
    placed = materialize(ringed.join(small(sizes), ["part", "ring"]).withColumn("block", block).drop("ring", "salts"), "ring-blocks")
    summary = placed.groupBy("block").agg(
        F.first("part").alias("part"), F.min("d").alias("lo"), F.max("d").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    return placed.drop("part"), materialize(summary, "ring-summaries")


class _Bounds:
    """Least distances from left vectors to blocks."""

    def __init__(self, pivots: np.ndarray, summary: pa.Table) -> None:
        summary = summary.sort_by("block")
        self.pivots, self.names = pivots, summary["block"].combine_chunks()
        self.part, self.n = summary["part"].to_numpy(), summary["n"].to_numpy()
        self.lo, self.hi = summary["lo"].to_numpy(), summary["hi"].to_numpy()
        self.between = _distances(pivots, pivots)
        self.reach = float(np.sqrt((pivots * pivots).sum(axis=1)).max())

    def slices(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        """Some rows, their bound for each block, their greatest distance to any row of it, and the error of both."""
        step = max(1, CELL_BOUNDS // max(1, len(self.names), len(self.pivots)))
        for start in range(0, batch.num_rows, step):
            some = batch.slice(start, step)
            x = _matrix(some.column("vector"))
            d = _distances(x, self.pivots)
            own = d.argmin(axis=1)
            scale = self.reach + np.sqrt((x * x).sum(axis=1))
            gap = self.between[own]
            apart = gap > CLOSE * scale[:, None]
            squares = d * d - (d[np.arange(len(d)), own] ** 2)[:, None]
            plane = np.where(apart, squares / (2 * np.where(apart, gap, 1.0)), 0.0)
            to = d[:, self.part]
            least = np.maximum(np.maximum(to - self.hi, self.lo - to), np.maximum(plane[:, self.part], 0.0))
            yield some, least, to + self.hi, SLACK * (1.0 + scale)


def _first_blocks(asked: DataFrame, bounds, k: int) -> DataFrame:
    """(id, rb, line): the block with the least bound, and a distance that the k nearest don't exceed by the summaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bounds.value
        for batch in batches:
            for some, least, most, error in held.slices(batch):
                order = np.argsort(most, axis=1, kind="stable")
                enough = np.cumsum(held.n[order], axis=1) >= k
                at = np.where(enough.any(axis=1), enough.argmax(axis=1), -1)
                rows = np.arange(len(least))
                line = np.where(at < 0, np.inf, most[rows, order[rows, at]] + error)
                block = held.names.take(pa.array(least.argmin(axis=1)))
                yield pa.RecordBatch.from_arrays([some.column("id"), block, pa.array(line)], ["id", "rb", "line"])

    return asked.select("id", "vector").mapInArrow(run, f"id {dict(asked.dtypes)['id']}, rb string, line double")


def _other_blocks(lined: DataFrame, bounds) -> DataFrame:
    """(id, rb): the blocks other than ``own`` whose bound is within the ``line`` of (id, vector, own, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bounds.value
        for batch in batches:
            for some, least, _, error in held.slices(batch):
                row, col = np.nonzero(least <= (some.column("line").to_numpy() + error)[:, None])
                # places instead of names: no Python string for each pair
                own = pc.index_in(some.column("own"), held.names).to_numpy(zero_copy_only=False)
                other = col != own[row]
                row, col = pa.array(row[other]), pa.array(col[other])
                yield pa.RecordBatch.from_arrays([some.column("id").take(row), held.names.take(col)], ["id", "rb"])

    return lined.select("id", "vector", "own", "line").mapInArrow(run, f"id {dict(lined.dtypes)['id']}, rb string")


def _pivots(right: DataFrame, rows: int, width: int, pivots: int | None) -> np.ndarray:
    wanted = pivots or max(1, min(MAX_PIVOTS, MAX_NUMBERS // max(1, width), math.ceil(rows / PIVOT_ROWS)))
    sample = right.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(wanted).select("vector").collect()  # at most MAX_PIVOTS
    return np.unique(np.array([r.vector for r in sample], float).reshape(len(sample), width), axis=0)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("id").orderBy(F.round("distance", 8), "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_pruned(left: DataFrame, right: DataFrame, k: int, pivots: int | None = None) -> Pruned:
    """The k nearest rows of ``right`` (id, vector, label) for each row of ``left`` (id, vector); ties to the smaller id.

    Ids are unique on each side. ``pivots`` overrides how many pivots there are.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    left, right = (
        df.select("id", F.col("vector").cast("array<double>").alias("vector"), *more).where(_usable("vector"))
        for df, more in ((left, []), (right, ["label"]))
    )
    same = W.partitionBy("vector").orderBy("id")
    right = materialize(right.withColumn("_copy", F.row_number().over(same)).where(F.col("_copy") <= k).drop("_copy"), "right-points")
    asked = left.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    asked = materialize(asked, "left-points")
    width = F.size("vector")
    sizes = [df.agg(F.count(F.lit(1)).alias("n"), F.min(width).alias("a"), F.max(width).alias("b")).first() for df in (right, asked)]
    if len({w for s in sizes for w in (s["a"], s["b"]) if w is not None}) > 1:
        raise ValueError("vectors have unequal widths")
    spark, types = left.sparkSession, {**dict(left.dtypes), "label": dict(right.dtypes)["label"], "neighbour": dict(right.dtypes)["id"]}
    schema = f"id {types['id']}, neighbour {types['neighbour']}, label {types['label']}, distance double"
    if not sizes[0]["n"] or not sizes[1]["n"]:
        counts = f"{sizes[1]['n']}L AS asked, 0L AS blocks, 0L AS meetings, 0L AS all_meetings, 0L AS distances, 0L AS all_distances"
        nothing = spark.createDataFrame([], f"id {types['id']}, rank int, {schema.split(', ', 1)[1]}")
        return Pruned(nothing, spark.sql(f"SELECT {counts}"))

    centres = _pivots(right, sizes[0]["n"], sizes[0]["a"], pivots)
    rows, summary = _in_blocks(_in_parts(right, centres), max(BLOCK_ROWS, math.ceil(sizes[0]["n"] / MAX_BLOCKS)))
    rows = rows.drop("d")
    held = summary.toArrow()  # at most 2 * MAX_BLOCKS and 2 * MAX_PIVOTS rows
    bounds, few = spark.sparkContext.broadcast(_Bounds(centres, held)), len(held) <= MAX_BROADCAST_ROWS

    kernel, points = distance_kernel(k), asked.select("id", "vector")
    best = lambda scored: _ranked(scored, k).drop("rank")
    own = materialize(_first_blocks(points, bounds, k), "first-blocks")
    first = materialize(score_pairs(points, rows, own.select("id", "rb"), kernel, schema, few, best, ROUND_POINTS), "first-distances")
    reached = first.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("reached"))
    lined = points.join(own.withColumnRenamed("rb", "own"), "id").join(reached, "id", "left")
    lined = lined.withColumn("line", F.least("line", F.coalesce("reached", F.lit(float("inf")))))
    others = materialize(_other_blocks(lined, bounds), "other-blocks")
    found = first.unionByName(score_pairs(points, rows, others, kernel, schema, few, best, ROUND_POINTS))

    one = F.struct("rank", "neighbour", "label", "distance")
    lists = _ranked(found, k).groupBy("id").agg(F.collect_list(one).alias("_found"))
    lists = materialize(asked.join(lists, "id").select("vector", "copies", "_found"), "neighbour-lists")
    spread = hot_join(left, lists, "vector", "copies").select("id", F.inline("_found"))

    met = own.select("rb").unionByName(others.select("rb")).join(summary.select(F.col("block").alias("rb"), "n"), "rb")
    all_rows = int(sum(held["n"].to_pylist()))
    report = met.agg(F.count(F.lit(1)).alias("meetings"), F.sum("n").alias("distances")).select(
        F.lit(sizes[1]["n"]).cast("long").alias("asked"),
        F.lit(len(held)).cast("long").alias("blocks"),
        "meetings",
        F.lit(sizes[1]["n"] * len(held)).cast("long").alias("all_meetings"),
        "distances",
        F.lit(sizes[1]["n"] * all_rows).cast("long").alias("all_distances"),
    )
    return Pruned(spread, report)
