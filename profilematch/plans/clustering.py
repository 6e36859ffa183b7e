"""K-means whose result does not depend on how rows are partitioned, with labels in a fixed order and a choice of k.

Seeds are drawn in rounds, each a weighted sample without replacement: a row's key is -ln(u) / d², where u comes from
a hash of its id and d is its distance to the nearest seed so far, and the 2k least keys are taken. The least keys of
parts merge into the least keys of all. Candidates are weighted by the rows nearest to them and reduced to k. Each
further pass sends k means and counts per task, never rows. Labels are 0, 1, ... by falling size, then by centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilematch.operators.features import SEED
from profilematch.session import materialize

SEED_ROUNDS = 4
MAX_PASSES = 60
#: Greatest squared move of a centre, relative to the spread of all, at which passes end.
STILL = 1e-16
#: Numbers in all centres: k * width is checked, as centres go to every task.
MAX_NUMBERS = 4_000_000
DIGITS = 9


@dataclass
class Clusters:
    """Centres in the order of their labels, rows of each, and the mean simplified silhouette (-1 to 1)."""

    centres: np.ndarray
    sizes: list[int]
    silhouette: float


def prepared(data: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector), stored; rows without a vector are left out."""
    kind = dict(data.dtypes)[vector_col]
    vector = vector_to_array(vector_col) if kind == "vector" else F.col(vector_col).cast("array<double>")
    points = data.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), vector.alias("vector"))
    return materialize(points, "points")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, one centre after another."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)


def _measured(points: DataFrame, centres: np.ndarray) -> DataFrame:
    """``points`` with the nearest centre, its squared distance, and that of the second nearest (null for one centre)."""
    sent = points.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = _squares(_matrix(batch.column("vector")), sent.value)
            order = np.argsort(d, axis=1, kind="stable")[:, :2]
            near = np.take_along_axis(d, order, axis=1)
            second = pa.array(near[:, 1]) if near.shape[1] > 1 else pa.nulls(len(d), pa.float64())
            new = [pa.array(order[:, 0], pa.int32()), pa.array(near[:, 0]), second]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], ["id", "vector", "cluster", "d", "e"])

    kind = dict(points.dtypes)["id"]
    return points.mapInArrow(run, f"id {kind}, vector array<double>, cluster int, d double, e double")


def _seeds(points: DataFrame, k: int) -> np.ndarray:
    """At most k centres to begin with."""
    first = points.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(1).collect()
    found = [r.vector for r in first]
    for step in range(SEED_ROUNDS if found and k > 1 else 0):
        u = (F.xxhash64("id", F.lit(SEED + 1 + step)).bitwiseAND((1 << 53) - 1) + 1) / F.lit(float(1 << 53))
        keyed = _measured(points, np.array(found)).where("d > 0").select("id", "vector", (-F.log(u) / F.col("d")).alias("key"))
        found += [r.vector for r in keyed.orderBy("key", "id").limit(2 * k).collect()]
    candidates = np.unique(np.array(found), axis=0) if found else np.zeros((0, 0))
    if len(candidates) <= k:
        return candidates
    counted = _measured(points, candidates).groupBy("cluster").count().collect()  # one row a candidate
    weight = np.zeros(len(candidates))
    for r in counted:
        weight[r["cluster"]] = r["count"]
    draw = np.random.default_rng(SEED)
    chosen = [int(np.argmax(weight))]
    while len(chosen) < k:
        p = weight * _squares(candidates, candidates[chosen]).min(axis=1)
        if not p.sum():
            break
        chosen.append(int(np.searchsorted(np.cumsum(p) / p.sum(), draw.random(), "right")))
    return candidates[chosen]


def _means(points: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Means of the rows nearest to each centre (the centre itself if there are none), counts, silhouette."""
    near, far = F.sqrt("d"), F.sqrt("e")
    silhouette = F.when(far > 0, (far - near) / far).otherwise(0.0)
    vector = array_to_vector("vector")
    rows = _measured(points, centres).groupBy("cluster").agg(
        vector_to_array(Summarizer.mean(vector)).alias("mean"), F.count(F.lit(1)).alias("n"), F.sum(silhouette).alias("s")
    )
    new, sizes, total = centres.copy(), np.zeros(len(centres), np.int64), 0.0
    for r in rows.collect():  # one row a centre
        new[r["cluster"]], sizes[r["cluster"]] = r["mean"], r["n"]
        total += r["s"]
    return new, sizes, total / max(1, sizes.sum())


def fit(points: DataFrame, k: int) -> Clusters:
    """At most k clusters of stored (id, vector); fewer if there are fewer different vectors."""
    width = points.agg(F.max(F.size("vector"))).first()[0] or 0
    if k * width > MAX_NUMBERS:
        raise ValueError(f"{k} centres of {width} numbers: more than {MAX_NUMBERS} go to every task")
    centres = _seeds(points, k)
    if not len(centres):
        return Clusters(centres, [], 0.0)
    for _ in range(MAX_PASSES):
        new, sizes, silhouette = _means(points, centres)
        moved, spread = ((new - centres) ** 2).sum(axis=1).max(), ((new - new.mean(axis=0)) ** 2).sum(axis=1).max()
        if moved <= STILL * max(spread, 1e-300):
            break
        centres = new
    kept = [i for i in range(len(centres)) if sizes[i]]
    kept.sort(key=lambda i: (-sizes[i], tuple(np.round(centres[i], DIGITS))))
    return Clusters(centres[kept], [int(sizes[i]) for i in kept], float(silhouette))


def choose(points: DataFrame, ks: list[int]) -> tuple[Clusters, DataFrame]:
    """The clusters of the k with the greatest silhouette (ties to the smaller k), and (k, clusters, silhouette) of all."""
    fitted = {k: fit(points, k) for k in sorted(set(ks))}
    best = max(fitted, key=lambda k: (round(fitted[k].silhouette, DIGITS), -k))
    rows = [(k, len(f.sizes), f.silhouette) for k, f in fitted.items()]
    report = points.sparkSession.createDataFrame(rows, "k int, clusters int, silhouette double")
    return fitted[best], report


def assign(points: DataFrame, clusters: Clusters) -> DataFrame:
    """(id, cluster, distance) of (id, vector): the nearest centre, ties to the smaller label."""
    if not len(clusters.centres):
        return points.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("double").alias("distance"))
    return _measured(points, clusters.centres).select("id", "cluster", F.sqrt("d").alias("distance"))
