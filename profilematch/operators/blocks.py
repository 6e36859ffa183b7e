"""Scoring block against block, for sides too large to broadcast.

Both sides are cut into blocks of bounded size by a hash of the id, so no value of the data can make
a block large. Every (left block, right block) pair is one task-sized cell: numpy scores it and
returns only the best n per left row, or the rows above a threshold. Pairs are never emitted.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from profilematch.session import in_rounds, job, materialize

# The kernels travel with the job, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 2_000
BLOCK_ENTRIES = 400_000
SPARSE_PAIRS = 8_192
SCORE_UNIT = 10**10
#: Plain blocks of a larger one, on each side, at most; cells of a round for each core, at least. A round's cells lie on
#: disk together, each with its rows of both sides.
MAX_TILES, CELLS_PER_CORE = 4, 1
#: Copies of rows that a round of pairs may always make; parts of the right side that its rounds take, at most.
ROUND_ROWS, RIGHT_PARTS = 100_000, 4


def n_blocks(rows: int, entries: int = 0, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, math.ceil(rows / block_rows), math.ceil(entries / BLOCK_ENTRIES))


def round_size(mine: int, other: int, cores: int) -> tuple[int, int]:
    """(tiles of a block's side, left blocks of a round) for so many blocks of both sides.

    While there are enough cells, blocks of both sides are joined to larger ones, which are copied less often. A round
    takes as many left blocks as keep the cores busy: it copies each row of the right side once for each of them, and
    each of its left rows once for each right block, so it moves about as much as the right side holds.
    """
    tiles = max(1, min(MAX_TILES, math.isqrt(mine * other // (CELLS_PER_CORE * cores))))
    return tiles, max(1, math.ceil(CELLS_PER_CORE * cores / math.ceil(other / tiles)))


def right_parts(together: int, other: int, cores: int) -> int:
    """Parts of ``other`` right blocks that ``together`` left ones meet one after the other."""
    return max(1, together * other // (CELLS_PER_CORE * cores))


def _tiled(kernel: Callable[[pa.Table, pa.Table], pa.Table], tiles: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """``kernel`` on parts of two blocks, each with the rows of one plain block."""
    if tiles == 1:
        return kernel

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = [max(1, math.ceil(len(t) / tiles)) for t in (left, right)]
        parts = [[t.slice(i, n) for i in range(0, len(t), n)] for t, n in zip((left, right), rows, strict=True)]
        return pa.concat_tables([kernel(a, b) for b in parts[1] for a in parts[0]])

    return run


def score_grid(
    left: DataFrame,
    right: DataFrame,
    left_blocks: int,
    right_blocks: int,
    kernel: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    best: Callable[[DataFrame], DataFrame] | None = None,
    right_stored: bool = False,
) -> DataFrame:
    """Apply ``kernel`` to every pair of a left and a right block. Both sides have a column ``id``.

    Blocks of both sides are taken in rounds, each with as many cells as keep the cores busy, so what lies on disk at a
    time is the sides and a few blocks. ``best`` keeps what may be wanted of a round's rows; a left row meets all right
    blocks in as many rounds as these have parts, so the caller ranks its rows once more. ``right_stored`` says that the
    right side is a stored table, which is not stored again.
    """
    spark = left.sparkSession
    cores = spark.sparkContext.defaultParallelism
    tiles, together = round_size(left_blocks, right_blocks, cores)
    left_blocks, right_blocks = math.ceil(left_blocks / tiles), math.ceil(right_blocks / tiles)
    parts = right_parts(together, right_blocks, cores)
    rounds = math.ceil(left_blocks / together) * parts
    left = left.withColumn("_lb", F.pmod(F.xxhash64("id"), F.lit(left_blocks)).cast("int"))
    # Both sides may come from one table, so the right one gets columns of its own.
    names = right.columns
    renamed = [f"right_{c}" for c in names]
    right = right.select(
        F.pmod(F.xxhash64("id"), F.lit(right_blocks)).cast("int").alias("_right_rb"),
        *[F.col(c).alias(r) for c, r in zip(names, renamed, strict=True)],
    )
    nothing = to_arrow_schema(_parse_datatype_string(schema)).empty_table()
    meet = _tiled(kernel, tiles)

    def cell(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        if not len(left_rows) or not len(right_rows):
            return nothing
        return meet(left_rows, right_rows.select(renamed).rename_columns([r[6:] for r in renamed]))

    def meeting(left: DataFrame, right: DataFrame, lefts: tuple[int, int], rights: tuple[int, int]) -> DataFrame:
        a = left.withColumn("_rb", F.explode(F.sequence(*map(F.lit, rights))))
        b = right.withColumn("_right_lb", F.explode(F.sequence(*map(F.lit, lefts))))
        return a.groupBy("_lb", "_rb").cogroup(b.groupBy("_right_lb", "_right_rb")).applyInArrow(cell, schema)

    if rounds == 1:
        return in_rounds(spark, 1, lambda _: meeting(left, right, (0, left_blocks - 1), (0, right_blocks - 1)), "grid-scores")
    # Stored sides go when their rounds are over.
    with job(spark) as running:
        lefts = materialize(left.sortWithinPartitions("_lb"), "grid-left")
        rights = right if right_stored else materialize(right.sortWithinPartitions("_right_rb"), "grid-right")

        def step(number: int) -> DataFrame:
            at, part = divmod(number, parts)
            mine = at * together, min(left_blocks, (at + 1) * together) - 1
            theirs = part * right_blocks // parts, (part + 1) * right_blocks // parts - 1
            a, b = lefts.where(F.col("_lb").between(*mine)), rights.where(F.col("_right_rb").between(*theirs))
            found = meeting(a, b, mine, theirs)
            return found if best is None else best(found)

        return running.keep(in_rounds(spark, rounds, step, "grid-rounds"), "grid-scores")


def score_cells(
    left: DataFrame,
    right: DataFrame,
    cells: DataFrame,
    kernel: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    few_blocks: bool,
) -> DataFrame:
    """Apply ``kernel`` to the pairs of blocks in ``cells`` (lb, rb) only. Both sides have ``id`` and ``block``.

    A row is copied once for each cell of its block, so what moves follows the number of cells. ``few_blocks`` says
    that a row for each block fits a broadcast.
    """
    hint = F.broadcast if few_blocks else (lambda df: df)

    def copied(df: DataFrame, mine: str, other: str) -> DataFrame:
        partners = cells.groupBy(F.col(mine).alias("block")).agg(F.collect_set(other).alias("_partners"))
        return df.join(hint(partners), "block").withColumn("_partner", F.explode("_partners")).drop("_partners")

    a = copied(left, "lb", "rb").withColumnsRenamed({"block": "_lb", "_partner": "_rb"})
    # Both sides may come from one table, so the right one gets columns of its own.
    renamed = {c: f"right_{c}" for c in right.columns if c != "block"}
    b = copied(right, "rb", "lb").withColumnsRenamed({"block": "_right_rb", "_partner": "_right_lb", **renamed})
    nothing = to_arrow_schema(_parse_datatype_string(schema)).empty_table()

    def cell(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        if not len(left_rows) or not len(right_rows):
            return nothing
        return kernel(left_rows, right_rows.select(list(renamed.values())).rename_columns(list(renamed)))

    return a.groupBy("_lb", "_rb").cogroup(b.groupBy("_right_lb", "_right_rb")).applyInArrow(cell, schema)


def group_blocks(df: DataFrame, entries: str | Column | None = None) -> DataFrame:
    """(grp, blocks): how many blocks each group of ``df`` (grp, terms), or (grp, ``entries``), needs for its own size."""
    entries = F.size("terms") if entries is None else entries
    sizes = df.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum(entries).alias("m"))
    needed = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("m") / BLOCK_ENTRIES), F.lit(1))
    return sizes.where("grp is not null").select("grp", needed.cast("int").alias("blocks"))


def block_name(grp: str, blocks: str, salt: str = "id"):
    """The block of a row: its group and a hash of its id."""
    return F.concat_ws("#", F.col(grp).cast("string"), F.pmod(F.xxhash64(salt), F.col(blocks)).cast("string"))


def group_cells(left_blocks: DataFrame, right_blocks: DataFrame) -> DataFrame:
    """(lb, rb): every block of a group with every block of the same group."""
    sides = [
        df.select("grp", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.concat_ws("#", F.col("grp").cast("string"), i.cast("string")))).alias(c))
        for df, c in ((left_blocks, "lb"), (right_blocks, "rb"))
    ]
    return sides[0].join(sides[1], "grp").select("lb", "rb")


def bound_kernel(left: pa.Table, right: pa.Table) -> pa.Table:
    """(id, rb): the summaries on the right that could give a left row a score of its ``line``, or any if that is 0.

    The summary of the row's own ``block`` is left out, if the left side has that column.
    """
    bounds = dot_products(left, right)
    wanted = (bounds > 0) & (bounds >= left["line"].to_numpy()[:, None] - 1e-9)
    if "block" in left.column_names:
        own, other = (t.to_numpy() for t in (left["block"], right["id"]))
        wanted &= own[:, None] != other[None, :]
    row, col = np.nonzero(wanted)
    return pa.table({"id": left["id"].take(row), "rb": right["id"].take(col).cast(pa.string())})


def score_pairs(
    left: DataFrame,
    right: DataFrame,
    pairs: DataFrame,
    kernel: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    few_blocks: bool,
    best: Callable[[DataFrame], DataFrame] | None = None,
    round_rows: int | None = None,
    tiles: int = 1,
    part_wise: bool = False,
) -> DataFrame:
    """Apply ``kernel`` where ``pairs`` (id, rb) wants a left row to meet a right block. Right rows have ``block``.

    All left rows that want a block meet it together, BLOCK_ROWS at a time: a left row is copied once for each block it
    wants, a block once for each ``tiles`` times BLOCK_ROWS rows that want it. Left rows are taken in rounds, so that a
    round makes about twice as many copies of them as the right side has rows, or ``round_rows`` if that is more. With
    ``part_wise`` it is half as many as the right side has, and a round has one of RIGHT_PARTS parts of the blocks. All
    three tables are stored ones. ``best`` keeps what may be wanted of a round's rows; a left row has all its rows in one
    round, or in one for each part.
    """
    hint = F.broadcast if few_blocks else (lambda df: df)
    # Both sides may come from one table, so the right one gets columns of its own.
    renamed = {c: f"right_{c}" for c in right.columns if c != "block"}
    nothing = to_arrow_schema(_parse_datatype_string(schema)).empty_table()
    copies, rows = pairs.count(), right.count()
    rounds = max(1, math.ceil(copies / max(rows // 2 if part_wise else 2 * rows, round_rows or ROUND_ROWS)))
    sides = min(RIGHT_PARTS, rounds) if part_wise else 1
    turns = math.ceil(rounds / sides)
    rounds = turns * sides

    def cell(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        if not len(left_rows) or not len(right_rows):
            return nothing
        theirs = right_rows.select(list(renamed.values())).rename_columns(list(renamed))
        few = [left_rows.slice(i, BLOCK_ROWS) for i in range(0, len(left_rows), BLOCK_ROWS)] if tiles > 1 else [left_rows]
        return pa.concat_tables([kernel(rows, theirs) for rows in few])

    def step(number: int) -> DataFrame:
        turn, side = divmod(number, sides)
        mine = F.pmod(F.xxhash64("id", F.lit("round")), F.lit(turns)) == turn
        asked, met = (left.where(mine), pairs.where(mine)) if turns > 1 else (left, pairs)
        if sides > 1:
            met = met.where(F.pmod(F.xxhash64("rb", F.lit("side")), F.lit(sides)) == side)
        parts = met.groupBy(F.col("rb").alias("block")).agg(F.ceil(F.count(F.lit(1)) / (tiles * BLOCK_ROWS)).cast("int").alias("_parts"))
        wanted = met.groupBy("id").agg(F.collect_list("rb").alias("_wanted"))
        a = asked.drop("block").join(wanted, "id").withColumn("block", F.explode("_wanted")).drop("_wanted").join(hint(parts), "block")
        a = a.withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")).drop("_parts")
        b = right.join(hint(parts), "block").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        b = b.withColumnsRenamed({"block": "_right_block", "_part": "_right_part", **renamed})
        found = a.groupBy("block", "_part").cogroup(b.groupBy("_right_block", "_right_part")).applyInArrow(cell, schema)
        return found if best is None or rounds == 1 else best(found)

    return in_rounds(left.sparkSession, rounds, step, "pair-scores")


def hashed_terms(weights: DataFrame) -> DataFrame:
    """``weights`` with terms as hashes of 64 bits: kernels only compare them, and they are shorter than words."""
    return weights.withColumn("term", F.xxhash64("term"))


def vectors(weights: DataFrame) -> DataFrame:
    """(id, terms, ws): one row per document from (id, term, w)."""
    pairs = weights.groupBy("id").agg(F.collect_list(F.struct("term", "w")).alias("p"))
    return pairs.select("id", F.col("p.term").alias("terms"), F.col("p.w").alias("ws"))


def _entries(table: pa.Table) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row number, term and weight of every vector entry."""
    terms = table["terms"].combine_chunks()
    lengths = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(table)), lengths)
    ws = table["ws"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return rows, terms.flatten(), ws


def dot_products(left: pa.Table, right: pa.Table) -> np.ndarray:
    """Dense (left rows x right rows) dot products of two blocks of sparse vectors.

    Terms that both blocks use often go through a matrix product, the others through their few
    matching pairs of entries.
    """
    l_row, l_term, l_w = _entries(left)
    r_row, r_term, r_w = _entries(right)
    shape = (len(left), len(right))
    if not len(l_row) or not len(r_row):
        return np.zeros(shape)
    kind = l_term.type if pa.types.is_integer(l_term.type) else pa.string()
    coded = pa.concat_arrays([l_term.cast(kind), r_term.cast(kind)]).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    l_code, r_code = codes[: len(l_row)], codes[len(l_row) :]
    n_terms = len(coded.dictionary)
    l_df = np.bincount(l_code, minlength=n_terms)
    r_df = np.bincount(r_code, minlength=n_terms)
    pairs = l_df * r_df

    scores = np.zeros(shape)
    dense = np.flatnonzero(pairs > SPARSE_PAIRS)
    column = np.full(n_terms, -1)
    # A slice of the dense terms at a time keeps both operands small.
    for start in range(0, len(dense), 2_000):
        some = dense[start : start + 2_000]
        column[:] = -1
        column[some] = np.arange(len(some))
        a = np.zeros((shape[0], len(some)))
        b = np.zeros((shape[1], len(some)))
        for m, row, code, w in ((a, l_row, l_code, l_w), (b, r_row, r_code, r_w)):
            keep = column[code] >= 0
            m[row[keep], column[code[keep]]] = w[keep]
        scores += a @ b.T

    few = (pairs > 0) & (pairs <= SPARSE_PAIRS)
    keep_l = few[l_code]
    order = np.argsort(l_code[keep_l], kind="stable")
    l_row, l_code, l_w = (x[keep_l][order] for x in (l_row, l_code, l_w))
    first = np.searchsorted(l_code, np.arange(n_terms))
    keep_r = np.flatnonzero(few[r_code])
    flat = scores.reshape(-1)
    for start in range(0, len(keep_r), 50_000):
        chunk = keep_r[start : start + 50_000]
        repeat = l_df[r_code[chunk]]
        total = int(repeat.sum())
        within = np.arange(total) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        at = np.repeat(first[r_code[chunk]], repeat) + within
        cell = l_row[at] * shape[1] + np.repeat(r_row[chunk], repeat)
        np.add.at(flat, cell, l_w[at] * np.repeat(r_w[chunk], repeat))
    return scores


def _take_best(
    scores: np.ndarray, wanted: np.ndarray, place: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the n best ``wanted`` scores of each row, compared as rounded; ties go to the larger place.

    Only scores that come near the n-th greatest are rounded and ordered.
    """
    scores = np.where(wanted, scores, -np.inf)
    n = min(n, scores.shape[1])
    line = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
    row, col = np.nonzero((scores >= (line - 2 / SCORE_UNIT)[:, None]) & wanted)
    units = np.rint(scores[row, col] * SCORE_UNIT)
    order = np.lexsort((-place(row, col), -units, row))
    row, col = row[order], col[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < n], col[nth < n]


def cosine_kernel(
    n: int, ties: str, exclude_self: bool = False, grouped: bool = False
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best n positive dot products per left row; ties go to the smaller (asc) or larger (desc) id.

    ``exclude_self`` uses the left column ``self_id``. ``grouped`` scores only rows of equal ``grp``
    and drops scores under the left column ``threshold``.
    """

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("id", "descending" if ties == "asc" else "ascending")])
        scores = dot_products(left, right)
        wanted = scores > 0
        if exclude_self:
            wanted &= left["self_id"].to_numpy()[:, None] != right["id"].to_numpy()[None, :]
        if grouped:
            both = pa.concat_arrays([left["grp"].combine_chunks(), right["grp"].combine_chunks()])
            codes = both.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            wanted &= codes[: len(left), None] == codes[None, len(left) :]
            # Rounded as it is for ranking, so that summation order cannot decide.
            wanted &= np.rint(scores * SCORE_UNIT) / SCORE_UNIT >= left["threshold"].to_numpy()[:, None]
        row, col = _take_best(scores, wanted, lambda row, col: col, n)
        return pa.table(
            {"request_id": left["id"].take(row), "id": right["id"].take(col), "sim": pa.array(scores[row, col])}
        )

    return kernel


def _dense(table: pa.Table) -> np.ndarray:
    flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(table), -1)


def product_kernel(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k right rows of greatest dot product per left row, itself left out; ties go to the smaller id."""

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("id")
        scores = np.round(_dense(left) @ _dense(right).T, 8)
        scores[left["id"].to_numpy()[:, None] == right["id"].to_numpy()[None, :]] = -np.inf
        # Only scores that reach the k-th greatest are ordered; NaNs come last, and set no line.
        nth = min(k, len(right)) - 1
        line = np.nan_to_num(-np.partition(-scores, nth, axis=1)[:, nth], nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        rows, cols = np.nonzero((scores >= line[:, None]) & np.isfinite(scores))
        order = np.lexsort((cols, -scores[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        rows, cols = rows[first], cols[first]
        return pa.table({"id": left["id"].take(rows), "other": right["id"].take(cols), "sim": pa.array(scores[rows, cols])})

    return kernel


def distance_kernel(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k nearest right rows per left row by Euclidean distance; ties go to the smaller id."""

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("id")
        a, b = _dense(left), _dense(right)
        best, near = [], []
        # Direct differences, a few left rows at a time: the expanded square loses digits.
        for start in range(0, len(left), 32):
            d = a[start : start + 32, None, :] - b[None, :, :]
            distances = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
            # Stable, so equal rounded distances keep id order.
            best.append(np.argsort(np.round(distances, 8), axis=1, kind="stable")[:, :k].copy())
            near.append(np.take_along_axis(distances, best[-1], axis=1))
        nearest = np.concatenate(best)
        rows, cols = np.repeat(np.arange(len(left)), nearest.shape[1]), nearest.reshape(-1)
        return pa.table(
            {
                "id": left["id"].take(rows),
                "neighbour": right["id"].take(cols),
                "label": right["label"].take(cols),
                "distance": pa.array(np.concatenate(near).reshape(-1)),
            }
        )

    return kernel


def mixed_kernel(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best n positive dot products per left row, each row under its own rules.

    Left columns: ``self_id`` (a right id to leave out, or null), ``grp`` (only right rows of that group, or null for
    all), ``threshold`` (least score) and ``larger_first`` (ties go to the larger id).
    """

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("id")
        scores = dot_products(left, right)
        own = pc.fill_null(left["self_id"], np.iinfo(np.int64).min).to_numpy()
        wanted = (scores > 0) & (own[:, None] != right["id"].to_numpy()[None, :])
        asked, there = (t["grp"].combine_chunks().cast(pa.string()) for t in (left, right))
        codes = pa.concat_arrays([asked, there]).dictionary_encode(null_encoding="encode")
        codes = codes.indices.to_numpy(zero_copy_only=False)
        free = asked.is_null().to_numpy(zero_copy_only=False)
        wanted &= free[:, None] | (codes[: len(left), None] == codes[None, len(left) :])
        wanted &= np.rint(scores * SCORE_UNIT) / SCORE_UNIT >= left["threshold"].to_numpy()[:, None]
        larger = left["larger_first"].to_numpy(zero_copy_only=False).astype(bool)
        row, col = _take_best(scores, wanted, lambda row, col: np.where(larger[row], col, -col), n)
        return pa.table(
            {"request_id": left["id"].take(row), "id": right["id"].take(col), "sim": pa.array(scores[row, col])}
        )

    return kernel
