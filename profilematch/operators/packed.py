"""Sparse vectors in packed blocks, and scores of blocks that tasks read from the shared folder.

Vectors are written once, as blocks of bounded size: the entries of a block lie in the order of their terms, with the rows
that hold a term side by side. A task keeps a few left blocks and reads the right ones, one after the other. So no row is
copied or shuffled for each block it meets, and what lies on disk is the vectors of both sides, however many blocks meet.

Rows that share frequent terms lie in the same blocks where they can. Terms that two blocks use often go through a matrix
product, the others through their matching entries. The product is made in 32 bits; pairs that come within its greatest
error of what is asked are computed anew in 64 bits, so no score depends on it. Weights must not be negative, and right ids
are whole numbers. Files are opened with pyarrow, so the shared folder must be on a store that pyarrow knows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilematch.operators import blocks
from profilematch.operators.blocks import SCORE_UNIT
from profilematch.session import shuffle_cleanup, step_path

# The kernels travel with the job, so executors need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A block has fewer rows than the first and fewer entries than the second; it is cut from a pool of so many entries.
PACK_ROWS, PACK_ENTRIES, POOL_ENTRIES = 3_000, 4_000_000, 4_000_000
#: Kinds of rows in a pool at most; rows of a kind at least, on average.
KINDS, KIND_ROWS = 64, 100
#: Entries and rows on the left that a task keeps; tasks for each core.
LEFT_ENTRIES, LEFT_ROWS, TASKS_A_CORE = 2_400_000, 4_000, 8
#: A column of a matrix product costs as much as this part of its cells as single pairs.
DENSE_SHARE = 700
#: Columns of a product at a time; up to twice as many are kept until the cell is done.
COLUMNS = 1_024
#: Single pairs and pairs to compute anew that are held at a time.
PAIRS, AGAIN = 50_000, 4_096
PACKED = "block string, kind double, n_rows long, n_entries long, n_marked long, terms binary, sizes binary, places binary, ws binary, rest binary"
NO_ID = np.iinfo(np.int64).min


@dataclass
class Block:
    """``places`` and ``ws`` of term ``terms[i]`` are those from ``starts[i]`` to ``starts[i + 1]``; ``rest``: other columns."""

    terms: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    ws: np.ndarray
    rest: pa.Table
    rows: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __len__(self) -> int:
        return len(self.rest)

    def ids(self, name: str = "id") -> np.ndarray:
        return pc.fill_null(self.rest[name].cast(pa.int64()), NO_ID).to_numpy()

    def only(self, rows: np.ndarray) -> Block:
        """The block of the rows where ``rows`` is true."""
        if rows.all():
            return self
        kept = rows[self.places]
        sizes = np.diff(np.concatenate([[0], np.cumsum(kept)])[self.starts])
        there = sizes > 0
        places = (np.cumsum(rows) - 1)[self.places[kept]].astype(self.places.dtype)
        starts = np.concatenate([[0], np.cumsum(sizes[there])])
        return Block(self.terms[there], starts, places, self.ws[kept], self.rest.filter(pa.array(rows)))

    def by_row(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, number of the term, weight) of all entries, row by row."""
        if self.rows is None:
            order = np.argsort(self.places, kind="stable")
            term = np.repeat(np.arange(len(self.terms), dtype=np.int32), np.diff(self.starts))
            self.rows = self.places[order].astype(np.int64), term[order], self.ws[order]
        return self.rows

    @staticmethod
    def together(some: list[Block]) -> Block:
        """The rows of several blocks as one."""
        if len(some) == 1:
            return some[0]
        term = np.concatenate([np.repeat(b.terms, np.diff(b.starts)) for b in some])
        rows = np.cumsum([0, *map(len, some)])
        places = np.concatenate([b.places.astype(np.int32) + row for b, row in zip(some, rows, strict=False)])
        return _ordered(term, places, np.concatenate([b.ws for b in some]), pa.concat_tables([b.rest for b in some]).combine_chunks())

    def vectors(self) -> pa.Table:
        """The rows as they were packed, with ``terms`` and ``ws``."""
        order = np.argsort(self.places, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(self.places, minlength=len(self)))]).astype(np.int32)
        lists = (np.repeat(self.terms, np.diff(self.starts))[order], self.ws[order])
        out = self.rest
        for name, values in zip(("terms", "ws"), lists, strict=True):
            out = out.append_column(name, pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
        return out


def _pack(table: pa.Table) -> Block:
    """One block of the rows of ``table`` (terms, ws, others)."""
    terms = table["terms"].combine_chunks()
    term, ws = (x.flatten().to_numpy(zero_copy_only=False) for x in (terms, table["ws"].combine_chunks()))
    lengths = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    places = np.repeat(np.arange(len(table), dtype=np.uint16), lengths)
    return _ordered(term, places, ws, table.drop_columns(["terms", "ws"]))


def _ordered(term: np.ndarray, places: np.ndarray, ws: np.ndarray, rest: pa.Table) -> Block:
    """A block of entries that come row by row; a term that a row has twice counts with the sum of its weights."""
    order = np.argsort(term, kind="stable")
    term, places, ws = term[order], places[order], ws[order]
    new = np.concatenate([[True], (term[1:] != term[:-1]) | (places[1:] != places[:-1])])[: len(term)]
    if not new.all():
        ws, term, places = np.add.reduceat(ws, np.flatnonzero(new)), term[new], places[new]
    first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
    return Block(term[first], np.append(first, len(term)), places, ws, rest)


def _cut(table: pa.Table, most_rows: int, top: list[int] | None, kind_rows: int = KIND_ROWS) -> Iterator[tuple[float, pa.Table]]:
    """Rows of ``table`` in parts of bounded size, each of few kinds, and the mean of these.

    A row's kind is the first of ``top`` that it has, or of the pool's most frequent terms.
    """
    terms = table["terms"].combine_chunks()
    lengths = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    term = terms.flatten().to_numpy()
    kinds = max(1, min(KINDS, len(table) // kind_rows))
    if top is None:
        found, counts = np.unique(term, return_counts=True)
        top = found[np.lexsort((found, -counts))[:kinds]]
    top = np.array(top[:kinds], np.int64)
    kind = np.full(len(table), len(top))
    if len(top):
        order = np.argsort(top)
        at = np.minimum(np.searchsorted(top[order], term), len(top) - 1)
        is_top = top[order][at] == term
        np.minimum.at(kind, np.repeat(np.arange(len(table)), lengths)[is_top], order[at[is_top]])
    order = np.argsort(kind, kind="stable")
    size = np.cumsum(1 / min(PACK_ROWS, most_rows) + lengths[order] / PACK_ENTRIES)
    parts = max(1, math.ceil(size[-1]))
    part = np.minimum((size - size[0]) * parts / size[-1], parts - 1).astype(int)
    for number in range(parts):
        rows = order[part == number]
        if len(rows):
            yield float(kind[rows].mean()), table.take(pa.array(rows)).combine_chunks()


def _packer(most_rows: int, mark: str | None, top: list[int] | None, kind_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, entries, number, task = [], 0, 0, TaskContext.get().partitionId()

        def packed() -> Iterator[pa.RecordBatch]:
            for kind, part in _cut(pa.Table.from_batches(pool).combine_chunks(), most_rows, top, kind_rows):
                block = _pack(part)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, block.rest.schema) as out:
                    out.write_table(block.rest)
                marked = len(part) if mark is None else pc.sum(pc.fill_null(part[mark], False)).as_py() or 0
                data = [block.terms, np.diff(block.starts).astype(np.int32), block.places, block.ws]
                values = [kind, len(part), len(block.ws), marked, *(x.tobytes() for x in data), sink.getvalue().to_pybytes()]
                yield values

        def batch(values: list) -> pa.RecordBatch:
            nonlocal number
            number += 1
            types = [pa.string(), pa.float64(), *[pa.int64()] * 3, *[pa.binary()] * 5]
            columns = [pa.array([v], t) for v, t in zip([f"{task}-{number}", *values], types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PACKED.split(", ")])

        for some in batches:
            if len(some):
                pool.append(some)
                entries += len(some.column("terms").flatten())
            if entries >= POOL_ENTRIES:
                yield from map(batch, packed())
                pool, entries = [], 0
        if pool:
            yield from map(batch, packed())

    return run


@dataclass(frozen=True)
class Store:
    """Packed blocks: ``blocks`` has (block, file, rows, entries, marked) of each, those of like kinds side by side."""

    table: DataFrame
    blocks: list[tuple[str, str, int, int, int]]


def pack_blocks(
    vectors: DataFrame,
    label: str,
    mark: str | None = None,
    top: list[int] | None = None,
    kind_rows: int = KIND_ROWS,
    most_rows: int | None = None,
) -> Store:
    """Write ``vectors`` (id, terms, ws, others) as blocks; ``mark`` is a column of truth values to count.

    Terms are whole numbers. Each block is a file of its own. ``top``: terms that tell kinds.
    """
    spark = vectors.sparkSession
    few = 2 * spark.sparkContext.defaultParallelism
    path = step_path(spark, label)
    packed = vectors.coalesce(few).mapInArrow(_packer(most_rows or blocks.ROUND_ROWS, mark, top, kind_rows), PACKED)
    with shuffle_cleanup(spark):
        packed.write.option("maxRecordsPerFile", 1).option("parquet.enable.dictionary", "false").parquet(path)
    table = spark.read.schema(PACKED).parquet(path)
    listed = table.select("block", F.input_file_name(), "n_rows", "n_entries", "n_marked", "kind").collect()
    return Store(table, [tuple(b)[:5] for b in sorted(listed, key=lambda b: (b.kind, *map(int, b.block.split("-"))))])


def _read(row: dict) -> Block:
    numbers = [np.frombuffer(row[c], t) for c, t in (("terms", np.int64), ("sizes", np.int32), ("places", np.uint16), ("ws", np.float64))]
    starts = np.concatenate([[0], np.cumsum(numbers[1], dtype=np.int64)])
    rest = pa.ipc.open_stream(row["rest"]).read_all().combine_chunks()
    return Block(numbers[0], starts, numbers[2], numbers[3], rest)


def _load(file: str) -> Block:
    system, path = fs.FileSystem.from_uri(file)
    return _read(pq.read_table(path, filesystem=system, partitioning=None).to_pylist()[0])


def unpacked(store: Store, schema: str, mark: str | None = None, vectors: bool = True) -> DataFrame:
    """The rows of a store with their ``block``, only those that have ``mark`` if that is given. ``schema`` is theirs."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _read(row)
                rows = block.vectors() if vectors else block.rest
                rows = rows.append_column("block", pa.array([row["block"]] * len(rows), pa.string()))
                if mark is not None:
                    rows = rows.filter(pc.fill_null(rows[mark], False))
                yield from rows.select(names).to_batches()

    table = store.table if vectors else store.table.withColumns({c: F.lit(b"") for c in ("terms", "sizes", "places", "ws")})
    return table.mapInArrow(run, schema)


def summaries_of(store: Store) -> DataFrame:
    """(id, terms, ws) of each block: the greatest weight of each term in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _read(row)
                most = np.maximum.reduceat(block.ws, block.starts[:-1]) if len(block.ws) else block.ws
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in (block.terms, most)]
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]]), *lists], ["id", "terms", "ws"])

    return store.table.mapInArrow(run, "id string, terms array<bigint>, ws array<double>")


class Cell:
    """Scores of the rows of two blocks.

    ``near``: all of them, in 32 bits. A true score is ``near`` with an error of ``error`` times itself, at most.
    """

    def __init__(self, left: Block, right: Block) -> None:
        self.left, self.right = left, right
        shape = len(left), len(right)
        if len(left.terms) and len(right.terms):
            at = np.searchsorted(right.terms, left.terms)
            at[at == len(right.terms)] = 0
            mine = np.flatnonzero(right.terms[at] == left.terms)
            theirs = at[mine]
        else:
            mine = theirs = np.zeros(0, np.int64)
        sizes = [b.starts[x + 1] - b.starts[x] for b, x in ((left, mine), (right, theirs))]
        often = sizes[0] * sizes[1] * DENSE_SHARE > shape[0] * shape[1]
        self.dense = [(mine[often], sizes[0][often]), (theirs[often], sizes[1][often])]
        self.error = (int(often.sum()) + 16) * 2.0**-24
        self.kept: list[tuple[np.ndarray, np.ndarray]] | None = [] if often.sum() <= 2 * COLUMNS else None
        self.near = np.zeros(shape, np.float32)
        for a, b in self._columns():
            self.near += a.astype(np.float32) @ b.astype(np.float32).T
            if self.kept is not None:
                self.kept.append((a, b))
        self.single = np.zeros(shape)
        few = ~often
        if few.any():
            self._add_single(mine[few], theirs[few], sizes[1][few])
            self.near += self.single
        self.whole = False

    def _columns(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Columns of the terms that both blocks use often, some at a time."""
        for start in range(0, len(self.dense[0][0]), COLUMNS):
            sides = []
            for block, (terms, sizes) in zip((self.left, self.right), self.dense, strict=True):
                terms, sizes = terms[start : start + COLUMNS], sizes[start : start + COLUMNS]
                column = np.repeat(np.arange(len(terms)), sizes)
                at = np.arange(len(column)) + np.repeat(block.starts[terms] - (np.cumsum(sizes) - sizes), sizes)
                side = np.zeros((len(block), len(terms)))
                side[block.places[at], column] = block.ws[at]
                sides.append(side)
            yield sides[0], sides[1]

    def _add_single(self, mine: np.ndarray, theirs: np.ndarray, r_size: np.ndarray) -> None:
        """Add the products of matching entries. Left entries come row by row, so sums of one row are made together."""
        right, flat = self.right, self.single.reshape(-1)
        row, term, ws = self.left.by_row()
        size, first = (np.zeros(len(self.left.terms), np.int64) for _ in range(2))
        size[mine], first[mine] = r_size, right.starts[theirs]
        times = size[term]
        there = np.flatnonzero(times)
        times, first, base, ws = times[there], first[term[there]], row[there] * len(right), ws[there]
        total = np.cumsum(times)
        bounds = [0, *(np.searchsorted(total, np.arange(PAIRS, total[-1], PAIRS)) + 1).tolist(), len(there)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a >= b:
                continue
            n = times[a:b]
            at = np.repeat(first[a:b] - (np.cumsum(n) - n), n)
            at += np.arange(len(at))
            cell = np.repeat(base[a:b], n)
            cell += right.places[at]
            product = right.ws[at]
            product *= np.repeat(ws[a:b], n)
            np.add.at(flat, cell, product)

    def exact(self, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """The scores of some pairs. Where there are many, all are made once by a product in 64 bits."""
        if not self.whole and len(row) * 64 > self.near.size:
            for a, b in self.kept if self.kept is not None else self._columns():
                self.single += a @ b.T
            self.whole = True
        out = self.single[row, col]
        if not self.whole and len(row):
            for a, b in self.kept if self.kept is not None else self._columns():
                for i in range(0, len(row), AGAIN):
                    some = slice(i, i + AGAIN)
                    out[some] += np.einsum("ij,ij->i", a[row[some]], b[col[some]])
        return out

    def reach(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, score) of all pairs whose score could come to the ``line`` of their row."""
        row, col = np.nonzero(self.near >= (line * (1 - 2 * self.error) - 1e-9).astype(np.float32)[:, None])
        return row, col, self.exact(row, col)


class Best:
    """The n best of each left row so far, each row under its own rules.

    Columns of the block that count: ``self_id`` (a right id to leave out), ``grp`` (only right rows of that group, null for
    all), ``threshold`` (least score), ``larger_first`` (ties go to the larger id) and ``line`` (nothing below is asked).
    """

    def __init__(self, left: Block, n: int, ties: str) -> None:
        rows, names = len(left), left.rest.column_names
        codes: dict[str, int] = {}
        self.left, self.n, self.codes = left, n, codes
        self.own = left.ids("self_id") if "self_id" in names else np.full(rows, NO_ID)
        self.grp = _codes(left, codes) if "grp" in names else np.full(rows, -1)
        self.threshold = left.rest["threshold"].to_numpy() if "threshold" in names else np.full(rows, -np.inf)
        larger = np.full(rows, ties == "desc")
        self.larger = left.rest["larger_first"].to_numpy(zero_copy_only=False).astype(bool) if "larger_first" in names else larger
        self.line = left.rest["line"].to_numpy().copy() if "line" in names else np.zeros(rows)
        np.maximum(self.line, self.threshold, out=self.line)
        self.row, self.id, self.sim = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def meet(self, right: Block, rows: np.ndarray | None = None) -> None:
        """Score a right block against all left rows, or those where ``rows`` is true."""
        left = self.left if rows is None else self.left.only(rows)
        mine = np.arange(len(self.left)) if rows is None else np.flatnonzero(rows)
        if not len(mine) or not len(right):
            return
        cell, ids = Cell(left, right), right.ids()
        near, own = cell.near, self.own[mine]
        order = np.argsort(ids, kind="stable")
        at = order[np.minimum(np.searchsorted(ids[order], own), len(ids) - 1)]
        itself = np.flatnonzero((ids[at] == own) & (own != NO_ID))
        near[itself, at[itself]] = -1
        if (self.grp[mine] >= 0).any():
            theirs = _codes(right, self.codes)
            bound = np.flatnonzero(self.grp[mine] >= 0)
            near[bound] = np.where(self.grp[mine][bound][:, None] == theirs[None, :], near[bound], np.float32(-1))
        line = self.line[mine]
        # Rows without n so far get a line from this cell alone.
        unset = np.flatnonzero(line <= 0)
        if len(unset) and len(right) > self.n:
            nth = len(right) - self.n
            line[unset] = np.maximum(np.partition(near[unset], nth, axis=1)[:, nth] * (1 - 2 * cell.error) - 2 / SCORE_UNIT, 0)
        reached = near >= np.maximum(line * (1 - 2 * cell.error) - 1e-9, 1e-37).astype(np.float32)[:, None]
        row, col = np.nonzero(reached)
        sim = cell.exact(row, col)
        units = np.rint(sim * SCORE_UNIT)
        wanted = (sim > 0) & (units / SCORE_UNIT >= self.threshold[mine][row])
        self._keep(mine[row[wanted]], ids[col[wanted]], sim[wanted])

    def _keep(self, row: np.ndarray, ids: np.ndarray, sim: np.ndarray) -> None:
        if not len(row):
            return
        row, ids, sim = (np.concatenate(x) for x in ((self.row, row), (self.id, ids), (self.sim, sim)))
        tie = np.where(self.larger[row], ~ids, ids)
        order = np.lexsort((tie, -np.rint(sim * SCORE_UNIT), row))
        row, ids, sim = row[order], ids[order], sim[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        kept = nth < self.n
        self.row, self.id, self.sim = row[kept], ids[kept], sim[kept]
        last = nth[kept] == self.n - 1
        self.line[self.row[last]] = np.maximum(self.line[self.row[last]], self.sim[last] - 2 / SCORE_UNIT)

    def found(self, schema: pa.Schema) -> pa.Table:
        """(request_id, id, sim)."""
        ids = pa.array(self.id, mask=self.id == NO_ID)
        columns = [self.left.rest["id"].take(pa.array(self.row)), ids, pa.array(self.sim)]
        return pa.table([c.cast(t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _codes(block: Block, codes: dict[str, int]) -> np.ndarray:
    """Groups as numbers that the blocks of a task share; -1 for none."""
    groups = block.rest["grp"].cast(pa.string()).to_pylist()
    return np.array([-1 if g is None else codes.setdefault(g, len(codes)) for g in groups], np.int64)


def left_groups(listed: list[tuple[str, str, int, int, int]], share: float = 1.0, most: int | None = None) -> list[list[tuple]]:
    """Blocks that a task keeps together: as many as LEFT_ENTRIES and LEFT_ROWS allow, if ``share`` of their rows is asked."""
    groups: list[list[tuple]] = []
    rows = entries = 0.0
    for block in listed:
        if not block[4]:
            continue
        mine = block[4] * share, block[3] * block[4] / max(1, block[2]) * share
        if not groups or rows + mine[0] > min(LEFT_ROWS, most or blocks.ROUND_ROWS) or entries + mine[1] > LEFT_ENTRIES:
            groups.append([])
            rows = entries = 0.0
        groups[-1].append(block)
        rows, entries = rows + mine[0], entries + mine[1]
    return groups


def asking(files: list[str], mark: str | None) -> Block:
    """The rows of some blocks that ask, as one; with ``mark`` those that have it, each with itself to leave out."""
    some = [_load(file) for file in files]
    if mark is None:
        return Block.together(some)
    one = Block.together([b.only(pc.fill_null(b.rest[mark], False).to_numpy(zero_copy_only=False)) for b in some])
    one.rest = one.rest.append_column("self_id", one.rest["id"])
    return one


def round_count(rows: int, groups: int) -> int:
    return max(1, min(groups, math.ceil(rows / blocks.ROUND_ROWS)))


def _in_tasks(spark: SparkSession, tasks: list, run: Callable[..., Iterator[pa.Table]], schema: str) -> DataFrame:
    """What ``run`` yields for each of ``tasks``, each a task of Spark's."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                for table in run(*tasks[number]):
                    yield from table.to_batches(max_chunksize=100_000)

    return spark.range(0, len(tasks), 1, max(1, len(tasks))).mapInArrow(each, schema)


def best_of_blocks(
    left: Store, right: Store, n: int, ties: str, schema: str, best: Callable[[DataFrame], DataFrame], mark: str | None = None
) -> DataFrame:
    """(request_id, id, sim), a superset of the best n of each left row against all right rows.

    A task keeps some left blocks and reads a part of the right ones. With ``mark`` only left rows that have it ask, each
    against all rows but itself. ``best`` keeps what may be wanted of a round's rows.
    """
    spark = left.table.sparkSession
    types = blocks.to_arrow_schema(blocks._parse_datatype_string(schema))
    groups = left_groups(left.blocks)
    rounds = round_count(sum(b[4] for b in left.blocks), len(groups))
    parts = max(1, min(len(right.blocks), math.ceil(TASKS_A_CORE * spark.sparkContext.defaultParallelism * rounds / max(1, len(groups)))))

    def run(lefts: list[str], rights: list[str]) -> Iterator[pa.Table]:
        mine = Best(asking(lefts, mark), n, ties)
        for file in rights:
            mine.meet(_load(file))
        yield mine.found(types)

    def step(number: int) -> DataFrame:
        theirs = [[b[1] for b in right.blocks[p::parts]] for p in range(parts)]
        tasks = [([b[1] for b in g], some) for some in theirs for g in groups[number::rounds]]
        found = _in_tasks(spark, tasks, run, schema)
        return found if rounds == 1 or parts == 1 else best(found)

    return blocks.in_rounds(spark, rounds, step, "grid-rounds")


def own_best(store: Store, mark: str, n: int, ties: str, schema: str) -> DataFrame:
    """(request_id, id, sim): the best n of each marked row in its own block, itself left out."""
    types = blocks.to_arrow_schema(blocks._parse_datatype_string(schema))
    mine = [b for b in store.blocks if b[4]]
    rounds = round_count(sum(b[4] for b in mine), len(mine))

    def run(file: str) -> Iterator[pa.Table]:
        best = Best(asking([file], mark), n, ties)
        best.meet(_load(file))
        yield best.found(types)

    def step(number: int) -> DataFrame:
        return _in_tasks(store.table.sparkSession, [(b[1],) for b in mine[number::rounds]], run, schema)

    return blocks.in_rounds(store.table.sparkSession, rounds, step, "own-block-scores")


def best_of_pairs(
    store: Store, pairs: DataFrame, asked: int, share: float, mark: str, n: int, ties: str, schema: str, best: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """(request_id, id, sim), a superset of the best n of the marked rows in the blocks that ``pairs`` wants them to meet.

    ``pairs``: (id, rb, line, block), ``block`` being the row's own and ``line`` the least score that counts; a stored table.
    Of ``asked`` rows a ``share`` is in it. A task keeps the rows of some blocks and reads those that they want.
    """
    spark = store.table.sparkSession
    types = blocks.to_arrow_schema(blocks._parse_datatype_string(schema))
    groups = left_groups(store.blocks, share)
    rounds = round_count(math.ceil(asked * share), len(groups))
    parts = max(1, min(len(store.blocks), math.ceil(TASKS_A_CORE * spark.sparkContext.defaultParallelism * rounds / max(1, len(groups)))))
    files = {b[0]: b[1] for b in store.blocks}
    order = {b[0]: k for k, b in enumerate(store.blocks)}

    def meeting(wanted: pa.Table) -> pa.Table:
        lefts = sorted(wanted["block"].unique().to_pylist(), key=order.get)
        left = asking([files[b] for b in lefts], mark)
        ids = left.ids()
        by_id = np.argsort(ids, kind="stable")
        row = by_id[np.searchsorted(ids[by_id], wanted["id"].cast(pa.int64()).to_numpy())]
        there = np.zeros(len(left), bool)
        there[row] = True
        line = np.zeros(len(left))
        line[row] = wanted["line"].to_numpy()
        left.rest = left.rest.append_column("line", pa.array(line))
        mine, row = Best(left.only(there), n, ties), (np.cumsum(there) - 1)[row]
        coded = wanted["rb"].combine_chunks().dictionary_encode()
        code, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        for number in sorted(range(len(names)), key=lambda k: order[names[k]]):
            some = np.zeros(len(mine.left), bool)
            some[row[code == number]] = True
            # If most rows want it, all meet it: that costs less than to cut out the others. A row's own block is not met again.
            all_rows = names[number] not in lefts and 2 * some.sum() >= len(some)
            mine.meet(_load(files[names[number]]), None if all_rows else some)
        return mine.found(types)

    places = [(b[0], k) for k, g in enumerate(groups) for b in g]
    task = F.broadcast(spark.createDataFrame(places, "block string, _task int"))
    dealt = pairs.join(task, "block").withColumn("_part", F.pmod(F.xxhash64("rb"), F.lit(parts)))

    def step(number: int) -> DataFrame:
        mine = dealt if rounds == 1 else dealt.where(F.col("_task") % rounds == number)
        found = mine.groupBy("_task", "_part").applyInArrow(meeting, schema)
        return found if rounds == 1 or parts == 1 else best(found)

    return blocks.in_rounds(spark, rounds, step, "pair-scores")


def pairs_of_blocks(
    store: Store, groups: list[list[tuple]], rounds: int, threshold: float, schema: str, in_rounds: Callable[..., DataFrame]
) -> DataFrame:
    """(id_a, id_b, sim), or with ``n_a`` and ``n_b`` too if the rows have ``n``: all pairs of rows above ``threshold``.

    A task keeps the blocks of a group and reads those from the group on. One round is left to the caller's job: its pairs
    are neither shuffled nor stored.
    """
    spark = store.table.sparkSession
    types = blocks.to_arrow_schema(blocks._parse_datatype_string(schema))
    files = [b[1] for b in store.blocks]
    first = np.cumsum([0, *(len(g) for g in groups)]).tolist()
    parts = max(1, math.ceil(2 * TASKS_A_CORE * spark.sparkContext.defaultParallelism / len(groups)))

    def run(begin: int, end: int, others: list[int]) -> Iterator[pa.Table]:
        some = [_load(file) for file in files[begin:end]]
        left, sizes = Block.together(some), np.cumsum([0, *map(len, some)])
        ids, line = left.ids(), np.full(len(left), threshold)
        for number in others:
            right = _load(files[number])
            cell = Cell(left, right)
            row, col, sim = cell.reach(line)
            wanted = np.rint(sim * SCORE_UNIT) / SCORE_UNIT > threshold
            if number < end:
                # of the group's own blocks each pair is taken once
                wanted &= row < sizes[number - begin] + col
            row, col = row[wanted], col[wanted]
            a, b = ids[row], right.ids()[col]
            columns = [pa.array(x, mask=x == NO_ID) for x in (np.minimum(a, b), np.maximum(a, b))]
            columns.append(pa.array(sim[wanted]))
            if "n" in left.rest.column_names:
                n = left.rest["n"].to_numpy()[row], right.rest["n"].to_numpy()[col]
                columns += [pa.array(np.where(a < b, *n)), pa.array(np.where(a < b, *n[::-1]))]
            yield pa.table([c.cast(t) for c, t in zip(columns, types.types, strict=True)], schema=types)

    def step(number: int) -> DataFrame:
        tasks = []
        for g in range(number, len(groups), rounds):
            others = list(range(first[g], len(files)))
            tasks += [(first[g], first[g + 1], others[p::parts]) for p in range(min(parts, len(others)))]
        return _in_tasks(spark, tasks, run, schema)

    return in_rounds(spark, rounds, step, "pairs-above")
