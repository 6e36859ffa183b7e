"""Benchmark decontamination: spaced seeds find places, and a substitution-tolerant comparison decides.

A seed is a fixed mask over SPAN tokens; tokens at its zeros are ignored, so a changed word inside a passage leaves
other windows of that passage intact. Hashes of the benchmark's masked windows meet those of the documents. Each
meeting fixes a diagonal (place in the document minus place in the item); along it, the best run (+1 for an equal
token, -2 for another; of equally good ones that which begins first) is an overlap. A document is contaminated if some
overlap has at least ``LEAST`` equal tokens, or if 80 % of an item's tokens are equal along the whole diagonal. Items
of up to ``BRIEF`` tokens are also seeded by 3 or 4 tokens in a row, which 80 % of such an item always leave.

Tokens are runs of letters and digits in lower case (every character beyond ASCII counts as a letter). Items longer
than PIECE tokens are cut into pieces that overlap by OVERLAP. Items of under SHORT tokens are not looked for: any
document may hold them by chance.

The items' tokens are a table. Up to BLOCK_TOKENS tokens (counted) are sent to all tasks, and documents are looked
through where they lie. A larger benchmark stays a table: its seeds are joined with those of the documents that meet a
table of bits of fixed size, salted, one row for each (text, seed); diagonals that meet are then compared beside the
text and the piece. Either way it is one pass over the documents with the same seeds and the same comparison.

Null and empty texts contain nothing; null items are skipped; repeated rows are judged alike, each by itself. With an
empty benchmark all documents are clean. Extra columns are kept, those named like new ones replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.llm import hashing as H
from profilematch.llm.common import int_lists, slices, stored, tokens
from profilematch.operators.skew import MAX_BROADCAST_ROWS, expand_join

U = np.uint64
#: Fixed masks; the brief ones are for items of up to BRIEF tokens.
MASKS = ("11011001011", "11100110101", "10111010011")
BRIEF_MASKS = ("111", "1111")
SPAN, SHORT, BRIEF = len(MASKS[0]), 8, 20
LEAST = 13
MISMATCH = 2
BLOCK_TOKENS = 500_000
PIECE = 4096
OVERLAP = 256
BITS = 20
#: The joined way's table of bits is 2 ** 27 bits, 16 MB, whatever the benchmark.
FILTER_BITS = 27
MAX_PIECES = 100_000

_FACTORS = np.random.default_rng(20240608).integers(1, 2**63, SPAN, dtype=np.int64).astype(U) * U(2) + U(1)


def seeds(units: np.ndarray, mask: str) -> np.ndarray:
    """The hash of each window under the mask."""
    n = len(units) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U)
    total = np.zeros(n, U)
    for k, c in enumerate(mask):
        if c == "1":
            total += units[k : k + n] * _FACTORS[k]
    return H.mix(total)


def least_run(n: np.ndarray) -> np.ndarray:
    """Equal tokens in a row that are left wherever a fifth of n tokens is changed."""
    changed = n // 5
    return -(-(n - changed) // (changed + 1))


class Block:
    """Pieces of the benchmark's items, and for each mask a sorted table of seed hashes."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]]) -> None:
        self.item = np.array([i for i, _, _ in items], np.int64)
        self.whole = np.array([w for _, w, _ in items], np.int64)  # tokens of the whole item
        sizes = np.array([len(u) for _, _, u in items], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.units = np.concatenate([u for _, _, u in items]) if items else np.zeros(0, U)
        self.tables = []
        for mask, hashes, at in self.seeds():
            order = np.argsort(hashes, kind="stable")
            if len(at):
                seen = np.zeros(1 << BITS, bool)
                seen[hashes >> U(64 - BITS)] = True
                self.tables.append((mask, hashes[order], at[order], seen))

    def seeds(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """For each mask: the seeds inside pieces, and where in ``units`` they begin."""
        own = np.repeat(np.arange(len(self.item)), np.diff(self.begin))
        for mask in (*MASKS, *BRIEF_MASKS):
            n = max(0, len(self.units) - len(mask) + 1)
            inside = own[:n] == own[len(mask) - 1 :]
            if mask in BRIEF_MASKS:
                whole = self.whole[own[:n]]
                inside &= (whole <= BRIEF) & (np.minimum(least_run(whole), len(BRIEF_MASKS[-1])) == len(mask))
            at = np.flatnonzero(inside)
            yield mask, seeds(self.units, mask)[at], at

    def hits(self, units: np.ndarray, doc: np.ndarray, begins: np.ndarray):
        """(document, piece, diagonal) of all seeds that meet, each once."""
        found = []
        for mask, hashes, at, seen in self.tables:
            mine = seeds(units, mask)
            here = np.flatnonzero(seen[mine >> U(64 - BITS)])
            here = here[doc[here] == doc[here + len(mask) - 1]]
            low = np.searchsorted(hashes, mine[here], "left")
            n = np.searchsorted(hashes, mine[here], "right") - low
            here, low, n = here[n > 0], low[n > 0], n[n > 0]
            if not len(here):
                continue
            which = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(here, n)
            piece = np.searchsorted(self.begin, at[which], "right") - 1
            diagonal = (place - begins[doc[place]]) - (at[which] - self.begin[piece])
            found.append(np.stack([doc[place], piece, diagonal], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def overlap(self, units: np.ndarray, piece: int, diagonal: int) -> tuple[int, int]:
        """Equal tokens in the best run along a diagonal, and on all of it inside the piece."""
        own = self.units[self.begin[piece] : self.begin[piece + 1]]
        a, b = max(0, -diagonal), min(len(own), len(units) - diagonal)
        same = own[a:b] == units[a + diagonal : b + diagonal]
        total = np.concatenate([[0], np.cumsum(np.where(same, 1, -MISMATCH))])
        gain = total - np.minimum.accumulate(total)
        end = int(np.argmax(gain))
        start = int(np.argmin(total[: end + 1]))
        return int(same[start:end].sum()), int(same.sum())

    def held(self, units: np.ndarray, piece: int, diagonal: int) -> int:
        """Equal tokens of the overlap along a diagonal, 0 if it is none."""
        n, inside = self.overlap(units, piece, diagonal)
        most = -(-4 * int(self.whole[piece]) // 5)
        if inside >= most:  # changed ends count in: the item as a whole is there
            n = max(n, inside)
        return n if n >= min(LEAST, most) else 0

    def matches(self, column: pa.Array) -> list[dict[int, int]]:
        """For each text: the items that it holds, with the longest overlap."""
        units, doc = tokens(column)
        begins = np.searchsorted(doc, np.arange(len(column) + 1))
        out: list[dict[int, int]] = [{} for _ in range(len(column))]
        for d, piece, diagonal in self.hits(units, doc, begins).tolist():
            n, item = self.held(units[begins[d] : begins[d + 1]], piece, diagonal), int(self.item[piece])
            if n > out[d].get(item, 0):
                out[d][item] = n
        return out


_PIECES = "item_id long, whole long, units array<long>"


def pieces(benchmark: DataFrame) -> DataFrame:
    """(piece, item_id, whole, units), stored: the token hashes of each piece of an item, and the item's size."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                units, doc = tokens(part.column("text"))
                begins = np.searchsorted(doc, np.arange(part.num_rows + 1))
                rows = []
                for i, item in enumerate(part.column("item_id").to_pylist()):
                    own = units[begins[i] : begins[i + 1]].astype(np.int64)
                    if len(own) >= SHORT:
                        rows += [(item, len(own), own[at : at + PIECE]) for at in range(0, max(1, len(own) - OVERLAP), PIECE - OVERLAP)]
                sizes = np.array([len(u) for *_, u in rows], np.int64)
                values = pa.array(np.concatenate([u for *_, u in rows]) if rows else np.zeros(0, np.int64))
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, int_lists(sizes, values)], ["item_id", "whole", "units"])

    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("item_id").cast("long").alias("item_id"), "text")
    cut_up = rows.mapInArrow(cut, _PIECES).select(F.monotonically_increasing_id().alias("piece"), "*")
    return stored(cut_up, "pieces")


def _block(table: pa.Table | pa.RecordBatch) -> Block:
    columns = [np.asarray(table.column(c)) for c in ("item_id", "whole")]
    units = [np.asarray(u, np.int64).astype(U) for u in table.column("units").to_pylist()]
    return Block(list(zip(*columns, units)))


def _found_where_they_lie(docs: DataFrame, block: Block) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)
    names = [*docs.columns, "matches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = sent.value.matches(part.column("text"))
                lists = [[{"item_id": i, "n_tokens": n} for i, n in sorted(own.items())] for own in found]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, _ARROW)], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("matches", _MATCH)]))


def _piece_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, piece, place) of all seeds of pieces."""
    for batch in batches:
        block = _block(batch)
        piece = np.asarray(batch.column("piece"))
        for _, hashes, at in block.seeds():
            own = np.searchsorted(block.begin, at, "right") - 1
            columns = [hashes.astype(np.int64), piece[own], at - block.begin[own]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["seed", "piece", "place"])


def _filter_of(seeds_: DataFrame) -> np.ndarray:
    """2 ** FILTER_BITS bits: which leading bits of a seed occur. Its words are gathered, at most 2 ** 21 of them."""
    word = F.shiftrightunsigned("seed", 64 - FILTER_BITS + 6).alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("seed", 64 - FILTER_BITS).bitwiseAND(63).cast("int"))
    words = seeds_.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), U)
    out[np.asarray(words.column("word"))] = np.asarray(words.column("bits")).astype(U)
    return out


def _text_seeds(sent):
    """(key, seed, place) of the seeds of texts that the table of bits holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                units, doc = tokens(part.column("text"))
                begins = np.searchsorted(doc, np.arange(part.num_rows + 1))
                for mask in (*MASKS, *BRIEF_MASKS):
                    mine = seeds(units, mask)
                    lead = mine >> U(64 - FILTER_BITS)
                    here = np.flatnonzero((sent.value[lead >> U(6)] >> (lead & U(63))) & U(1))
                    here = here[doc[here] == doc[here + len(mask) - 1]]
                    key = part.column("key").take(pa.array(doc[here]))
                    columns = [pa.array(x.astype(np.int64)) for x in (mine[here], here - begins[doc[here]])]
                    yield pa.RecordBatch.from_arrays([key, *columns], ["key", "seed", "place"])

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, item_id, n_tokens) of the overlaps along the diagonals of each (text, piece)."""
    for batch in batches:
        for part in slices(batch, "text"):
            units, doc = tokens(part.column("text"))
            begins = np.searchsorted(doc, np.arange(part.num_rows + 1))
            block = _block(part)
            most = [
                max(block.held(units[begins[i] : begins[i + 1]], i, d) for d in own)
                for i, own in enumerate(part.column("diagonals").to_pylist())
            ]
            columns = [part.column("key"), part.column("item_id"), pa.array(most, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "item_id", "n_tokens"])


def _found_by_join(docs: DataFrame, items: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    known = stored(items.mapInArrow(_piece_seeds, "seed long, piece long, place long"), "seeds")
    sent = spark.sparkContext.broadcast(_filter_of(known))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"), "text")
    mine = rows.select("key", "text").mapInArrow(_text_seeds(sent), "key binary, seed long, place long").distinct()
    met = expand_join(mine, known.withColumnRenamed("place", "_at"), "seed", F.struct("key", "place"), False)
    diagonals = met.groupBy("key", "piece").agg(F.collect_set(F.col("place") - F.col("_at")).alias("diagonals"))
    diagonals = stored(diagonals, "diagonals")  # at most as many to a row as the text and a piece have tokens
    texts = rows.select("key", "text").join(diagonals.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    beside = expand_join(diagonals, items, "piece", "key", items.count() <= MAX_PIECES).join(texts, "key")
    overlaps = beside.mapInArrow(_compare, "key binary, item_id long, n_tokens int").where("n_tokens > 0")
    longest = overlaps.groupBy("key", "item_id").agg(F.max("n_tokens").alias("n_tokens"))
    own = longest.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("item_id", "n_tokens"))).alias("matches"))
    own = stored(own, "matches")
    back = expand_join(rows, own, "key", F.struct("row"), own.count() <= MAX_BROADCAST_ROWS, "left")
    return back.select("row.*", F.coalesce(F.col("matches").cast(_MATCH), F.array().cast(_MATCH)).alias("matches"))


_MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("n_tokens", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("n_tokens", pa.int32())]))


def find_matches(docs: DataFrame, benchmark: DataFrame, limit: int = BLOCK_TOKENS) -> DataFrame:
    """``docs`` with ``matches``: array of (item_id, n_tokens), the benchmark items that the text holds.

    A benchmark of more than ``limit`` tokens is joined, a smaller one sent to all tasks; the result is the same.
    """
    docs = docs.drop("matches")
    items = pieces(benchmark)
    size = items.agg(F.sum(F.size("units"))).first()[0] or 0
    if size > limit:
        return _found_by_join(docs, items)
    return _found_where_they_lie(docs, _block(items.toArrow()))


def decontaminate(docs: DataFrame, benchmark: DataFrame, limit: int = BLOCK_TOKENS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    named = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return find_matches(named, benchmark, limit).where(F.size("matches") == 0).select("row.*")
