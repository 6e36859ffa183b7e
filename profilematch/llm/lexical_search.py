"""Ranked lexical search by pipelined term partitioning.

Terms have owners: stage 0 owns the rarest, the last stage the most frequent ones. Documents lie in chunks of bounded
size, items in groups. A bundle holds, for one item and one chunk, the sparse accumulators (document, score so far). It
visits the owners in turn: a cogroup by chunk and group brings bundles and the owner's postings together, integer
contributions are added, and what can't reach the chunk's ten best any more is left behind. After the last stage the
best of each chunk and item remain, and a window takes the best of all chunks.

Leaving behind is exact: a document goes only if its score so far plus an upper bound of all later terms is below the
``top``-th best score so far, which can only grow. A document that comes back later has less than that and loses.

Terms are maximal runs of letters, digits and characters beyond ASCII, with A-Z lower-cased. Each row of ``docs`` is a
document, repeated rows too; null texts have no terms and don't count in N. Among equal scores the smaller doc_id comes
first, null doc_ids last. Rows of ``items`` with one item_id are one item; rows with a null item_id or text ask nothing.
Items without any hit have no rows. Extra columns of both tables are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profilematch.llm import hashing as H
from profilematch.llm.common import APART, slices, stored, text_bytes

TOP = 10
STAGES = 4
CHUNK_DOCS = 4096
CHUNK_BYTES = 16 << 20
#: Items of a group, on average; a group's accumulators of a chunk are one array in a task.
GROUP = 128
#: Terms of the items that may be sent to every task; beyond it all terms of the documents are written, then joined.
MAX_TERMS, MAX_TERM_BYTES = 200_000, 8 << 20
MAX_PLAN = 200_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POSTINGS = (
    "chunk string, term string, df long, least double, docs binary, tfs binary, lens binary, "
    "ids array<bigint>, n_docs long, n_terms long"
)
_BUNDLE = "chunk string, part int, item_id long, rem long, docs binary, scores binary"


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once."""
    lowered = F.translate("text", UPPER, UPPER.lower())
    asked = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    terms = asked.select(F.col("item_id").cast("long"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    return terms.distinct()


def _packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value for each range of ``values``."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


class _Chunk:
    """Postings of up to CHUNK_DOCS documents. Its name is drawn at random: postings are written before they are used."""

    def __init__(self) -> None:
        self.name = uuid.uuid4().hex
        self.terms: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.size = 0
        self.lens: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, part: pa.RecordBatch, known: dict[bytes, int] | None, hashes: np.ndarray | None) -> None:
        data, offsets = text_bytes(part.column("text"))
        data = LOWER[data]
        starts, ends, doc = H.word_spans(data, offsets, APART)
        self.lens.append(np.bincount(doc, minlength=part.num_rows))
        h1 = H.word_hashes(data, starts, ends)
        if hashes is not None:
            at = np.minimum(np.searchsorted(hashes, h1), max(0, len(hashes) - 1))
            pick = hashes[at] == h1 if len(hashes) else np.zeros(len(h1), bool)
            starts, ends, doc, h1 = starts[pick], ends[pick], doc[pick], h1[pick]
        if len(h1):
            raw = data.tobytes()
            _, first, which = np.unique(h1, return_index=True, return_inverse=True)
            h2 = H.word_hashes(data, starts, ends, H.BASES[1])
            if (h2 != h2[first][which]).any():  # two terms with one hash in this slice: tell all apart by their bytes
                first = which = np.arange(len(h1))
            words = [raw[starts[i] : ends[i]] for i in first.tolist()]
            own = self.terms
            numbers = np.array([own.setdefault(w, len(own)) if known is None or w in known else -1 for w in words], np.int64)
            term = numbers[which]
            keys, tf = np.unique((term[term >= 0] << 32) | (doc[term >= 0] + len(self.ids)), return_counts=True)
            self.parts.append((keys >> 32, keys & 0xFFFFFFFF, tf))
        self.ids += part.column("doc_id").to_pylist()
        self.size += len(data)

    def rows(self) -> pa.RecordBatch:
        ids = np.array([i if i is not None else 0 for i in self.ids], np.int64)
        order = np.lexsort((ids, np.array([i is None for i in self.ids])))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lens = np.concatenate(self.lens)
        term, doc, tf = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else [np.zeros(0, np.int64)] * 3
        doc = place[doc]
        by_term = np.lexsort((doc, term))
        term, doc, tf = term[by_term], doc[by_term], tf[by_term]
        n = lens[order][doc]
        begin = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        bounds = np.append(begin, len(term))
        names = list(self.terms)
        k = len(begin)
        least = np.minimum.reduceat(n / tf, begin) if k else np.zeros(0)
        none = [None] * k
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.name] * (k + 1)),
                pa.array([names[i].decode() for i in term[begin].tolist()] + [None], pa.string()),
                pa.array([*np.diff(bounds).tolist(), None], pa.int64()),
                pa.array([*least.tolist(), None], pa.float64()),
                *[pa.concat_arrays([_packed(x.astype(np.int32), bounds), pa.array([None], pa.binary())]) for x in (doc, tf, n)],
                pa.array([*none, [self.ids[i] for i in order.tolist()]], pa.list_(pa.int64())),
                pa.array([*none, int((lens > 0).sum())], pa.int64()),
                pa.array([*none, int(lens.sum())], pa.int64()),
            ],
            [x.split()[0] for x in _POSTINGS.split(", ")],
        )


def _index(wanted) -> object:
    """Postings by chunk and term, and a row (term null) for each chunk's documents. ``wanted``: terms, or None for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashes = None
        if wanted is not None:
            words = [w.encode() for w in wanted.value]
            known = {w: 1 for w in words}
            ends = np.cumsum([len(w) for w in words], dtype=np.int64)
            data = np.frombuffer(b"".join(words), np.uint8)
            hashes = np.sort(H.word_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)) if words else np.zeros(0, H.U)
        chunk = _Chunk()
        for batch in batches:
            for part in slices(batch, "text"):
                for a in range(0, part.num_rows, CHUNK_DOCS):
                    piece = part.slice(a, CHUNK_DOCS)
                    if chunk.ids and (len(chunk.ids) + piece.num_rows > CHUNK_DOCS or chunk.size >= CHUNK_BYTES):
                        yield chunk.rows()
                        chunk = _Chunk()
                    chunk.add(piece, known, hashes)
        if chunk.ids:
            yield chunk.rows()

    return run


def _ints(column: pa.Array, kind=np.int32) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _owner(last: bool, top: int, n_docs: int, n_terms: int):
    """One stage for a chunk and a group of items: bundles and postings in, bundles (or at last the best rows) out."""

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.combine_chunks()
        is_doc = np.asarray(right.column("w").is_null())
        ids = right.filter(pa.array(is_doc)).column("ids").to_pylist()
        right = right.filter(pa.array(~is_doc))
        askers = right.column("askers").to_pylist()
        lists = {c: _ints(right.column(c)) for c in ("docs", "tfs", "lens")}
        names = np.unique(np.array([*left.column("item_id").to_pylist(), *[a["item_id"] for x in askers for a in x]], np.int64))
        bundles = _ints(left.column("docs")), _ints(left.column("scores"), np.int64)
        width = 1 + max([int(d.max()) for d in [*bundles[0], *lists["docs"]] if len(d)], default=0)
        scores = np.zeros((len(names), width), np.int64)
        rem = np.full(len(names), np.iinfo(np.int64).max, np.int64)
        at = np.searchsorted(names, np.array(left.column("item_id").to_pylist(), np.int64))
        for i, left_rem, docs, have in zip(at, left.column("rem").to_pylist(), *bundles):
            scores[i, docs] = have
            rem[i] = left_rem
        for w, who, docs, tf, n in zip(right.column("w").to_pylist(), askers, lists["docs"], lists["tfs"], lists["lens"]):
            m = 10 + (90 * n.astype(np.int64) * n_docs) // n_terms
            tf = tf.astype(np.int64)
            add = w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            rows = np.searchsorted(names, np.array([a["item_id"] for a in who], np.int64))
            scores[np.ix_(rows, docs)] += add
            rem[rows] = np.minimum(rem[rows], [a["rem"] for a in who])
        found = []
        for i in range(len(names)):
            docs = np.flatnonzero(scores[i])
            have = scores[i, docs]
            if len(docs) > top:
                line = int(np.partition(have, len(have) - top)[len(have) - top])
                keep = have >= (line if last else line - min(int(rem[i]), line))
                docs, have = docs[keep], have[keep]
            if last:
                best = np.lexsort((docs, -have))[:top]
                docs, have = docs[best], have[best]
            found.append((docs.astype(np.int32), have))
        sizes = [len(d) for d, _ in found]
        if last:
            docs = np.concatenate([d for d, _ in found]) if found else np.zeros(0, np.int32)
            return pa.table(
                {
                    "item_id": pa.array(np.repeat(names, sizes), pa.int64()),
                    "doc_id": pa.array([ids[0][d] for d in docs.tolist()], pa.int64()),
                    "score": pa.array(np.concatenate([s for _, s in found]) if found else [], pa.int64()),
                }
            )
        keep = [i for i, size in enumerate(sizes) if size]
        key = left if left.num_rows else right
        name, part = (key.column(c)[0].as_py() if key.num_rows else None for c in ("chunk", "part"))
        return pa.table(
            {
                "chunk": pa.array([name] * len(keep), pa.string()),
                "part": pa.array([part] * len(keep), pa.int32()),
                "item_id": pa.array(names[keep], pa.int64()),
                "rem": pa.array(rem[keep], pa.int64()),
                "docs": pa.array([found[i][0].tobytes() for i in keep], pa.binary()),
                "scores": pa.array([found[i][1].tobytes() for i in keep], pa.binary()),
            }
        )

    return visit


def search(docs: DataFrame, items: DataFrame, top: int = TOP, stages: int = STAGES, max_terms: int = MAX_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0."""
    spark = docs.sparkSession
    asked = stored(item_terms(items), "search-items")
    terms = asked.select("term").distinct()
    size = asked.agg(F.count_distinct("item_id").alias("items"), F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("b")).first()
    few = size.n <= max_terms and (size.b or 0) <= MAX_TERM_BYTES
    wanted = spark.sparkContext.broadcast([r.term for r in terms.collect()]) if few else None
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_index(wanted), _POSTINGS)
    postings = stored(rows, "search-postings")
    chunks = postings.where(F.col("term").isNull())
    total = chunks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = total.n or 0, max(1, total.l or 0)
    entries = postings.where(F.col("term").isNotNull())

    weight = F.floor(1000 * F.log((F.lit(2 * n_docs + 2) / (2 * F.col("df") + 1)).cast("double"))).cast("long")
    most = int(1000 * np.log((2 * n_docs + 2) / 3)) if n_docs else 0
    stats = entries.groupBy("term").agg(F.sum("df").alias("df"), F.min("least").alias("least")).select(
        "term",
        weight.alias("w"),
        # the greatest factor of the weight in any document: m is at least 9 + 90 * n * N / L
        (F.ceil(1e9 / (1000 + 720.0 * F.col("least") * n_docs / n_terms)) + 1).cast("long").alias("bound"),
    )
    owner = F.greatest(F.lit(0), F.least(F.lit(stages - 1), F.floor((most - F.col("w")) * stages / (most + 1)))).cast("int")
    later = Window.partitionBy("item_id").orderBy(F.desc("owner")).rangeBetween(Window.unboundedPreceding, -1)
    parts = -(-size.items // GROUP) if size.items else 1
    plan = (
        asked.join(stats, "term")
        .withColumn("owner", owner)
        .withColumn("rem", F.coalesce(F.sum(F.col("w") * F.col("bound")).over(later), F.lit(0)).cast("long"))
        .withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int"))
        .groupBy("owner", "term", "w", "part")
        .agg(F.collect_list(F.struct("item_id", "rem")).alias("askers"))
    )
    plan = stored(plan, "search-plan")

    columns = ["chunk", "part", "w", "docs", "tfs", "lens", "askers"]
    bundles = spark.createDataFrame([], _BUNDLE)
    for stage in range(stages):
        last = stage == stages - 1
        owned = plan.where(F.col("owner") == stage)
        right = entries.join(F.broadcast(owned) if size.n <= MAX_PLAN else owned, "term")
        right = right.select(*columns, F.lit(None).cast("array<bigint>").alias("ids"))
        if last:
            every = chunks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
            right = right.unionByName(every.select("chunk", "part", "ids"), allowMissingColumns=True)
        visited = bundles.groupBy("chunk", "part").cogroup(right.groupBy("chunk", "part"))
        schema = "item_id long, doc_id long, score long" if last else _BUNDLE
        bundles = visited.applyInArrow(_owner(last, top, n_docs, n_terms), schema)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = bundles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
