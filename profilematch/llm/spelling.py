"""Spelling variants: blocked Gram matrices of letter counts find words one edit apart.

One inserted or deleted character changes the vector of a word's letter counts by a squared distance of 1, one replaced
character by 2. Letters fall into CLASSES classes; a word's block is its class counts (their sum is its length), so
words one edit apart lie in one block or in two whose counts differ in one class by 1 (next length) or in two classes
by 1 (same length). Each such pair of blocks meets once, in tiles of bounded size: a NumPy product of the count
matrices gives all squared distances, pairs of at most 2 are checked letter by letter.

A word is a maximal run of letters, A-Z lower-cased; if ``every`` divides the crc32 of "doc_id:run", one of its
characters is deleted, as the corpus has it. Null texts have no words, a null doc_id counts as an empty one. Repeated rows
count again. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilematch.llm.common import stored
from profilematch.operators.skew import MAX_BROADCAST_ROWS, expand_join
from profilematch.session import fits

LEAST_LENGTH, LEAST_COUNT, EVERY, TIMES = 7, 2, 31, 10
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]]
CLASSES = 5
#: Words of a tile, on average, and tiles of one block that visit a tile together.
TILE, TOGETHER = 1024, 8
#: Entries of a Gram matrix, and pairs checked at a time.
GRAM, CHECKED = 4 << 20, 1 << 17


def words(docs: DataFrame, every: int = EVERY, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least ``length`` characters with at least ``count`` occurrences."""
    lowered = F.translate("text", UPPER, UPPER.lower())
    pattern = f"[a-z\\u00C0-\\u00FF]{{{length},}}"
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))).alias("run"),
    )
    drawn = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word")
    counted = drawn.select(word).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= count) & (F.length("word") >= length))


def _classes() -> list[str]:
    return ["".join(LETTERS[c::CLASSES]) for c in range(CLASSES)]


def _meetings() -> list[list[int]]:
    """Differences of the class counts of blocks that meet, one of each two opposite ones."""
    unit = np.eye(CLASSES, dtype=int)
    longer = [unit[c] for c in range(CLASSES)]
    same = [unit[c] - unit[d] for c in range(CLASSES) for d in range(c)]
    return [x.tolist() for x in [np.zeros(CLASSES, int), *longer, *same]]


def _matrix(packed: str, size: int) -> np.ndarray:
    return np.frombuffer(packed.encode("latin-1"), np.uint8).reshape(-1, size)


def _counts(codes: np.ndarray) -> np.ndarray:
    n = len(codes)
    flat = np.bincount((np.arange(n)[:, None] * 256 + codes).ravel(), minlength=256 * n)
    return flat.reshape(n, 256)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` are one edit apart; b's words are as long or one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    ahead = a != b[:, :-1]
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), a.shape[1])
    behind = a != b[:, 1:]
    return ~(behind & (np.arange(a.shape[1])[None, :] >= first[:, None])).any(axis=1)


def _near(a: np.ndarray, b: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of a, of b) one edit apart. The first ``own`` rows of b are those of a: each of their pairs counts once."""
    none = np.zeros(0, np.int64)
    if not len(a) or not len(b):
        return none, none
    ca, cb = _counts(a), _counts(b)
    used = np.flatnonzero(ca.any(axis=0))
    sa, sb = (ca * ca).sum(axis=1), (cb * cb).sum(axis=1)
    exact = np.float32 if max(sa.max(), sb.max()) < 1 << 21 else np.float64
    left = np.hstack([2 * ca[:, used], -sa[:, None], np.ones((len(a), 1))]).astype(exact)
    right = np.hstack([cb[:, used], np.ones((len(b), 1)), -sb[:, None]]).astype(exact)
    rows, columns = [none], [none]
    step = max(1, GRAM // len(b))
    for lo in range(0, len(a), step):
        close = left[lo : lo + step] @ right.T >= -2  # minus the squared distances
        i, j = np.divmod(np.flatnonzero(close), len(b))
        i += lo
        keep = (j >= own) | (j > i)
        i, j = i[keep], j[keep]
        at_once = max(1, CHECKED * 16 // a.shape[1])
        for k in range(0, len(i), at_once):
            x, y = i[k : k + at_once], j[k : k + at_once]
            ok = _one_edit(a[x], b[y])
            rows.append(x[ok])
            columns.append(y[ok])
    return np.concatenate(rows), np.concatenate(columns)


_PAIRS = "word string, near string, n long"


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for home, visitors in zip(batch.column("home").to_pylist(), batch.column("visitors").to_pylist()):
            size = home["size"]
            a = _matrix(home["packed"], size)
            for length in (size, size + 1):
                met = sorted((v for v in visitors if v["size"] == length), key=lambda v: not v["own"])
                if not met:
                    continue
                text = "".join(v["packed"] for v in met)
                i, j = _near(a, _matrix(text, length), len(a) if met[0]["own"] else 0)
                if not len(i):
                    continue
                own_n = np.array(home["ns"].split(","), np.int64)[i]
                their_n = np.array(",".join(v["ns"] for v in met).split(","), np.int64)[j]
                first = [home["packed"][k * size : (k + 1) * size] for k in i.tolist()]
                second = [text[k * length : (k + 1) * length] for k in j.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first + second), pa.array(second + first), pa.array(np.concatenate([their_n, own_n]))],
                    ["word", "near", "n"],
                )


def near_pairs(found: DataFrame) -> DataFrame:
    """(word, near, n of near): all pairs of words one edit apart, in both directions. ``found``: (word, n), stored."""
    counts = [F.length(F.regexp_replace("word", f"[^{letters}]", "")) for letters in _classes()]
    keyed = found.select("word", "n", F.array(*counts).alias("key"))
    sizes = stored(keyed.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")), "spelling-blocks")
    placed = expand_join(keyed, sizes, "key", "word", fits(sizes, MAX_BROADCAST_ROWS))
    text = lambda field: F.transform("ws", lambda w: w[field].cast("string"))
    tiles = (
        placed.select("key", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int").alias("tile"), F.struct("word", "n").alias("w"))
        .groupBy("key", "tile")
        .agg(F.collect_list("w").alias("ws"))
        .select(
            "key",
            "tile",
            F.length(F.col("ws")[0]["word"]).alias("size"),
            F.array_join(text("word"), "").alias("packed"),
            F.array_join(text("n"), ",").alias("ns"),
        )
    )
    tiles = stored(tiles, "spelling-tiles")
    steps = F.explode(F.array(*[F.array(*map(F.lit, step)) for step in _meetings()])).alias("step")
    cells = sizes.select("key", "tiles", steps).withColumn("v_key", F.zip_with("key", "step", lambda a, b: a + b))
    cells = cells.join(sizes.select(F.col("key").alias("v_key"), F.col("tiles").alias("v_tiles")), "v_key")
    inside = F.forall("step", lambda x: x == 0)
    cells = cells.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    from_tile = F.when(inside, F.col("tile")).otherwise(F.lit(0))
    # of two blocks of many tiles every tile meets every other one; a block meets itself above the diagonal
    cells = cells.where(from_tile < F.col("v_tiles")).withColumn("v_tile", F.explode(F.sequence(from_tile, F.col("v_tiles") - 1)))
    own = (inside & (F.col("tile") == F.col("v_tile"))).alias("own")
    cells = cells.select("key", "tile", "v_key", "v_tile", own)
    visitor = tiles.select(F.col("key").alias("v_key"), F.col("tile").alias("v_tile"), "size", "packed", "ns")
    met = cells.join(visitor, ["v_key", "v_tile"]).groupBy("key", "tile", F.floor(F.col("v_tile") / TOGETHER).alias("batch"))
    met = met.agg(F.collect_list(F.struct("size", "packed", "ns", "own")).alias("visitors"))
    homes = tiles.select("key", "tile", F.struct("size", "packed", "ns").alias("home"))
    return homes.join(met, ["key", "tile"]).select("home", "visitors").mapInArrow(_gram, _PAIRS)


def variants(docs: DataFrame, every: int = EVERY, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word, its near word of largest n, and the end of that chain."""
    found = stored(words(docs, every), "spelling-words")
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near")))
    near = near_pairs(found).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= times * F.col("n")
    all_words = found.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    all_words = stored(all_words, "spelling-forms")
    # a form has ``times`` times the occurrences: chains are short, and each round doubles what a link spans
    most = all_words.agg(F.max("n")).first()[0] or 1
    links = all_words.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(max(1.0, log10(most) / log10(times)))) if times > 1 else 0):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stored(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    out = all_words.join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
