"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARES = 1_000_000


def fold(parts: int):
    """crc32 of doc_id as text, modulo ``parts``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train, per_class: int, max_bytes: int) -> DataFrame:
    """(label, text): about ``per_class`` documents of each label among rows that ``train`` allows, chosen by a hash.

    The chosen ids (2 * per_class in expectation) are broadcast to the documents, so no text is shuffled but theirs.
    If their texts exceed ``max_bytes``, the sample shrinks by that factor. A doc_id counts once.
    """
    rows = labels.where(train & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    rows = rows.groupBy("doc_id").agg(F.max(label).alias("label"))
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(77)), F.lit(SHARES))
    share = lambda by: F.when(F.col("label") == 1, by(1)).otherwise(by(0))
    wanted = lambda scale: rows.where(place < share(lambda c: F.lit(int(SHARES * min(1, scale * per_class / max(1, counts.get(c, 0)))))))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    found = lambda scale: texts.join(F.broadcast(wanted(scale)), "doc_id")
    size = found(1).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chosen = found(min(1, max_bytes / max(1, size)))
    return chosen.groupBy("doc_id").agg(F.first("label").alias("label"), F.min("text").alias("text")).select("label", "text")
