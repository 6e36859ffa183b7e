"""Dictionary files: term maps (term TAB replacement) and word lists (one term per line).

Each dictionary is read from the first path that exists, else from a default table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilematch.functions.text import WHITESPACE
from profilematch.operators.lookup import Dictionaries
from profilematch.sources.artefacts import exists

# The dictionaries used when no file is found.
DEFAULT_SLANG = {
    "ko": "không", "k": "không", "dc": "được", "vs": "với",
    "tks": "thanks", "ty": "thank you", "ok": "okay", "oke": "okay",
    "bt": "bình thường", "nc": "nói chuyện", "kb": "kết bạn",
}
DEFAULT_STOP = [
    "và", "của", "có", "là", "được", "trong", "với", "để", "cho", "từ",
    "một", "các", "này", "đó", "những", "nhiều", "rất", "cũng", "sẽ",
    "đã", "đang", "về", "theo", "như", "khi", "nếu", "vì", "do", "bởi",
]
DEFAULT_WRONG = ["zzz", "xxx", "aaa", "bbb", "ccc"]
DEFAULT_ENGLISH = {
    "hello": "xin chào", "world": "thế giới", "example": "ví dụ", "test": "kiểm tra",
}


def term_map(spark: SparkSession, pairs: dict[str, str]) -> DataFrame:
    """A map given in code; Arrow input becomes a relation inside the plan."""
    columns = {"term": pa.array(pairs.keys(), pa.string()), "replacement": pa.array(pairs.values(), pa.string())}
    return spark.createDataFrame(pa.table(columns))


def word_list(spark: SparkSession, words: list[str]) -> DataFrame:
    return spark.createDataFrame(pa.table({"term": pa.array(dict.fromkeys(words), pa.string())}))


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    return next((path for path in paths if exists(spark, path)), None)


def _strip(line: Column) -> Column:
    edge = f"^{WHITESPACE}|{WHITESPACE}$"
    return F.regexp_replace(line, edge, "")


def read_term_map(spark: SparkSession, path: str, strip: bool = False) -> DataFrame:
    """(term, replacement). Split at the first tab; lines without one are skipped; the last line of a
    term wins. Lines are ordered by where they lie in the file, so a long file is read in parallel."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")
    )
    value = _strip(F.col("value")) if strip else F.col("value")
    parts = F.split(value, "\t", 2)
    pairs = lines.where(F.contains(value, F.lit("\t"))).select(
        parts[0].alias("term"), parts[1].alias("replacement"), F.struct("start", "line").alias("at")
    )
    return pairs.groupBy("term").agg(F.max_by("replacement", "at").alias("replacement"))


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("term")).distinct()


def load_term_map(
    spark: SparkSession, paths: list[str], default: DataFrame | None = None, strip: bool = False
) -> DataFrame:
    path = first_existing(spark, paths)
    if path is not None:
        return read_term_map(spark, path, strip)
    return default if default is not None else term_map(spark, {})


def load_word_list(spark: SparkSession, paths: list[str], default: DataFrame | None = None) -> DataFrame:
    path = first_existing(spark, paths)
    if path is not None:
        return read_word_list(spark, path)
    return default if default is not None else word_list(spark, [])


def load_dictionaries(
    spark: SparkSession,
    english: list[str] = (),
    slang: list[str] = (),
    wrong: list[str] = (),
    stop: list[str] = (),
) -> Dictionaries:
    """The four dictionaries, each from its first existing path or from its default."""
    return Dictionaries(
        english=load_term_map(spark, english, term_map(spark, DEFAULT_ENGLISH), strip=True),
        slang=load_term_map(spark, slang, term_map(spark, DEFAULT_SLANG)),
        wrong=load_word_list(spark, wrong, word_list(spark, DEFAULT_WRONG)),
        stop=load_word_list(spark, stop, word_list(spark, DEFAULT_STOP)),
    )
