"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from profilematch.llm import bpe, chat, decontaminate, lexical_search, near_dedup, quality_model, quality_rules, samples
from profilematch.llm import secrets, spelling, substring_dedup, suffix_dedup, toxicity, warc
from profilematch.llm.common import read_table
from profilematch.session import spread


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The whole table, on all cores when it lies in one small file."""
    return spread(read_table(spark, sf, "documents"), "doc_id")


def near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.classes(documents(spark, sf).select("doc_id", "text")).select("doc_id", "class_id", "class_size")


TOKENIZER = "word_bpe_49k.json"


def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    out = secrets.scan(documents(spark, sf).select("doc_id", "text"))
    count = lambda kind: F.size(secrets.of_kinds(F.col("spans"), kind)).cast("long").alias(f"n_{kind}")
    base = secrets.spans_text(secrets.of_kinds(F.col("spans"), *secrets.BASE_KINDS))
    return out.select(
        "doc_id",
        *[count(kind) for kind in secrets.BASE_KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def bpe_encoding(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    out = bpe.encode(documents(spark, sf).select("doc_id", "text"), public_tokenizers.path(TOKENIZER))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    out = decontaminate.find_matches(docs, read_table(spark, sf, "benchmark"))
    return out.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.transform("matches", lambda m: m["item_id"]).alias("item_ids"),
        F.array_max(F.transform("matches", lambda m: m["n_tokens"])).alias("longest_overlap"),
    )


def substrings(spark: SparkSession, sf: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(documents(spark, sf).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def repeated_bytes(spark: SparkSession, sf: str) -> DataFrame:
    out = suffix_dedup.dedup_bytes(documents(spark, sf).select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _scores(spark: SparkSession, sf: str, operator, parts: int, held_out: int) -> DataFrame:
    docs, labels = documents(spark, sf).select("doc_id", "text"), read_table(spark, sf, "labels")
    model = operator.fit(docs, labels, samples.fold(parts) != held_out)
    held = F.coalesce(samples.fold(parts) == held_out, F.lit(False)).alias("held_out")
    return operator.score(docs, model).select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxic_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf, toxicity, 5, 0)


def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf, quality_model, 3, 1)


def chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    turns = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], turns.schema)
    out = chat.format_chats(turns.unionByName(added))
    lines = F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under = chat.loss_text(F.col("segments"))
    return (
        out.select("conv_id", "formatted", "valid", lines.alias("lines"), under.alias("under"))
        .select(
            "conv_id",
            F.size("lines").cast("long").alias("n_turns"),
            F.sha2(F.array_join("lines", ""), 256).alias("turns_sha256"),
            F.length("under").cast("long").alias("loss_chars"),
            F.sha2("under", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )


def quality(spark: SparkSession, sf: str) -> DataFrame:
    out = quality_rules.judge(documents(spark, sf))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *columns, "base_failed", "kept")


def ranked_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return lexical_search.search(docs, read_table(spark, sf, "benchmark"))


def spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(documents(spark, sf).select("doc_id", "text"))


def archived_pages(spark: SparkSession, sf: str) -> DataFrame:
    catalogue = warc.write_archives(spread(read_table(spark, sf, "pages"), "page_id"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.read_archives(catalogue).select(*columns)


QUERIES = {
    "op1_near_dedup": near_duplicates,
    "op2_secret_scan": secret_scan,
    "op3_bpe_encoding": bpe_encoding,
    "op4_substring_dedup": substrings,
    "op5_toxicity": toxic_scores,
    "op6_suffix_dedup": repeated_bytes,
    "op7_chat_formatting": chat_formatting,
    "op8_quality_rules": quality,
    "op9_quality_classifier": quality_scores,
    "op10_decontamination": decontamination,
    "op11_lexical_search": ranked_documents,
    "op12_spelling_variants": spelling_variants,
    "op13_warc": archived_pages,
    "pipeline": corpus_pipeline.run,
}
