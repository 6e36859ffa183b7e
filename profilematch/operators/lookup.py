"""Dictionary lookups over text columns.

The five steps (translate, slang, wrong words, stop words, all after cleaning) act on one token at a
time, apart from the language gate. So they are composed once, on the small side, into one table
``term -> (en, other)``: the final words for a token in English text and in other text. A token that
is in no dictionary stays as it is.

A composed table of bounded size goes into the plan as a constant hash table (an array of slots), so
a text column is normalised inside its own row: no explode, no shuffle. A larger one is joined token
by token with a salt, since a frequent word can be a large share of all tokens.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from profilematch.functions.text import clean_text, is_english, split_words, tokens_ws
from profilematch.session import fits, materialize

MAX_CONSTANT_TERMS = 50_000
JOIN_SALTS = 32

_SLOTS = "array<array<struct<term:string,en:string,other:string>>>"


@dataclass(frozen=True)
class Dictionaries:
    """``english`` and ``slang`` have (term, replacement); ``wrong`` and ``stop`` have (term)."""

    english: DataFrame
    slang: DataFrame
    wrong: DataFrame
    stop: DataFrame
    _lookups: dict = field(default_factory=dict, repr=False, compare=False)

    def lookup(self, max_terms: int = MAX_CONSTANT_TERMS) -> ConstantLookup | None:
        """The composed dictionary as a constant, built once; None when it is too large for that."""
        if max_terms not in self._lookups:
            tables = (self.english, self.slang, self.wrong, self.stop)
            small = all(fits(t, max_terms) for t in tables)
            # In one partition, the few rows are composed without any shuffle.
            one = Dictionaries(*(t.coalesce(1) for t in tables)) if small else self
            self._lookups[max_terms] = ConstantLookup.of(compose(one), max_terms) if small else None
        return self._lookups[max_terms]


def compose(d: Dictionaries) -> DataFrame:
    """(term, en, other): the final words of every known term, empty when it is removed."""
    terms = (
        d.english.select("term")
        .union(d.slang.select("term"))
        .union(d.wrong.select("term"))
        .union(d.stop.select("term"))
        .where(F.size(split_words("term")) == 1)
        .distinct()
    )
    # Both languages take the same steps; only English text is translated first.
    words = terms.select("term", F.explode(F.array(F.lit(True), F.lit(False))).alias("translate"))
    english = d.english.select("term", F.col("replacement").alias("translated")).dropDuplicates(["term"])
    words = words.join(english, "term", "left")
    translated = F.when(F.col("translate"), F.coalesce("translated", "term")).otherwise(F.col("term"))
    words = words.select("term", "translate", F.posexplode(split_words(translated)).alias("p", "word"))
    slang = d.slang.select(F.col("term").alias("word"), "replacement").dropDuplicates(["word"])
    expanded = split_words(F.coalesce("replacement", "word"))
    words = words.join(slang, "word", "left").select("term", "translate", "p", F.posexplode(expanded).alias("q", "word"))
    dropped = d.wrong.select("term").union(d.stop.select("term")).distinct()
    dropped = dropped.select(F.col("term").alias("word"), F.lit(True).alias("dropped"))

    def final(english: bool) -> Column:
        kept = F.when(F.col("dropped").isNull() & (F.col("translate") == english), F.struct("p", "q", "word"))
        return F.array_join(F.sort_array(F.collect_list(kept))["word"], " ")

    words = words.join(dropped, "word", "left")
    return words.groupBy("term").agg(final(True).alias("en"), final(False).alias("other"))


class ConstantLookup:
    """A composed dictionary of checked size as a constant inside the plan."""

    def __init__(self, rows: list[Row]):
        self.n_slots = 16
        while self.n_slots < 2 * len(rows):
            self.n_slots *= 2
        slots: list[list[dict]] = [[] for _ in range(self.n_slots)]
        for row in rows:
            slots[row["hash"] % self.n_slots].append({"term": row["term"], "en": row["en"], "other": row["other"]})
        # Parsed once, by constant folding.
        self._slots = F.from_json(F.lit(json.dumps(slots, ensure_ascii=False)), _SLOTS)

    @staticmethod
    def of(composed: DataFrame, max_terms: int) -> ConstantLookup | None:
        """None when there are more terms; no more than ``max_terms`` + 1 rows are fetched."""
        hashed = composed.select("term", "en", "other", F.hash("term").alias("hash"))
        rows = hashed.limit(max_terms + 1).collect()
        return ConstantLookup(rows) if len(rows) <= max_terms else None

    def words(self, tokens: Column, english: Column) -> Column:
        def replaced(field: str) -> Column:
            def replace(token: Column) -> Column:
                slot = F.get(self._slots, F.pmod(F.hash(token), F.lit(self.n_slots)))
                hit = F.get(F.filter(slot, lambda e: e["term"] == token), F.lit(0))
                return F.coalesce(hit[field], token)

            return F.transform(tokens, replace)

        # The language is tested outside the lambda: inside, it would run once per token.
        return F.array_remove(F.when(english, replaced("en")).otherwise(replaced("other")), "")


def normalize_text(
    df: DataFrame,
    id_col: str,
    text_col: str,
    dictionaries: Dictionaries,
    out_col: str = "normalized",
    max_constant_terms: int = MAX_CONSTANT_TERMS,
) -> DataFrame:
    """``df`` plus the normalised text, row by row: ids may repeat or be null."""
    lookup = dictionaries.lookup(max_constant_terms)
    if lookup is not None:
        # The cleaned text is used twice; the extra projection keeps one copy of it.
        cleaned = df.withColumn("_clean", clean_text(text_col))
        words = lookup.words(tokens_ws("_clean"), is_english("_clean"))
        return cleaned.withColumn(out_col, F.array_join(words, " ")).drop("_clean")
    return _normalize_by_join(df, text_col, compose(dictionaries), out_col)


def _normalize_by_join(df: DataFrame, text_col: str, composed: DataFrame, out_col: str) -> DataFrame:
    # Numbered and cleaned once and stored: both readers see the same numbers, and the language is tested
    # once per text (behind the explode, it would be tested once per token).
    cleaned = df.withColumn("_id", F.monotonically_increasing_id()).withColumn("_clean", clean_text(text_col))
    keyed = materialize(cleaned.withColumn("_english", is_english("_clean")), "numbered")
    tokens = keyed.select(
        "_id", "_english", F.posexplode_outer(tokens_ws("_clean")).alias("_pos", "term")
    ).withColumn("_salt", F.pmod(F.xxhash64("_id", "_pos"), F.lit(JOIN_SALTS)).cast("int"))
    salted = composed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
    out = F.when(F.col("_english"), F.col("en")).otherwise(F.col("other"))
    rebuilt = (
        tokens.join(salted, ["term", "_salt"], "left")
        .select("_id", "_pos", F.coalesce(out, "term").alias("_word"))
        # One group is the words of one text, which already fitted in one row.
        .groupBy("_id")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "_word")))["_word"].alias("_words"))
        .select("_id", F.array_join(F.array_remove("_words", ""), " ").alias(out_col))
    )
    return keyed.join(rebuilt, "_id").select(*df.columns, out_col)


def replace_emoji(text: Column, emoji: DataFrame, max_emoji: int = MAX_CONSTANT_TERMS) -> Column:
    """Put ' word ' for each emoji of a (term, replacement) map. Opt-in; run it before cleaning.

    One alternation, longest first, cuts the text at the emoji; the pieces are then looked up.
    """
    if not fits(emoji, max_emoji):
        raise ValueError(f"emoji map has more than {max_emoji} entries")
    if emoji.isEmpty():
        return text
    word = F.concat(F.lit(" "), "replacement", F.lit(" "))
    lookup = ConstantLookup.of(emoji.select("term", word.alias("en"), word.alias("other")), max_emoji)
    longest_first = emoji.orderBy(F.length("term").desc(), "term").select("term").collect()
    pattern = "(" + "|".join(re.escape(row["term"]) for row in longest_first) + ")"
    pieces = F.split(F.regexp_replace(text, pattern, "\x01$1\x01"), "\x01")
    return F.array_join(lookup.words(pieces, F.lit(True)), "")
