"""Text normalisation as column expressions.

Character classes are spelt out, because engines disagree on what ``\\b``, ``\\w`` and ``\\s`` mean
outside ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the result.
WORD = r"[\p{L}\p{N}_]"
# 31 ASCII marks. The backslash is not one of them: it stays in the text.
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\]^_`{|}~]+"""
UNIT_WORDS = ("g", "ml")
_OTHER_SPACES = r"\x09-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WHITESPACE = rf"[\x20{_OTHER_SPACES}]+"
# Runs other than one plain space: the same result when replaced by a space, with far fewer matches.
# The look-ahead turns printable ASCII away with one range test instead of the whole class.
ODD_WHITESPACE = rf"(?![!-~])(?:[{_OTHER_SPACES}][\x20{_OTHER_SPACES}]*|\x20(?![!-~])[\x20{_OTHER_SPACES}]+)"
LEADING_BULLETS = "^[•●·–—]+"
ACCENTED = "[^à-ỹ]+"
ASCII_LETTERS = "[^a-z]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: Column | str) -> Column:
    """Lowercase, strip marks and unit words, collapse whitespace, strip leading bullets."""
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    t = F.regexp_replace(t, PUNCTUATION, "")
    units = "|".join(UNIT_WORDS)
    firsts = "".join(u[0] for u in UNIT_WORDS)
    # The first letter is tested before the costlier look-behind.
    t = F.regexp_replace(t, f"(?=[{firsts}])(?<!{WORD})(?:{units})(?!{WORD})", "")
    t = F.trim(F.regexp_replace(t, ODD_WHITESPACE, " "))
    return F.regexp_replace(t, LEADING_BULLETS, "")


def is_english(text: Column | str) -> Column:
    """More ASCII letters than characters in the accented range; false on empty text."""
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    ascii_letters = F.length(F.regexp_replace(t, ASCII_LETTERS, ""))
    accented = F.length(F.regexp_replace(t, ACCENTED, ""))
    return ascii_letters > accented


def split_words(text: Column | str) -> Column:
    """Whitespace tokens of any text."""
    t = F.regexp_replace(F.coalesce(_col(text), F.lit("")), ODD_WHITESPACE, " ")
    return F.array_remove(F.split(t, " "), "")


def tokens_ws(normalised: Column | str) -> Column:
    """Whitespace tokens of text whose whitespace is already single spaces."""
    return F.array_remove(F.split(F.coalesce(_col(normalised), F.lit("")), " "), "")


def tokens_word(text: Column | str) -> Column:
    """Runs of two or more word characters, lowercased."""
    t = F.lower(F.coalesce(_col(text), F.lit("")))
    return F.regexp_extract_all(t, F.lit("(" + WORD + "{2,})"), F.lit(1))


def tokens_field(**fields: Column | str) -> Column:
    """One ``field=value`` token per categorical field; nulls give no token."""
    parts = [F.concat(F.lit(f"{name}="), _col(c).cast("string")) for name, c in fields.items()]
    return F.array_compact(F.array(*parts))


def combine_fields(*fields: Column | str) -> Column:
    """Text fields joined by one space; nulls are skipped."""
    return F.concat_ws(" ", *[_col(f) for f in fields])


def is_blank(text: Column | str) -> Column:
    t = F.regexp_replace(F.coalesce(_col(text), F.lit("")), WHITESPACE, "")
    return t == ""
