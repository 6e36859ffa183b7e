"""Secret scan: a keyword automaton first, anchored expressions only where a keyword lies, checksums last.

Each text is read once by an Aho-Corasick automaton over all keywords (ASCII letters in lower case). An expression is
tried only at a keyword's place, in order of places, going on after the end of each match: the leftmost matches that
don't overlap, as a search over the whole text would find. ``hex`` has no keyword and is a plain search for long runs.
Kinds with a checksum (access tokens that end in a CRC-32 of 30 characters, in base 62) count only if it is right.

Null and empty texts have no spans. Positions are code points, the end is exclusive. Each row is scanned by itself, so
repeated rows, null ids and extra columns change nothing; columns named like new ones are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilematch.llm.common import slices

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
#: The forms of secrets.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(n: int, width: int) -> str:
    digits = ""
    while n:
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits.rjust(width, "0")


def _checksum(m: re.Match) -> bool:
    return base62(zlib.crc32(m[1].encode()), 6) == m[2]


#: kind: (keywords in lower case, expression, whether a match counts)
RULES = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), ASSIGN, lambda m: len(m[2]) >= 12),
    "access": (("akia",), ACCESS, lambda m: len(m[0]) >= 18),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), GITHUB, _checksum),
    "npm": (("npm_",), NPM, _checksum),
}


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, (keywords, _, _) in RULES.items():
        for word in keywords:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of each secret, in order."""
    spans = [(m.start(), KINDS.index("hex"), m.end()) for m in HEX.finditer(text)]
    low = text.encode().lower().decode()  # ASCII letters only: no position moves
    hits = sorted((end - size + 1, kind) for end, (kind, size) in automaton.iter(low))
    after = dict.fromkeys(RULES, 0)
    for start, kind in hits:
        if start < after[kind]:
            continue
        _, form, counts = RULES[kind]
        m = form.match(text, start)
        if m:
            after[kind] = m.end()
            if counts(m):
                spans.append((start, KINDS.index(kind), m.end()))
    return sorted(spans)


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end)."""
    docs = docs.drop("spans")
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find_spans(text, automaton)] if text else []
                    for text in part.column("text").to_pylist()
                ]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, kind)], [*columns, "spans"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("spans", T.ArrayType(SPAN))]))


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each secret replaced by its kind in angle brackets, and ``n_chars`` (if there) counted anew.

    Overlapping spans are one, named after the first. All other columns and rows stay.
    """
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [redacted(t, find_spans(t, automaton)) if t else t for t in part.column("text").to_pylist()]
                new = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([new if c == "text" else part.column(c) for c in columns], columns)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, done, at = [], 0, 0
    while at < len(spans):
        start, kind, end = spans[at]
        at += 1
        while at < len(spans) and spans[at][0] < end:
            end = max(end, spans[at][2])
            at += 1
        out += [text[done:start], f"<{KINDS[kind]}>"]
        done = end
    return "".join([*out, text[done:]])
