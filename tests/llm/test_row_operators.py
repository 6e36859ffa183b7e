"""Secrets, tokens, chats and quality counts against plain restatements."""

from __future__ import annotations

import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from profilematch.llm import bpe, chat, quality_rules, secrets
from tests.llm.fixtures import SCHEMA, matching, rows, table

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    keyword = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = rf"""({keyword})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


PIECES = ["password", "PassWd", "secret", "tOken", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA", "AKIAAKIA", "0123456789abcdef", "Z9" * 8, "é", "ſecret", "toKen", "abc", "\n", "=abcdefghijkl"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_secrets_equal_a_plain_search(text):
    found = [s for s in secrets.find_spans(text, secrets._automaton()) if s[1] < 3]
    assert found == plain_spans(text)


def test_checksums():
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good = "ghp_" + body + secrets.base62(zlib.crc32(body.encode()), 6)
    automaton = secrets._automaton()
    assert (2, secrets.KINDS.index("github"), 2 + len(good)) in secrets.find_spans("x " + good + " y", automaton)
    assert not [s for s in secrets.find_spans("x " + good[:-1] + "- y", automaton) if s[1] > 2]
    assert not [s for s in secrets.find_spans(good[:-1] + ("0" if good[-1] != "0" else "1"), automaton) if s[1] > 2]


def test_scan_and_redact(spark):
    data = [*rows(), (7, "é token = abcdefghijklmnop end", "en", "s", 30)]
    out = secrets.scan(table(spark, data, extra=True)).select("text", secrets.spans_text(F.col("spans")).alias("s")).collect()
    for r in out:
        assert r.s == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(r.text or ""))
    hidden = secrets.redact(table(spark, data))
    assert hidden.columns == table(spark, data).columns and hidden.count() == len(data)
    assert hidden.where("doc_id = 7 and text like '%end'").first()[:2] == (7, "é <assign> end")
    assert secrets.scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_bpe_equals_the_tokenizer(spark):
    whole = bpe.tokenizer(PATH)
    odd = ["a<|endoftext|>b <|startoftext|>", "it's WE'LL İI ΣΑΣ", "é ́x", "a b　c", "\x0b\x0c\r\n", "0123456789 " * 300]
    data = [*rows(), *[(200 + i, t, None, None, None) for i, t in enumerate(odd)]]
    data += [(300 + i, data[24][1][i * 50 :], None, None, None) for i in range(6)]
    out = bpe.encode(table(spark, data, extra=True), PATH).select("text", "ids", "decoded").collect()
    assert len(out) == len(data)
    for r in out:
        ids = whole.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == ids
        assert r.decoded == (whole.decode(ids, skip_special_tokens=False) if ids else "")
    assert bpe.encode(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_shared_chunks_are_used(spark):
    assert bpe.shared_chunks(table(spark)).count() > 0


CHATS = [
    (1, 0, "system", "be [kind]"), (1, 1, "user", "~1 <s>"), (1, 2, "assistant", "[/INST]~"),
    (2, 0, "user", "no answer"), (3, 1, "user", "b"), (3, 0, "assistant", "a"), (None, None, None, None),
    (None, 1, "us[er]", "x"), (4, 0, "user", "same"), (4, 0, "user", "same"), (5, 0, "user", ""), (5, 1, "assistant", None),
    (6, 0, "user", "long " * 20000), (6, 1, "assistant", "ok"),
]


def test_chats_read_back(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("x"))
    out = chat.format_chats(df).select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    got = {r.conv_id: r for r in out.collect()}
    for conv in {c for c, *_ in CHATS}:
        order = sorted((t for t in CHATS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        r = got[conv]
        assert [(t.role, t.text) for t in r.turns] == [(t[2] or "", t[3] or "") for t in order]
        assert r.loss == "".join(t[3] or "" for t in order if t[2] == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
    assert {c for c, r in got.items() if r.valid} == {1, 5, 6}
    assert chat.format_chats(df.limit(0)).collect() == []


def plain_counts(text: str | None) -> tuple:
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(w) < 1000 else None
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), again)


def test_quality_counts(spark):
    out = quality_rules.with_counts(table(spark, extra=True)).select("text", f"{quality_rules._COLUMN}.*").collect()
    assert len(out) == len(rows())
    for r in out:
        *plain, again = plain_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == tuple(plain)
        assert again is None or r.n_repeat_words == len(again)


def test_quality_counts_replace_a_column(spark):
    docs = spark.createDataFrame([(1, "a b b", "x")], "doc_id long, text string, COUNTS string")
    out = quality_rules.with_counts(docs, name="counts")
    assert out.columns == ["doc_id", "text", "counts"] and out.select("counts.n_words").first()[0] == 3
    assert quality_rules.with_counts(docs).columns == [*docs.columns, quality_rules._COLUMN]


def test_quality_keeps_rows_and_columns(spark):
    docs = table(spark, extra=True)
    kept = quality_rules.quality_filter(docs, min_documents=5)
    judged = quality_rules.judge(docs, min_documents=5)
    assert kept.columns == docs.columns and judged.count() == docs.count()
    assert kept.count() == judged.where("kept").count() > 10
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if repr(r) in set(map(repr, kept.collect())))
    assert quality_rules.judge(docs.limit(0)).collect() == [] and quality_rules.quality_filter(docs.limit(0)).collect() == []


def test_fences_follow_their_group(spark):
    """Twenty documents of a source have many symbols: there this is normal, elsewhere it is an outlier."""
    from tests.llm.fixtures import random, words

    r = random.Random(1)
    data = [(i, " ".join(words(r, 80)), "en", "plain", 0) for i in range(60)]
    data += [(100 + i, " ".join(w + " #" for w in words(r, 60)), "en", "code", 0) for i in range(20)]
    data += [(999, " ".join(w + " #" for w in words(r, 60)), "en", "plain", 0)]
    out = {r.doc_id: r.kept for r in quality_rules.judge(table(spark, data), min_documents=10).collect()}
    assert not out[999] and all(kept for i, kept in out.items() if i != 999)


def test_few_units_are_no_evidence(spark):
    """Where nobody has symbols, three of them reject no document and four do, whatever other metrics say."""
    from tests.llm.fixtures import random, words

    r = random.Random(2)
    data = [(i, " ".join(words(r, 80)), "en", "plain", 0) for i in range(60)]
    data += [(100 + n, " ".join(words(r, 80)) + " #" * n, "en", "plain", 0) for n in (3, 4)]
    out = {r.doc_id: r.kept for r in quality_rules.judge(table(spark, data), min_documents=10).collect()}
    assert out[103] and not out[104]
