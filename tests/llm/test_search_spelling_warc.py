"""Lexical search, spelling variants and WARC archives against plain restatements and round trips."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from profilematch.llm import lexical_search, spelling, warc
from tests.llm.fixtures import SCHEMA, matching, prose, rows, table

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top=10):
    lists = [(i, Counter(terms(t))) for i, t, *_ in docs]
    lists = [(i, c) for i, c in lists if c]
    n_docs, total = len(lists), sum(sum(c.values()) for _, c in lists)
    df = Counter(t for _, c in lists for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c in lists:
            n = sum(c.values())
            m = 10 + (90 * n * n_docs) // total
            score = 0
            for t in wanted & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return out


def items_of(data, seed=5):
    r = random.Random(seed)
    texts = [t for _, t, *_ in data if t]
    out = [(k, " ".join(r.choices(r.choice(texts).split(), k=r.randint(1, 25)))) for k in range(30)]
    return out + [(2, "ÀB cd, ef!"), (2, None), (None, texts[0]), (90, ""), (91, "  ;;; "), (92, "nowhere"), (-4, texts[3]), (-4, texts[3])]


@pytest.mark.parametrize("max_terms", [lexical_search.MAX_TERMS, 0])
def test_search(spark, max_terms):
    """Copies (ties), nulls, repeated rows, several chunks and groups; terms sent to tasks or joined."""
    data = rows() + [(200 + k, t, None, None, None) for k, t in enumerate(prose(random.Random(9), 40) for _ in range(60))]
    items = items_of(data)
    docs = table(spark, data).withColumn("score", F.lit("x")).withColumn("chunk", F.lit(1)).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = lexical_search.search(docs, asked, max_terms=max_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    matching([tuple(r) for r in got.collect()], plain_search(data, items))


def test_search_stages_and_groups_do_not_matter(spark, monkeypatch):
    data, items = rows(), items_of(rows(), 8)
    expected = plain_search(data, items, 3)
    monkeypatch.setattr(lexical_search, "GROUP", 4)
    for stages in (1, 7):
        got = lexical_search.search(table(spark, data), spark.createDataFrame(items, "item_id long, text string"), 3, stages)
        matching([tuple(r) for r in got.collect()], expected)


def test_search_of_nothing(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.search(none, items).collect() == []
    assert lexical_search.search(table(spark), items.where("false")).collect() == []
    assert lexical_search.search(table(spark, [(1, None, None, None, None)]), items).collect() == []


def plain_words(docs):
    n = Counter()
    for i, t, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1 :]


def plain_variants(docs):
    n = plain_words(docs)
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def misspelt(seed=3):
    """Frequent words, their misspellings, misspellings of those, and words of a few letters that lie close together."""
    r = random.Random(seed)
    base = ["".join(r.choices("abcdeéñÀ", k=r.randint(7, 10))) for _ in range(120)]
    out = []
    for k in range(700):
        own = []
        for w in r.choices(base, [1 / (i + 1) for i in range(len(base))], k=60):
            for _ in range(r.choice([0] * 12 + [1, 1, 2])):
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice("abcdeÿ") + w[at:], w[:at] + r.choice("abcdX") + w[at + 1 :]])
            own.append(w)
        out.append((k, " ".join(own), None, None, None))
    close = ["".join("ab"[(k >> b) & 1] for b in range(8)) for k in range(256)]
    return out + [(1000 + k, " ".join(close), None, None, None) for k in range(3)]


@pytest.mark.parametrize("tile", [spelling.TILE, 7])
def test_variants(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "TOGETHER", 2 if tile == 7 else spelling.TOGETHER)
    data = misspelt() + rows() + rows()[:3]
    got = [tuple(r) for r in spelling.variants(table(spark, data, extra=True)).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    expected = plain_variants(data)
    assert sum(x[1] is not None for x in expected) > 50
    matching(got, expected)


def test_chains_of_forms(spark):
    data = [(k, w, None, None, None) for w, n in (("abcdefgh", 2000), ("abcdefg", 200), ("abcdefgx", 20), ("abcdefxx", 2)) for k in range(n)]
    got = {r.word: (r.form, r.root) for r in spelling.variants(table(spark, data), every=10**12).collect()}
    assert got["abcdefxx"] == ("abcdefgx", "abcdefgh") and got["abcdefg"] == ("abcdefgh", "abcdefgh")


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling.variants(table(spark, [(1, None, None, None, None), (2, "", None, None, None), (3, "abcdefghi", None, None, None)])).collect() == []


PAGES = "page_id long, url string, html string"


def pages(seed=1):
    r = random.Random(seed)
    big = "<p>" + prose(r, 400)
    out = [(k, f"http://example.net/{k}", f"<html>{prose(r, r.randint(1, 300))}</html>") for k in range(120)]
    out += [(200 + k, "http://example.net/ä b\r\nX: y" if k % 2 else None, big) for k in range(9)]
    out += [(300, "u", "x" * 999), (301, "u", "x" * 999), (302, "u", "x" * 1000), (303, "u", "x" * 1000), (304, "u", "é" * 500)]
    out += [(305, "u", "é" * 500), (400, None, None), (401, "v", ""), (None, "w", big), (None, None, None), (402, "w", "a\r\n\r\nb" * 3000)]
    return out + [(208, None, big), (208, None, big), (208, "z", big), (500, "http://example.net", "y" * 2_000_000)]


def plain_pages(data):
    chosen, out = {}, []
    for i, u, h in data:
        h = h or ""
        if i is not None and len(h.encode()) >= 1000:
            chosen[h] = max(chosen.get(h, i), i)
    done = set()
    for i, u, h in sorted(data, key=lambda x: (x[1] is not None, x[1] or "")):
        raw = (h or "").encode()
        best = chosen.get(h or "") if i is not None else None
        whole = best is None or (i == best and h not in done)
        if best is not None and whole:
            done.add(h)
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "response" if whole else "revisit", None if whole else best))
    return out


def test_round_trip(spark, tmp_path):
    data = pages()
    df = spark.createDataFrame(data, PAGES).withColumn("record_type", F.lit(1)).withColumn("same", F.lit("x")).repartition(4)
    catalogue = warc.write_archives(df, f"file://{tmp_path}/a")
    records = warc.read_archives(catalogue)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    matching([tuple(r) for r in records.select(*columns).collect()], plain_pages(data))
    texts = [(r.page_id, bytes(r.payload)) for r in warc.payloads(records).collect()]
    matching(texts, [(i, (h or "").encode()) for i, _, h in data])
    ids = {r.record_id for r in records.collect()}
    assert len(ids) == len(data)
    assert sum(r.records for r in catalogue.collect()) == len(data) + catalogue.select("file").distinct().count()


def test_files(spark, tmp_path):
    """A dictionary leads each file; every record is a frame that it alone can open."""
    warc.write_archives(spark.createDataFrame(pages(), PAGES).repartition(3), str(tmp_path / "b"))
    files = list((tmp_path / "b").glob("*.warc.zst"))
    assert files
    for file in files:
        raw = file.read_bytes()
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == 0x184D2A5D
        book = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
        rest, seen = raw[8 + size :], 0
        while rest:
            one = zstandard.ZstdDecompressor(dict_data=book).decompressobj()
            text = one.decompress(rest)
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")
            rest, seen = one.unused_data, seen + 1
        assert seen > 1


def test_damage_is_found(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc" * 500)], PAGES).coalesce(1)
    catalogue = warc.write_archives(df, str(tmp_path / "c"))
    record = warc._record("2020-01-01T00:00:00Z", 1, "u", "abc", "response", None, None, False).replace(b"abc", b"abd")
    block = record.split(b"\r\n\r\n", 1)
    headers = dict(x.split(": ", 1) for x in block[0].decode().split("\r\n")[1:])
    with pytest.raises(ValueError, match="digest"):
        warc._row(headers, block[1][:-4])
    assert warc.read_archives(catalogue).count() == 1


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], PAGES)
    assert warc.read_archives(warc.write_archives(none, str(tmp_path / "d"))).collect() == []
