"""Near-duplicates, decontamination, classifiers and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from profilematch.llm import bpe, components, crf, decontaminate, near_dedup, quality_model, samples, toxicity
from tests.llm.fixtures import SCHEMA, matching, prose, rows, table, words


def plain_classes(data):
    """Class (least doc_id) and size of each row, by comparing all texts."""
    own, nodes = near_dedup.shingles(pa.array([t for _, t, *_ in data], pa.string()))
    counts = np.zeros(near_dedup.WIDTH, np.int64)
    for x in own:
        counts += np.bincount((np.unique(x) >> np.uint64(46)).astype(np.int64), minlength=near_dedup.WIDTH)
    levels = near_dedup.idf_levels(counts, sum(1 for x in own if len(x)))
    weights = [near_dedup.weigh(x, levels) for x in own]
    group = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            ok = data[i][0] is not None and data[j][0] is not None and len(own[i]) and len(own[j])
            if ok and group[i] != group[j] and near_dedup.similarity(weights[i], weights[j]) >= 0.8:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, (doc, *_) in enumerate(data):
        members = [data[k][0] for k in range(len(data)) if group[k] == group[i]]
        out.append((doc, doc if doc is None else min(members), len(members)))
    return out


def test_near_duplicates(spark):
    got = near_dedup.classes(table(spark, extra=True)).select("doc_id", "class_id", "class_size").collect()
    matching([tuple(r) for r in got], plain_classes(rows()))


def test_near_duplicates_keep_one(spark):
    docs = table(spark, extra=True)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {c for _, c, _ in plain_classes(rows())}
    assert {r.doc_id for r in kept.collect()} == expected
    assert {repr(r) for r in kept.collect()} <= {repr(r) for r in docs.collect()}  # clashing names: nothing overwritten
    named = [(r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()]
    assert len(named) == len(set(named))
    assert near_dedup.classes(docs.limit(0)).collect() == [] and near_dedup.keep_one(docs.limit(0)).collect() == []


def test_a_shared_passage_is_no_near_duplicate(spark):
    r = random.Random(5)
    passage = prose(r, 60)
    data = [(i, f"{prose(r, 150)} {passage}", "en", "s", 0) for i in range(80)]
    assert near_dedup.classes(table(spark, data)).where("class_size > 1").count() == 0


def copies_of_copies(seed, n, edits):
    """Each text is an edited copy of an earlier one: a class holds together by links between its members only."""
    r = random.Random(seed)
    texts = [words(r, 120)]
    while len(texts) < n:
        own = list(r.choice(texts))
        for _ in range(edits):
            own[r.randrange(len(own))] = f"edit{r.randrange(10**9)}"
        texts.append(own)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("block", [256, 12])
def test_near_duplicates_of_copies_of_copies(spark, monkeypatch, block):
    """Links between texts that are no pivots count as well, also where a bucket is compared block by block."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", block, raising=False)
    texts = [t for seed in (1, 2) for t in copies_of_copies(seed, 110, 2)]
    data = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = near_dedup.classes(table(spark, data)).select("doc_id", "class_id", "class_size").collect()
    expected = plain_classes(data)
    assert {c for _, c, _ in expected} == {0, 110}
    matching([tuple(r) for r in got], expected)


def test_sampling_agrees_with_weighted_jaccard():
    r = np.random.default_rng(1)
    hashes = np.sort(r.integers(0, 2**63, 900).astype(np.uint64))
    weights = r.choice([1.25, 1.1, 2.5, 7.0], 900)
    a, b = (hashes[:700], weights[:700]), (hashes[100:], weights[100:])
    agree = np.mean(near_dedup.samples(*a) == near_dedup.samples(*b))
    assert abs(agree - near_dedup.similarity(a, b)) < 0.2


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (20, 4)] + [(50, 51 + i) for i in range(40)]
    got = {(r.node, r.root) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 1) for i in (1, 2, 3, 4, 20)} | {(i, 10) for i in (10, 11, 12)} | {(50 + i, 50) for i in range(41)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def benchmark(spark, r):
    items = [(i, " ".join(words(r, 30)) + ".") for i in range(6)] + [(6, " ".join(words(r, 9))), (7, "too short"), (None, "x"), (8, None)]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [decontaminate.BLOCK_TOKENS, 60])
def test_decontamination(spark, limit):
    """Whole, upper-case and changed passages are found, whatever the blocks; clean documents are left alone."""
    r = random.Random(11)
    items, bench = benchmark(spark, r)
    changed = items[2][1].split()
    for k in (4, 11, 18, 25):
        changed[k] = "other"
    planted = {
        1000: items[0][1], 1001: items[1][1].upper(), 1002: " ".join(changed), 1003: items[6][1],
        1004: " ".join(items[3][1].split()[5:22]), 1005: " ".join(items[4][1].split()[:8]), 1006: "too short",
    }
    data = [*rows(), *[(i, f"{prose(r, 40)} {t} {prose(r, 40)}", "en", "s", 0) for i, t in planted.items()]]
    out = decontaminate.find_matches(table(spark, data, extra=True), bench, limit)
    got = {r.doc_id: [m.item_id for m in r.matches] for r in out.collect() if r.matches}
    assert got == {1000: [0], 1001: [1], 1002: [2], 1003: [6], 1004: [3]}
    kept = decontaminate.decontaminate(table(spark, data, extra=True), bench)
    assert kept.columns == table(spark, extra=True).columns and kept.count() == len(data) - 5
    assert decontaminate.decontaminate(table(spark), bench.limit(0)).count() == len(rows())
    assert decontaminate.find_matches(table(spark).limit(0), bench).collect() == []


def test_decontamination_of_changed_short_items(spark):
    """Items of 8 to 20 tokens are found wherever a fifth of them is changed, ends included; one more change is clean."""
    r = random.Random(12)
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in range(8, 21)]
    data, expected = [], {}
    for n, text in items:
        for trial in range(12):
            own, doc = text.split(" "), 1000 * n + trial
            few = n // 5 + (trial == 11)
            places = [0, n - 1, n // 2, n // 3][:few] if trial == 0 else r.sample(range(n), few)
            for k in places:
                own[k] = "other"
            data.append((doc, f"{prose(r, 40)} {' '.join(own)} {prose(r, 40)}", "en", "s", 0))
            if trial < 11:
                expected[doc] = [n]
            elif n - few >= 13:
                data.pop()  # a run of 13 may count on its own
    out = decontaminate.find_matches(table(spark, data), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: [m.item_id for m in r.matches] for r in out.collect() if r.matches} == expected


def plain_overlap(own, doc):
    """The greatest number of equal tokens that an item and a text share along one diagonal, by the stated rule."""
    best, most = 0, -(-4 * len(own) // 5)
    for shift in range(1 - len(own), len(doc)):
        same = [own[k] == doc[k + shift] for k in range(max(0, -shift), min(len(own), len(doc) - shift))]
        gain = n = run = top = 0
        for x in same:
            gain, run = (gain + 1, run + 1) if x else (gain - 2, run)
            if gain < 0:  # of equally good runs the one that begins first
                gain = run = 0
            elif gain > top:
                top, n = gain, run
        n = max(n, sum(same)) if sum(same) >= most else n
        best = max(best, n if n >= min(decontaminate.LEAST, most) else 0)
    return best


@pytest.mark.parametrize("limit", [decontaminate.BLOCK_TOKENS, 60])
def test_decontamination_of_longer_items_against_all_diagonals(spark, limit):
    """Nothing is found that a plain search of all diagonals doesn't find, and little is missed, either way.

    Items have 21 to 90 tokens and up to three in ten of them changed; texts come twice, one of them very often."""
    r = random.Random(21)
    items, data, expected = [], [], {}
    for i, n in enumerate((21, 22, 25, 30, 40, 60, 90)):
        own = [f"v{i}x{k}" for k in range(n)]
        items.append((i, " ".join(own)))
        for trial in range(12):
            changed = list(own)
            for k in r.sample(range(n), n * (trial % 4) // 10):
                changed[k] = "other"
            text, doc = [*words(r, 15), *changed, *words(r, 15)], 100 * i + trial
            data += [(doc, " ".join(text), "en", "s", 0)] * (60 if doc == 0 else 2)
            expected[doc] = plain_overlap(own, text)
    out = decontaminate.find_matches(table(spark, data, extra=True), spark.createDataFrame(items, "item_id long, text string"), limit)
    rows_ = out.collect()
    assert len(rows_) == len(data)
    found = 0
    for row in rows_:
        assert [m.item_id for m in row.matches] in ([], [row.doc_id // 100])
        assert all(m.n_tokens == expected[row.doc_id] for m in row.matches)
        found += bool(row.matches)
    assert found >= 0.98 * sum(expected[row.doc_id] > 0 for row in rows_) > 0


def plain_marginals(w, emission, first):
    """Forward and backward passes token by token."""
    out, n = np.zeros(len(emission)), len(emission)
    starts = [*np.flatnonzero(first), n]
    for a, b in zip(starts, starts[1:]):
        paths = np.zeros((b - a, 2))
        ahead = np.exp(w.start) * np.exp([0, emission[a]])
        forward = [ahead]
        for t in range(a + 1, b):
            forward.append((forward[-1] @ np.exp(w.moves)) * np.exp([0, emission[t]]))
        back = np.ones(2)
        for t in range(b - 1, a - 1, -1):
            paths[t - a] = forward[t - a] * back
            back = np.exp(w.moves) @ (np.exp([0, emission[t]]) * back)
        out[a:b] = paths[:, 1] / paths.sum(axis=1)
    return out


def test_marginals():
    r = np.random.default_rng(2)
    for n in (1, 2, 7, 50, 333):
        first = r.random(n) < 0.1
        first[0] = True
        w = crf.Weights(np.zeros(1), r.normal(size=(2, 2)), r.normal(size=2))
        emission = r.normal(size=n)
        assert np.allclose(crf.marginals(w, emission, first)[0], plain_marginals(w, emission, first))


def toxic_rows():
    r = random.Random(4)
    data, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        own = prose(r, 80).split(" ")
        if toxic:
            own[r.randrange(len(own))] = r.choice(["Zorg,", "blarg"])
        data.append((i, " ".join(own) if i % 40 else None, None, None, 0))
        labels.append((i, int(i % 3 > 0), int(toxic)))
    return data, labels


def test_toxicity(spark):
    data, labels = toxic_rows()
    docs, marks = table(spark, [*data, *rows()], extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks, samples.fold(5) != 0)
    out = toxicity.score(docs, model)
    assert out.count() == len(data) + len(rows())
    held = out.where(samples.fold(5) == 0).join(marks, "doc_id").where("text is not null and length(text) > 300").dropDuplicates(["doc_id"])
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in held.collect() if r.doc_id >= 40]) >= 0.9
    tagged = [r.text[s.start : s.end].lower() for r in out.where("size(spans) > 0").collect() for s in r.spans]
    assert len(tagged) > 30 and np.mean([w in ("zorg", "blarg") for w in tagged]) >= 0.8
    assert toxicity.fit(docs, marks.limit(0), samples.fold(5) != 0) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_quality_classifier(spark):
    r = random.Random(9)
    data, labels = [], []
    for i in range(200):
        lines = [" ".join(words(r, 12)) + "." for _ in range(6)]
        if i % 3 == 0:
            lines[1:] = [" ".join(w.upper() + "!!" for w in words(r, 12)) for _ in range(5)]
        data.append((i, "\n".join(lines), None, None, 0))
        labels.append((i, int(i % 3 > 0), 0))
    docs, marks = table(spark, [*data, *rows()], extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality_model.fit(docs, marks, samples.fold(3) != 1)
    out = quality_model.score(docs, model)
    assert out.count() == len(data) + len(rows()) and out.where("score is null or score < 0 or score > 1").isEmpty()
    held = [r for r in out.where(samples.fold(3) == 1).collect() if r.doc_id is not None and 60 < r.doc_id < 200 and r.doc_id != 100]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 3 > 0) for r in held]) > 0.95
    assert {r.score for r in quality_model.score(docs, None).collect()} == {0.0}
    assert quality_model.score(docs.limit(0), model).collect() == []


def test_pipeline(spark, tmp_path):
    r = random.Random(11)
    items, bench = benchmark(spark, r)
    secret = f"{prose(r, 80)} password=abcdefghijklmnop {prose(r, 30)}"
    leak = f"{prose(r, 80)} {items[0][1]} {prose(r, 30)}"
    data = [*rows(), (2000, secret, "en", "s0", 1), (2001, leak, "en", "s0", 1)]
    table(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            seen.append([tuple(r) for r in docs.collect()])
    rules, *later = seen
    near, clean, hidden = [{r[0]: r[1] for r in kept} for kept in later]
    assert set(near) == {c for _, c, _ in plain_classes(rules)}
    assert set(near) - set(clean) == {2001} and set(clean) == set(hidden)
    assert "password" not in hidden[2000] and "<assign>" in hidden[2000]
    ids = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(ids) == set(hidden) and all(ids.values())
    assert spark.createDataFrame([], SCHEMA).columns == docs.columns


def test_texts_are_encoded_in_small_pieces():
    """A worker holds some hundred KB of text at a time, however large its batch; a longer text is whole."""
    texts = ["word " * 2_000] * 400 + [None, "", "x" * (1 << 20), "end"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(bpe.pieces(batch))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 512 << 10 for p in parts)
