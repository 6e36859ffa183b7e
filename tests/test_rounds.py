"""Steps that copy rows or hold many of them do so in parts of bounded size, with the same rows."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalogue import queries
from profilematch import find_similar, fit_index
from profilematch.operators import blocks, pairs, similarity
from profilematch.operators.pairs import pairs_above
from profilematch.plans import models
from profilematch.session import shared_folder, shuffle_cleanup


@pytest.fixture
def rounds(monkeypatch):
    """How many rounds each step took."""
    seen, plain = [], blocks.in_rounds

    def counted(spark, n, step, label):
        seen.append(n)
        return plain(spark, n, step, label)

    monkeypatch.setattr(blocks, "in_rounds", counted)
    return seen


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(11)
    words = [f"w{k}" for k in range(60)]
    rows = [(i, r.choices(words, [1 / (k + 1) for k in range(60)], k=r.randint(0, 25))) for i in range(300)]
    rows += [(400 + i, rows[3][1]) for i in range(20)]
    return spark.createDataFrame(rows, "id long, tokens array<string>").cache()


def lists(df):
    return sorted((r.request_id, r["rank"], r.id, round(r.similarity, 4)) for r in df.collect())


@pytest.mark.parametrize("model,formula", [("A", "log2"), ("B", "smooth")])
@pytest.mark.parametrize("bounded_from", [0, 10**9])
def test_similar_rows_in_rounds(spark, texts, rounds, monkeypatch, model, formula, bounded_from):
    index = fit_index(texts, "id", "tokens", formula).stored()
    asked = texts.select(F.col("id").alias("request_id"), F.col("id").alias("company_id"))
    expected = lists(find_similar(index, asked, 4, model, max_broadcast_requests=10**6))
    for name in ("blocks", "similarity"):
        monkeypatch.setattr({"blocks": blocks, "similarity": similarity}[name], "n_blocks", lambda *_: 40)
    monkeypatch.setattr(blocks, "CELLS_PER_CORE", 1)
    monkeypatch.setattr(blocks, "ROUND_ROWS", 100)
    monkeypatch.setattr(similarity, "KIND_ROWS", 20)
    got = lists(find_similar(index, asked, 4, model, max_broadcast_requests=0, bounded_from=bounded_from))
    assert got == expected
    assert max(rounds) > 1


def test_word_vectors_in_rounds(spark, rounds, monkeypatch):
    r = random.Random(5)
    rows = [(i, [float(r.randint(-3, 3)) for _ in range(4)]) for i in range(200)] + [(300, [float("nan")] * 4)]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>").cache()
    ranked = lists(models.word2vec_similar(vectors, vectors.select("id"), 3))
    monkeypatch.setattr(models, "n_blocks", lambda *_: 40)
    assert lists(models.word2vec_similar(vectors, vectors.select("id"), 3)) == ranked
    dots = {(a[0], b[0]): sum(x * y for x, y in zip(a[1], b[1], strict=True)) for a in rows[:200] for b in rows[:200] if a is not b}
    best = {i: sorted((-s, b) for (a, b), s in dots.items() if a == i)[:3] for i in range(200)}
    assert ranked == sorted((i, k + 1, b, -s) for i, l in best.items() for k, (s, b) in enumerate(l))
    assert rounds[0] == 1 and rounds[1] > 1


@pytest.mark.parametrize("prefixes", [True, False])
def test_pairs_in_rounds(texts, rounds, monkeypatch, prefixes):
    index = fit_index(texts, "id", "tokens", "log2").stored()
    plain = pairs.in_rounds
    monkeypatch.setattr(pairs, "in_rounds", lambda spark, n, step, label: rounds.append(n) or plain(spark, n, step, label))
    found = [sorted((r.id_a, r.id_b, round(r.sim, 8)) for r in pairs_above(index.weights, index.vocab, 0.5, prefixes).collect())]
    monkeypatch.setattr(pairs, "ROUND_ROWS", 100)
    few = pairs_above(index.weights, index.vocab, 0.5, prefixes, 20, cell_rows=40)
    found.append(sorted((r.id_a, r.id_b, round(r.sim, 8)) for r in few.collect()))
    assert found[0] == found[1] and len(found[0]) > 190
    assert rounds[0] == 1 and rounds[1] > 1


def test_a_round_copies_about_the_right_side():
    for left, right in ((40, 100), (160, 400), (960, 2400), (5000, 1)):
        tiles, together = blocks.round_size(left, right, 12)
        cells = together * -(-right // tiles)
        assert cells <= max(2 * blocks.CELLS_PER_CORE * 12, -(-right // tiles))


def test_a_round_has_a_part_of_the_right_side():
    for left, right in ((40, 100), (160, 400), (960, 2400), (5000, 1)):
        tiles, together = blocks.round_size(left, right, 12)
        right = -(-right // tiles)
        a_part = -(-right // blocks.right_parts(together, right, 12))
        assert together * a_part <= 2 * max(blocks.CELLS_PER_CORE * 12, together)


def test_vectors_do_not_stay(spark, texts, rounds, monkeypatch):
    def steps():
        return {p.name for p in Path(shared_folder(spark)).glob("profilematch/*")}

    index = fit_index(texts, "id", "tokens", "smooth").stored()
    asked = texts.select(F.col("id").alias("request_id"), F.col("id").alias("company_id"))
    monkeypatch.setattr(similarity, "KIND_ROWS", 20)
    monkeypatch.setattr(blocks, "ROUND_ROWS", 100)
    before = steps()
    assert find_similar(index, asked, 4, "B", max_broadcast_requests=0, bounded_from=0).count() == 4 * 320
    assert sorted(name.rsplit("-", 1)[0] for name in steps() - before) == ["bounded-scores"]
    # all rows are asked: a round copies half as many of them as there are, and meets a part of the blocks
    assert max(rounds) >= 4 and max(rounds) % blocks.RIGHT_PARTS == 0


def test_pairs_with_blocks_are_bounded_in_each_turn(spark, texts, monkeypatch):
    index = fit_index(texts, "id", "tokens", "smooth").stored()
    asked = texts.select(F.col("id").alias("request_id"), F.col("id").alias("company_id"))
    expected = lists(find_similar(index, asked, 4, "B", max_broadcast_requests=10**6))
    pairs, turns, plain = [], [], similarity.needed_blocks

    def counted(rows, asked, *more, **options):
        needed = plain(rows, asked, *more, **options)
        pairs.append(needed.count())
        own = asked.select("id", F.col("block").alias("rb"))
        assert needed.join(own, ["id", "rb"]).count() == 0
        return needed

    monkeypatch.setattr(similarity, "needed_blocks", counted)
    monkeypatch.setattr(similarity, "KIND_ROWS", 20)
    for rows in (10**5, 100):
        monkeypatch.setattr(similarity, "ROUND_ROWS", rows)
        monkeypatch.setattr(similarity, "PAIRS_A_ROW", 2)
        pairs.clear()
        assert lists(find_similar(index, asked, 4, "B", max_broadcast_requests=0, bounded_from=0)) == expected
        turns.append(list(pairs))
    assert len(turns[0]) == 1 < len(turns[1]) and sum(turns[0]) == sum(turns[1])
    # a turn's rows come by a hash, so their number varies
    assert max(turns[1]) <= 2 * similarity.PAIRS_A_ROW * 320
    # the number of turns follows the asked rows times the blocks: pairs of a turn stay in proportion to the rows
    assert [similarity.asked_turns(400_000 * k, 250 * k, 1_000_000 * k) for k in (1, 6)] == [50, 300]


def test_setting_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with pytest.raises(KeyError), shuffle_cleanup(spark):
        assert spark.conf.get(name) == "true"
        raise KeyError
    assert spark.conf.get(name, None) == before


def test_similar_rows_leave_no_second_copy_of_the_counts(spark, tmp_path, monkeypatch):
    """Weights are read from the stored counts: only those and the result lie on disk at the end, not the weights too."""
    r = random.Random(3)
    docs = [(i, " ".join(r.choices(["aa", "bb", "cc", "dd", "ee", "ff"], k=5))) for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i,) for i in range(0, 40, 2)], "doc_id long").write.parquet(f"{tmp_path}/labels.parquet")
    before = {p.name for p in Path(shared_folder(spark)).glob("profilematch/*")}
    found = queries.QUERIES["find_similar_b"](spark, str(tmp_path)).collect()
    assert len(found) == 20 * 5
    steps = {p.name.rsplit("-", 1)[0] for p in Path(shared_folder(spark)).glob("profilematch/*") if p.name not in before}
    assert "counts" in steps and "weights" not in steps


def test_cells_of_a_round_hold_little_more_than_the_cores_need():
    """Left and right rows of a round's cells, against those of both sides: 51,282 documents, 20,598 asked, 8 cores."""
    tiles, together = blocks.round_size(13, 32, 8)
    left, right = -(-13 // tiles), -(-32 // tiles)
    parts = blocks.right_parts(together, right, 8)
    copies = together * right / parts * (20_598 / left + 51_282 / right)
    assert copies <= 2 * 51_282
