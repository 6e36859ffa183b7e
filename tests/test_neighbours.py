"""Nearest rows by pruned blocks against a plain search."""

import random

import pytest

from profilematch.plans.neighbours import nearest_pruned

LEFT, RIGHT = "id long, vector array<double>", "id long, vector array<double>, label string"


def plain(left, right, k):
    out = set()
    for i, v in left:
        far = [(round(sum((x - y) ** 2 for x, y in zip(v, w, strict=True)) ** 0.5, 8), j, lab) for j, w, lab in right]
        out |= {(i, r + 1, j, lab, d) for r, (d, j, lab) in enumerate(sorted(far)[:k])}
    return out


def found(spark, left, right, k, pivots=None):
    result = nearest_pruned(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), k, pivots)
    rows = result.neighbours.collect()
    assert len(rows) == len({(r.id, r.rank) for r in rows})
    return {(r.id, r.rank, r.neighbour, r.label, round(r.distance, 8)) for r in rows}, result.report.first()


def clustered(seed, n, width=3, spread=0.05):
    draw = random.Random(seed)
    middles = [[draw.uniform(-5, 5) for _ in range(width)] for _ in range(12)]
    return [(i, [draw.gauss(c, spread) for c in middles[draw.randrange(12)]], f"l{i % 4}") for i in range(n)]


@pytest.mark.parametrize("pivots", [1, 7, 40])
def test_equal_to_a_plain_search_and_pruned(spark, pivots):
    rows = clustered(1, 420)
    left, right = [r[:2] for r in rows[:60]], rows[60:]
    got, report = found(spark, left, right, 5, pivots)
    assert got == plain(left, right, 5)
    assert report.asked == 60 and report.all_distances == 60 * 360
    if pivots == 40:
        assert report.distances * 3 < report.all_distances


def test_rings_and_salts(spark, monkeypatch):
    monkeypatch.setattr("profilematch.plans.neighbours.BLOCK_ROWS", 16)
    draw = random.Random(2)
    rows = [(i, [float(draw.randrange(4)), float(draw.randrange(4))], "x") for i in range(300)]
    rows += [(i, [draw.gauss(0, 9), draw.gauss(0, 9)], "y") for i in range(300, 500)]
    left, right = [r[:2] for r in rows[::5]], [r for r in rows if r[0] % 5]
    got, report = found(spark, left, right, 4, 3)
    assert got == plain(left, right, 4)
    assert report.blocks > 6


def test_ties_copies_and_negative_zero(spark):
    right = [(i, [0.0, 0.0] if i % 3 else [1.0, -0.0], f"l{i % 2}") for i in range(90)]
    left = [(i, [0.0, 0.0]) for i in range(200, 240)] + [(300, [-0.0, 0.0]), (301, [1.0, 0.0]), (302, [0.5, 0.0])]
    got, report = found(spark, left, right, 3)
    assert got == plain(left, right, 3)
    assert report.asked == 3


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    right = [(1, [0.0, 1.0], "a"), (2, None, "b"), (3, [nan, 0.0], "c"), (4, [None, 0.0], "d"), (5, [inf, 0.0], "e"), (6, [2.0, 2.0], None)]
    left = [(10, [0.0, 0.0]), (11, None), (12, [nan, nan])]
    got, _ = found(spark, left, right, 5)
    assert {g[:4] for g in got} == {(10, 1, 1, "a"), (10, 2, 6, None)}
    assert found(spark, left, [], 2)[0] == set() and found(spark, [], right, 2)[0] == set()
    with pytest.raises(ValueError, match="width"):
        found(spark, [(1, [0.0])], right, 1)
