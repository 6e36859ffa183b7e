"""Blocks that tasks read themselves: the same scores as plain products, each row under its own rules, nothing shuffled."""

import io
import random
from contextlib import redirect_stdout

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from profilematch import fit_index
from profilematch.operators import packed
from profilematch.operators.pairs import pairs_above


def table(rows, seed, **more):
    r = random.Random(seed)
    terms = [sorted({min(int(r.expovariate(0.1)), 59) for _ in range(r.randint(1, 12))}) for _ in range(rows)]
    ws = [[r.choice([0.25, 0.5, r.random()]) for _ in t] for t in terms]
    return pa.table({"id": [seed * 1000 + i for i in range(rows)], "terms": terms, "ws": ws, **more})


def dense(t):
    out = np.zeros((len(t), 60))
    for i, (terms, ws) in enumerate(zip(t["terms"].to_pylist(), t["ws"].to_pylist(), strict=True)):
        out[i, terms] = ws
    return out


@pytest.mark.parametrize("share,columns,pairs", [(700, 1024, 50_000), (3, 2, 7), (10**9, 1, 5), (0, 1, 1)])
def test_cells_equal_plain_products(monkeypatch, share, columns, pairs):
    for name, value in (("DENSE_SHARE", share), ("COLUMNS", columns), ("PAIRS", pairs), ("AGAIN", 3)):
        monkeypatch.setattr(packed, name, value)
    a, b = table(40, 1), table(30, 2)
    plain = dense(a) @ dense(b).T
    cell = packed.Cell(packed._pack(a), packed._pack(b))
    assert np.all(np.abs(cell.near - plain) <= plain * cell.error + 1e-12)
    for some in (5, 40 * 30):
        row, col = (x[:some] for x in np.nonzero(plain >= 0))
        assert np.allclose(cell.exact(row, col), plain[row, col], rtol=0, atol=1e-13)
    row, col, sim = packed.Cell(packed._pack(a), packed._pack(b)).reach(np.full(40, 0.5))
    found = {(i, j) for i, j, s in zip(row.tolist(), col.tolist(), sim, strict=True) if s > 0.5}
    assert found == set(zip(*(x.tolist() for x in np.nonzero(plain > 0.5)), strict=True))


def test_packed_rows_come_back():
    a = table(25, 4)
    block = packed._pack(a)
    assert block.vectors().select(["id", "terms", "ws"]).to_pylist() == a.to_pylist()
    odd = np.arange(25) % 2 == 1
    assert block.only(odd).vectors().to_pylist() == [r for k, r in enumerate(a.to_pylist()) if k % 2]
    both = packed.Block.together([block.only(odd), block.only(~odd)])
    assert sorted(both.vectors().to_pylist(), key=lambda r: r["id"]) == a.to_pylist()
    parts = [t for _, t in packed._cut(a, 4, None, 3)]
    assert len(parts) >= 6 and sorted(i for t in parts for i in t["id"].to_pylist()) == a["id"].to_pylist()


def test_terms_that_come_twice_count_twice(monkeypatch):
    a = pa.table({"id": [1, 2], "terms": [[5, 5, 7], [7]], "ws": [[0.5, 0.25, 1.0], [0.5]]})
    for share in (0, 10**9):
        monkeypatch.setattr(packed, "DENSE_SHARE", share)
        cell = packed.Cell(packed._pack(a), packed._pack(a))
        assert np.allclose(cell.exact(np.array([0, 0, 1]), np.array([0, 1, 1])), [0.75**2 + 1, 0.5, 0.25])


def test_best_rows_under_their_own_rules():
    n, rights = 3, [table(20, k, grp=[[None, "x", "y"][i % 3] for i in range(20)]) for k in (1, 2, 3)]
    left = table(24, 1).append_column("self_id", pa.array([1000 + i if i % 2 else None for i in range(24)]))
    rules = {"grp": [[None, None, "x", "z"][i % 4] for i in range(24)], "threshold": [[-1.0, 0.3][i % 5 == 0] for i in range(24)], "larger_first": [i % 3 == 0 for i in range(24)]}
    for name, values in rules.items():
        left = left.append_column(name, pa.array(values))
    best = packed.Best(packed._pack(left), n, "asc")
    for right in rights:
        best.meet(packed._pack(right))
    schema = pa.schema([("request_id", pa.int64()), ("id", pa.int64()), ("sim", pa.float64())])
    found = best.found(schema).to_pylist()
    scores = [(dense(left) @ dense(r).T, r) for r in rights]
    for i, row in enumerate(left.to_pylist()):
        one = []
        for plain, right in scores:
            for j, other in enumerate(right.to_pylist()):
                sim, fits = round(plain[i, j], 10), row["grp"] is None or row["grp"] == other["grp"]
                if sim > 0 and sim >= row["threshold"] and fits and other["id"] != row["self_id"]:
                    one.append((-sim, -other["id"] if row["larger_first"] else other["id"], other["id"]))
        assert [x["id"] for x in found if x["request_id"] == row["id"]] == [x[2] for x in sorted(one)[:n]]


def test_pairs_of_blocks_are_neither_shuffled_nor_stored(spark):
    rows = [(i, [f"w{k}" for k in range(i % 7, i % 7 + 4)]) for i in range(40)]
    docs = spark.createDataFrame(rows, "id long, tokens array<string>")
    index = fit_index(docs, "id", "tokens", "smooth").stored()
    sizes = docs.select("id", (F.col("id") % 3 + 1).alias("n"))
    pairs = pairs_above(index.weights, index.vocab, 0.5, False, members=sizes)
    out = io.StringIO()
    with redirect_stdout(out):
        pairs.explain()
    assert "Exchange" not in out.getvalue() and "FileScan" not in out.getvalue()
    found = pairs.collect()
    assert {(r.id_a, r.id_b) for r in found} == {tuple(r)[:2] for r in pairs_above(index.weights, index.vocab, 0.5, True).collect()}
    assert found and all((r.n_a, r.n_b) == (r.id_a % 3 + 1, r.id_b % 3 + 1) and r.id_a < r.id_b for r in found)
