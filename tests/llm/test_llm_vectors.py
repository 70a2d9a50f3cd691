"""Whitening and hard negatives against dense algebra and plain loops."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from saldo.llm.catalog import QUERIES
from saldo.llm.hardneg import blocks_of, hard_negatives
from saldo.llm.whitening import components, polar, whitened_components


# --- whitening -----------------------------------------------------------------------------------


def test_polar_factor_and_components_of_hard_matrices():
    draw = np.random.default_rng(7)
    for size in (1, 2, 5, 40):
        turn = np.linalg.qr(draw.standard_normal((size, size)))[0]
        for values in (
            draw.standard_normal(size), np.linspace(1, 2, size), np.repeat([4.0, 1.0], [size - size // 2, size // 2]),
            10.0 ** -np.linspace(0, 14, size), np.full(size, 3.0), np.r_[1e6, np.ones(size - 1)], np.zeros(size),
        ):
            matrix = turn * values @ turn.T
            found, vectors = components(matrix, 6)
            wanted = np.sort(values)[::-1][:6]
            scale = max(1e-300, np.abs(values).max())
            assert np.allclose(found, wanted, atol=1e-13 * scale, rtol=0)
            assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-13)
            assert np.allclose(matrix @ vectors, vectors * found, atol=1e-13 * scale)
            if np.abs(values).min() > 1e-10 * scale:
                signs = turn * np.sign(values) @ turn.T
                assert np.allclose(polar((matrix + matrix.T) / 2), signs, atol=1e-5)


def dense(x, wanted=8):
    n, total = len(x), x.sum(axis=0)
    gaps = [[n * int(v) - int(s) for v, s in zip(row, total)] for row in x]
    centred = np.array(gaps, float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:wanted]
    return gaps, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check(rows, ids, x, wanted=8):
    gaps, whitened, explained = dense(x, wanted)
    assert len(rows) == len(x) * min(wanted, x.shape[1])
    found = np.zeros_like(whitened)
    for r in rows:
        at = ids.index(r.vec_id)
        assert r.n == len(x) and r.deviation == sum(g * g for g in gaps[at])
        assert abs(r.explained - explained[r.component - 1]) <= 1e-10 * r.explained
        assert r.identity_error < 1e-9
        found[at, r.component - 1] = r.whitened
    for c in range(whitened.shape[1]):  # one sign for all rows
        sign = np.sign(found[:, c] @ whitened[:, c])
        assert np.allclose(found[:, c] * sign, whitened[:, c], atol=1e-8)


def test_whitening_query_equals_dense_algebra(spark, tables):
    table = pq.read_table(f"{tables}/embeddings.parquet").to_pydict()
    x = np.floor(1024 * np.array(table["embedding"], float)).astype(np.int64) + 100_000
    query = QUERIES["op12_qdwh_whitening"](spark, tables)
    assert [t for _, t in query.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    check(query.collect(), table["vec_id"], x)


VECTORS = "vec_id long, x array<long>, n string, tag string"


def test_whitening_edge_cases(spark):
    draw = np.random.default_rng(3)
    x = draw.integers(-50, 50, (40, 3))
    x[10:30] = x[10]  # a group of copies
    rows = [(i, [int(v) for v in row], "clash", None) for i, row in enumerate(x)]
    broken = [(98, None, "", ""), (99, [], "", ""), (97, [1, None, 2], "", "")]
    found = whitened_components(spark.createDataFrame(rows + broken, VECTORS), "x")
    assert found.columns == ["vec_id", "x", "tag", "component", "n", "deviation", "whitened", "explained",
                             "identity_error"]
    check(found.collect(), list(range(40)), x)
    twice = whitened_components(spark.createDataFrame([*rows, rows[0], (None, *rows[1][1:])], VECTORS), "x", 2)
    again = [r for r in twice.collect() if r.vec_id == 0]
    assert len(again) == 4 and twice.count() == 84 and twice.where("vec_id IS NULL").count() == 2
    for same in ([], rows[:1], [rows[0]] * 5, broken):
        assert whitened_components(spark.createDataFrame(same, VECTORS), "x").count() == 0
    flat = [(i, [i, 2 * i, 7], "", "") for i in range(9)]  # one component has variance
    assert {r.component for r in whitened_components(spark.createDataFrame(flat, VECTORS), "x").collect()} == {1}
    with pytest.raises(ValueError):
        whitened_components(spark.createDataFrame([*rows, (1, [1, 2], "", "")], VECTORS), "x")


# --- hard negatives ------------------------------------------------------------------------------


def loops(rows, is_anchor, k=5):
    """(anchor, positive, rank, negative, positive score, negative score) by plain loops."""
    rows = sorted({(i, l, tuple(v)) for i, l, v in rows if None not in (i, l, v) and None not in (v or [])})
    out = []
    for a in (r for r in rows if is_anchor(r)):
        def score(r):
            return sum(x * y for x, y in zip(a[2], r[2]))
        ranked = sorted((r for r in rows if r != a), key=lambda r: (-score(r), r[0]))
        for p in [r for r in ranked if r[1] == a[1]][:k]:
            fits = [r for r in ranked if r[1] != a[1] and 80 * score(p) <= 100 * score(r) <= 100 * score(p)]
            out += [(a[0], p[0], i + 1, r[0], score(p), score(r)) for i, r in enumerate(fits[:k])]
    return sorted(out)


def mined(spark, rows, condition="id % 10 = 0", **how):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, label int, vector array<int>, score string, rank int")
    return sorted(tuple(r) for r in hard_negatives(frame, condition, **how).collect())


def test_negatives_equal_loops_over_many_blocks(spark):
    draw = np.random.default_rng(11)
    middles = draw.integers(-40, 40, (6, 8))
    rows = [
        (i, int(draw.integers(0, 4)), [int(x) for x in middles[draw.integers(0, 6)] + draw.integers(-9, 9, 8)])
        for i in range(900)
    ]
    for i in range(100, 400):  # a group of copies over all labels
        rows[i] = (i, rows[i][1], rows[5][2])
    wanted = loops(rows, lambda r: r[0] % 10 == 0)
    assert wanted and mined(spark, rows, block=64) == wanted == mined(spark, rows)


def test_negatives_edge_cases(spark):
    rows = [
        (0, 1, [3, 0]), (0, 1, [3, 0]), (0, 2, [3, 0]), (1, 1, [2, 1]), (2, 1, [0, 0]), (3, 2, [2, 0]), (4, 2, [0, 5]),
        (5, 2, [2, 2]), (6, 3, [-1, 0]), (10, 3, [0, 0]), (20, 3, [-4, 1]), (30, 9, [1, 1]), (None, 1, [1, 1]),
        (7, None, [1, 1]), (8, 1, None), (9, 1, [None, 1]), (10, 3, [5, 5]),
    ]
    assert mined(spark, rows) == loops(rows, lambda r: r[0] % 10 == 0) != []
    assert mined(spark, rows[:1]) == mined(spark, [(1, 1, [1, 1])]) == []
    assert hard_negatives(spark.createDataFrame([], "id long, label int, vector array<int>"), "true").count() == 0
    with pytest.raises(ValueError):
        mined(spark, [(0, 1, [1]), (1, 1, [1, 2])])


def test_blocks_hold_few_or_one_cluster():
    assert blocks_of({0: 5, 1: 3, 2: 25, 3: 1, 4: 9}, 10) == {0: (0, 1), 1: (0, 1), 2: (1, 3), 3: (4, 1), 4: (4, 1)}
