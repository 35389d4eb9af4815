"""Whitening against numpy and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from plazalens.llm import whitening


@pytest.fixture
def embeddings(spark):
    def make(rows):
        schema = "vec_id long, embedding array<float>, label int, vector string, steps string, n string"
        return spark.createDataFrame([(vec, None if v is None else [None if c is None else float(c) for c in v], 1, "x", "x", "x") for vec, v in rows], schema)

    return make


def test_popcounts_are_cross_products():
    rng = np.random.default_rng(13)
    for rows, top in ((1, 5), (63, 2), (64, 900), (65, 1), (500, 1 << 40), (300, (1 << 63) + 5), (40, 0)):
        shifted = rng.integers(0, top, (rows, 5), np.uint64, endpoint=True)
        exact = shifted.astype(object)
        assert (whitening.cross_products(shifted) == exact.T @ exact).all()


def check(got, rows, size):
    usable = [(vec, [math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v]) for vec, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    fit = sorted({tuple(x) for _, x in usable})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    cov = np.array([[float(Fraction(n * sum(a[i] * a[j] for a in fit) - sums[i] * sums[j], n * n)) for j in range(size)] for i in range(size)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(16, int((values > 1e-12 * values.sum()).sum()))
    by_row = sorted(map(tuple, got), key=lambda r: (repr(r[0]), r[3], r[1]))
    assert len(by_row) == len(usable) * count
    want = []
    for vec, x in usable:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        centred = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)])
        want += [(vec, k + 1, n, deviation, centred @ vectors[:, k] / math.sqrt(values[k]), values[k] / values.sum()) for k in range(count)]
    want.sort(key=lambda r: (repr(r[0]), r[3], r[1]))
    sign = {}
    for one, other in zip(by_row, want):
        assert one[:4] == other[:4]
        if abs(other[4]) > 1e-6:
            sign.setdefault(one[1], np.sign(one[4]) * np.sign(other[4]))
        assert one[4] == pytest.approx(sign.get(one[1], 1) * other[4], abs=1e-6)
        assert one[5] == pytest.approx(other[5], rel=1e-9)
        assert one[6] < 1e-9


def test_whiten(embeddings):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=20) * np.arange(1, 21)).tolist()) for i in range(400)]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (900, rows[3][1]), (901, None), (902, [None] * 20), (903, [math.nan] * 20)]
    rows += [(904, [math.inf] * 20), (905, []), (906, [1.0]), (907, [0.0] * 20)]
    check(whitening.whiten(embeddings(rows)).collect(), rows, 20)


def test_few_dimensions_and_a_hot_vector(embeddings):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [i % 7, i % 11 - 5, 0.25]) for i in range(300)]
    check(whitening.whiten(embeddings(rows)).collect(), rows, 3)


def test_nothing_varies(embeddings):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        got = whitening.whiten(embeddings(rows))
        assert got.collect() == []
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_stay_exact(embeddings):
    rows = [(1, [2.0**40, 0.0]), (2, [-(2.0**40), 1.0]), (3, [3.0, 5.0]), (4, [3e38, 1.0])]
    got = whitening.whiten(embeddings(rows[:3])).collect()
    x = [[int(64 * c) for c in v] for _, v in rows[:3]]
    sums = [sum(column) for column in zip(*x)]
    exact = {i: sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for (i, _), v in zip(rows, x)}
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, d in exact.items()}
    assert len(whitening.whiten(embeddings(rows)).collect()) >= 4
