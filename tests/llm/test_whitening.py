"""Whitening against numpy's own eigensolver, and the slicing on spectra that are hard to part."""

import numpy as np
import pytest

from hazardflow.llm import spectrum, whitening

SCHEMA = "vec_id long, embedding array<float>, x int, n long, component string"


def spectra():
    rnd = np.random.default_rng(0)
    yield "spread", np.sort(rnd.uniform(0, 9, 40))[::-1]
    yield "close", 60 + np.arange(50)[::-1] * 1e-6
    yield "equal", np.array([100.0] * 5 + [50.0] * 3 + list(np.linspace(40, 1, 20)))
    yield "low rank", np.array([10, 5, 1e-3] + [0.0] * 20)
    yield "zero", np.zeros(7)
    yield "one", np.array([3.0])


@pytest.mark.parametrize("name,values", list(spectra()))
def test_leading_pairs(name, values):
    rnd = np.random.default_rng(2)
    turn, _ = np.linalg.qr(rnd.standard_normal((len(values), len(values))))
    matrix = turn * values @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = spectrum.leading(matrix, 16)
    size = max(values.max(), 1)
    assert np.abs(found - np.linalg.eigvalsh(matrix)[::-1][: len(found)]).max() < 1e-12 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11 * size


def test_counts_are_those_of_the_eigenvalues():
    rnd = np.random.default_rng(3)
    for size in (1, 2, 3, 17):
        for _ in range(5):
            a = rnd.integers(-3, 4, (size, size)).astype(float)
            a = a + a.T
            for shift in (-2.3, 0.1, 1.7):
                assert spectrum.count_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()


def whitened(spark, rows, components=16):
    frame = spark.createDataFrame([(*r, 1, 2, "c") for r in rows], SCHEMA).repartition(3)
    codes = whitening.coded(frame)
    return [r.asDict() for r in whitening.whiten(codes, whitening.fit(codes, components)).collect()]


def test_equals_numpy_and_leaves_out_bad_rows(spark):
    rnd = np.random.default_rng(4)
    mixing = rnd.standard_normal((20, 20))
    good = [(i, (rnd.standard_normal(20) @ mixing / 4).astype(np.float32).tolist()) for i in range(80)]
    good += [(500 + i, good[7][1]) for i in range(40)] + [(None, good[3][1]), (2, good[2][1])]
    bad = [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19), (905, [1.0] * 7), (906, [3e38] * 20)]
    got = whitened(spark, good + bad)
    assert len(got) == 16 * len(good) and not {r["vec_id"] for r in got} & set(range(900, 910))
    codes = {str(v): np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 1_000_000 for _, v in good}
    fitted = np.unique(np.array(list(codes.values())), axis=0)
    n, sums = len(fitted), fitted.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fitted.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {(r["vec_id"], r["component"]): r for r in got}
    for vec_id, v in good:
        x = codes[str(v)]
        for k in range(16):
            r = by[vec_id, k + 1]
            assert r["n"] == n and int(r["deviation"]) == int(((n * x - sums) ** 2).sum())
            assert abs(abs(r["whitened"]) - abs((x - sums / n) @ vectors[:, k] / values[k] ** 0.5)) < 1e-8
            assert abs(r["explained"] - values[k] / values.sum()) < 1e-10 and r["identity_error"] < 1e-8


def test_low_rank_and_equal_vectors(spark):
    got = whitened(spark, [(1, [0.0, 1.0, 2.0]), (2, [0.0, 2.0, 4.0]), (3, [0.0, 3.0, 6.0])])
    assert len(got) == 9 and all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    assert all(r["identity_error"] < 1e-9 for r in got)
    same = whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same] == [(0, None, None, None)] * 4


def test_huge_codes_stay_exact(spark):
    rows = [(1, [1e9, 2.0]), (2, [-1e9, 4.0]), (3, [0.5, -3e15])]
    by = {r["vec_id"]: int(r["deviation"]) for r in whitened(spark, rows)}
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    assert by == {i + 1: sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}


def test_empty_table(spark):
    assert whitened(spark, []) == []
