"""Whitening against numpy's eigenvalue solver, and edge cases."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tickframe.llm import whitening
from tickframe.llm.queries import QUERIES


def brute(rows, components):
    """{vec_id: (n, deviation, whitened up to sign, explained)} by exact sums and numpy's solver."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, v in good}
    fit = sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    trace = values.sum()
    out = {}
    for i, v in x.items():
        away = np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums)])
        out[i] = (n, sum((n * a - s) ** 2 for a, s in zip(v, sums)), away @ vectors[:, order] / np.sqrt(values[order]), values[order] / trace)
    return out


def test_query_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    want = brute([(r["vec_id"], r["embedding"]) for r in table], 16)
    found = QUERIES["op11_whitening"](spark, SF).collect()
    assert len(found) == 16 * len(table) and {r["n"] for r in found} == {next(iter(want.values()))[0]}
    sign = {}
    for r in found:
        n, deviation, whitened, explained = want[r["vec_id"]]
        k = r["component"] - 1
        assert r["deviation"] == deviation
        assert abs(r["explained"] / explained[k] - 1) < 1e-9 and r["identity_error"] < 1e-9
        if abs(whitened[k]) > 1e-6:
            assert sign.setdefault(k, np.sign(r["whitened"] * whitened[k])) == np.sign(r["whitened"] * whitened[k])
        assert abs(abs(r["whitened"]) - abs(whitened[k])) < 1e-6


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 0.25, -1.0]), (2, [0.5, 0.25, -1.0]), (3, [1.0, -2.0, 0.0]), (4, None), (5, []), (6, [1.0, None, 2.0]), (7, [nan, 0.0, 0.0]), (8, [0.0, -inf, 0.0]), (9, [1.0, 2.0]), (None, [2.0, 1.0, 0.5]), (10, [1e300, 0.0, 0.0]), (3, [1.0, -2.0, 0.0]), (11, [3.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("mine")).withColumn("n", F.lit("mine")).withColumn("component", F.lit(0))
    found = whitening.whiten(df).collect()
    ids = sorted((r["vec_id"] or 0, r["component"]) for r in found)
    assert ids == sorted((i, k) for i in (1, 2, 3, 3, 0, 11) for k in (1, 2, 3))  # four distinct vectors span three dimensions
    assert {r["n"] for r in found} == {4} and max(r["identity_error"] for r in found) < 1e-9
    twins = {(r["component"], r["whitened"]) for r in found if r["vec_id"] in (1, 2)}
    assert len(twins) == 3
    for r in found:
        x = {1: (32, 16, -64), 2: (32, 16, -64), 3: (64, -128, 0), 11: (192, 64, 64)}.get(r["vec_id"], (128, 64, 32))
        assert r["deviation"] == sum((4 * a - s) ** 2 for a, s in zip(x, (416, 16, 32)))
    assert whitening.whiten(df, components=2).count() == 12
    assert whitening.whiten(df.where("false")).count() == 0
    assert whitening.whiten(df.where("vec_id IN (1, 2, 4, 5)")).count() == 0  # one distinct vector has no spread
    assert [r["component"] for r in whitening.whiten(df.where("vec_id IN (1, 11)")).orderBy("component").collect()] == [1, 1]


def test_floats_and_deviations_past_64_bits(spark):
    df = spark.createDataFrame([(1, [2.0**40, 0.5]), (2, [0.0, 0.25]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    found = {(r["vec_id"], r["component"]): r for r in whitening.whiten(df).collect()}
    assert found[1, 1]["deviation"] is None and found[1, 1]["n"] == 3
    small = spark.createDataFrame([(1, [0.015624]), (2, [-0.0001]), (3, [0.0])], "vec_id long, embedding array<float>")
    assert {(r["vec_id"], r["deviation"]) for r in whitening.whiten(small).collect()} == {(1, 1), (2, 1), (3, 1)}  # 0, -1, 0: two distinct


@pytest.mark.parametrize("seed", range(12))
def test_contours_find_every_pair(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 60))
    values = [r.uniform(0, 1, n), 10 ** r.uniform(-9, 0, n), r.choice([1, 0.5, 0.25, 0], n), 1 + 10 ** r.uniform(-12, -3, n)][seed % 4]
    basis = np.linalg.qr(r.standard_normal((n, n)))[0]
    matrix = (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    matrix /= max(np.abs(matrix).sum(1).max(), 1e-300)
    want = np.linalg.eigvalsh(matrix)[::-1]
    inertia = whitening.Inertia(matrix)
    gaps = [(a + b) / 2 for a, b in zip(want, want[1:]) if a - b > 1e-12]
    assert inertia.above(np.array([*gaps, 2.0, -1.0])).tolist() == [int((want > g).sum()) for g in gaps] + [0, n]
    slices = whitening.spectrum_slices(inertia, whitening.NOISE * n, 1.0 + 1e-6, 16)
    found = [whitening.contour_pairs(matrix, *s) for s in slices]
    got = np.sort(np.concatenate([f[0] for f in found] or [np.zeros(0)]))[::-1]
    assert len(got) >= min(16, int((want > whitening.NOISE * n).sum())) and np.allclose(got, want[: len(got)], atol=1e-14, rtol=0)
    for pair_values, vectors in found:
        assert np.abs(matrix @ vectors - vectors * pair_values).max() < 1e-13


def test_a_wrong_count_is_an_error():
    with pytest.raises(ArithmeticError):
        whitening.contour_pairs(np.diag([1.0, 0.5, 0.1]), 0.4, 0.6, 2)
