import math
from fractions import Fraction

import numpy as np
import pytest

from tidemart.llm import whitening
from tidemart.llm.spectrum import Spectrum, rank_one

SCHEMA = "vec_id long, embedding array<double>"


def whole(vector):
    """The vector on the grid, or None where it takes no part."""
    if not vector or any(c is None or not math.isfinite(c) or abs(c) >= 2.0**55 for c in vector):
        return None
    return tuple(math.floor(Fraction(c) * 256) for c in vector)


def check(df, rows, components=4):
    got = whitening.whiten(df, components).collect()
    kept = [(i, whole(v)) for i, v in rows]
    kept = [(i, x) for i, x in kept if x is not None]
    fit = sorted({x for _, x in kept})
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(dim)]
    centre = lambda x: np.array([float(Fraction(x[j]) - Fraction(sums[j], n)) for j in range(dim)])
    centred = np.array([centre(x) for x in fit])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == k * len(kept)
    want = sorted((str(i), c + 1, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept for c in range(k))
    assert sorted((str(r.vec_id), r.component, int(r.deviation)) for r in got) == want
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    of = {(i, x) for i, x in kept}
    for c in range(k):
        ours = {r.vec_id: r for r in got if r.component == c + 1}
        np.testing.assert_allclose([r.explained for r in ours.values()], values[c] / values.sum(), rtol=1e-10)
        if len({i for i, _ in of}) != len(of) or None in ours:
            continue
        ids = [i for i, _ in of]
        projected = np.array([centre(x) for _, x in of]) @ axes[:, c] / math.sqrt(values[c])
        found = np.array([ours[i].whitened for i in ids])
        sign = np.sign(projected @ found)
        np.testing.assert_allclose(found, sign * projected, atol=1e-7)
    return got


def test_test_table(stored):
    df = stored("embeddings", "/root/testdata/sf0.01")
    check(df.repartition(3), [(r.vec_id, r.embedding) for r in df.collect()])


def test_many_tasks_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "TASK_ROWS", 7)
    monkeypatch.setattr(whitening, "FAN", 3)
    draw = np.random.default_rng(5)
    rows = [(i, [float(c) for c in draw.normal(size=6) * range(1, 7) + 40]) for i in range(150)]
    rows += [(150 + i, rows[0][1]) for i in range(100)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(4), rows)


def test_edge_cases(spark):
    odd = [(None, [1.0, 2.0, 0.5]), (7, None), (8, []), (9, [1.0, None, 2.0]), (10, [math.nan, 1.0, 1.0])]
    odd += [(11, [math.inf, 0.0, 0.0]), (12, [1.0, 2.0]), (13, [2.0**60, 0.0, 0.0])]
    plain = [(1, [0.0, 0.0, 0.0]), (1, [0.0, 0.0, 0.0]), (2, [-0.001, 3.0, 1.0]), (3, [5.0, -2.0, 1.0]), (4, [9.0, 1.0, 0.0])]
    df = spark.createDataFrame([*odd, *plain], SCHEMA).selectExpr("*", "1 as x", "2 as n", "3 as dim")
    got = check(df, [r for r in [*odd, *plain] if r[0] != 12])
    assert {r.vec_id for r in got} == {None, 1, 2, 3, 4}


def test_large_entries_stay_exact(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(c) for c in 1e13 + draw.normal(size=3) * [1, 5, 20]]) for i in range(40)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_varies(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.count() == 0 and found.columns[:3] == ["vec_id", "component", "n"]


@pytest.mark.parametrize("kind", ["plain", "whole", "few", "flat", "far"])
def test_updates_keep_the_eigensystem(kind):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 12)) * np.linspace(0.01, 4, 12)
    x = {"plain": x, "whole": np.floor(x * 3), "few": x[draw.integers(0, 4, 300)], "far": x + 1e6}.get(kind, x)
    if kind == "flat":
        x[:, 3:] = 2.0
    want = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    one, two = Spectrum.empty(12), Spectrum.empty(12)
    for i, row in enumerate(x):
        (one if i < 90 else two).add(row)
    one.merge(two)
    assert one.n == 300
    np.testing.assert_allclose(one.mean, x.mean(axis=0), rtol=1e-12)
    np.testing.assert_allclose(one.vectors.T @ one.vectors, np.eye(12), atol=1e-12)
    scale = np.linalg.norm(want)
    np.testing.assert_allclose(one.vectors @ np.diag(one.values) @ one.vectors.T, want, atol=1e-12 * scale + 1e-9 * (kind == "far"))


def test_update_without_a_direction():
    values, vectors = np.array([1.0, 1.0, 2.0]), np.eye(3)
    same = rank_one(values, vectors, np.zeros(3))
    assert same[0] is values
    found, axes = rank_one(values, vectors, np.array([1.0, 1.0, 0.0]))
    np.testing.assert_allclose(found, [1, 2, 3], atol=1e-14)
    np.testing.assert_allclose(axes @ np.diag(found) @ axes.T, np.diag([1.0, 1, 2]) + np.outer([1, 1, 0], [1, 1, 0]), atol=1e-14)
