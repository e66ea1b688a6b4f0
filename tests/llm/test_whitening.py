import math

import numpy as np
import pytest

from chunklake.llm import queries
from chunklake.llm.whitening import bidiagonalised, components_of, reduced_triangle, singular_values, triangle, whiten

NEEDED = "vec_id bigint, embedding array<float>"


def orthogonal(rng, n):
    return np.linalg.qr(rng.normal(size=(n, n)))[0]


def matrices():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 17, 64):
        yield f"random {n}", rng.normal(size=(5 * n + 2, n))
    q = orthogonal(rng, 48)
    yield "rank 20 of 48", rng.normal(size=(20, 48))
    yield "all equal", q
    yield "groups of equals", q * np.repeat([5.0, 4, 3], 16)
    yield "equals and zeros", q * np.repeat([5.0, 3, 0], 16)
    yield "graded", np.diag(np.logspace(0, -14, 48)) @ q
    yield "tight", q * (1 + 1e-9 * rng.normal(size=48))
    yield "zeros on the diagonal", np.diag([1.0, 0, 2, 0, 3]) + np.diag([1.0, 2, 3, 4], 1)
    yield "nothing", np.zeros((4, 4))
    yield "pairs of close values", np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)


@pytest.mark.parametrize(("name", "rows"), list(matrices()))
def test_solver(name, rows):
    r = triangle(rows)
    diagonal, above, v = bidiagonalised(r)
    np.testing.assert_allclose(v.T @ v, np.eye(len(v)), atol=1e-13)
    true = np.linalg.svd(rows, compute_uv=False)
    true = np.append(true, np.zeros(len(r) - len(true)))
    top = true[0] or 1.0
    np.testing.assert_allclose(singular_values(diagonal, above), true, atol=1e-14 * top * len(true))
    found, values, squares = components_of(r, 16)
    count = min(16, int((true > len(true) * 1e-15 * true[0]).sum()))
    assert found.shape == (len(r), count)
    assert squares == pytest.approx((true**2).sum())
    np.testing.assert_allclose(found.T @ found, np.eye(count), atol=1e-11)
    np.testing.assert_allclose(rows.T @ (rows @ found), found * values**2, atol=1e-12 * top**2)


def test_dqds_keeps_small_values_relatively_exact():
    # singular values of a bidiagonal matrix are known to high relative accuracy, however small; 3 x 3 with a known determinant
    diagonal, above = np.array([1.0, 1e-8, 1.0]), np.array([1e-3, 1e-12])
    values = singular_values(diagonal, above)
    assert math.prod(values.tolist()) == pytest.approx(1e-8, rel=1e-13)


def grid(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def expected(vectors, most=16):
    """By the definition: covariance over distinct vectors and a dense symmetric solver."""
    rows = grid(vectors)
    fit = [list(r) for r in sorted({tuple(r) for r in rows})]
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    means = np.array([s / n for s in sums])
    centred = np.array(fit) - means
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    count = min(most, int((e > 1e-9 * e[0]).sum())) if n > 1 else 0
    white = (np.array(rows) - means) @ v[:, :count] / np.sqrt(e[:count])
    deviation = [sum((n * x - s) ** 2 for x, s in zip(r, sums, strict=True)) for r in rows]
    return n, deviation, white, e[:count] / e.sum()


def compare(found, ids, vectors):
    n, deviation, white, explained = expected(vectors)
    count = white.shape[1]
    assert len(found) == len(ids) * count
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    for k in range(count):
        own = np.array([by[i][k + 1]["whitened"] for i in ids])
        sign = np.sign(own @ white[:, k])
        np.testing.assert_allclose(own * sign, white[:, k], atol=1e-7)
    for i, d in zip(ids, deviation, strict=True):
        assert {(r["n"], r["deviation"]) for r in by[i].values()} == {(n, d)}
        np.testing.assert_allclose([by[i][k + 1]["explained"] for k in range(count)], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in found}) == 1
    assert found[0]["identity_error"] < 1e-10


def test_query_equals_dense_solver(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(400, 24)) * np.linspace(0.5, 2, 24)).astype(np.float32).tolist()
    vectors += vectors[:30] + [vectors[5]] * 150
    odd = [None, [None] + [0.0] * 23, [float("nan")] + [0.0] * 23, [float("-inf")] + [0.0] * 23, [1.0, 2.0], []]
    rows = [(n, v, 1) for n, v in enumerate(vectors)] + [(1000 + n, v, 2) for n, v in enumerate(odd)]
    spark.createDataFrame(rows, NEEDED + ", label int").repartition(6).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = queries.op12_whitening(spark, str(tmp_path))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(found.collect(), list(range(len(vectors))), vectors)


def test_fewer_dimensions_than_components_and_clashing_names(spark):
    rng = np.random.default_rng(4)
    vectors = [[float(a), float(b), float(a) + float(b)] for a, b in rng.integers(-3, 3, size=(40, 2))]
    frame = spark.createDataFrame([(n, v, "q", n) for n, v in enumerate(vectors)], NEEDED + ", x string, Component int")
    found = whiten(frame)
    assert found.columns == ["vec_id", "x", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(found.collect(), list(range(40)), vectors)  # the third direction has no variance


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], NEEDED)
    assert whiten(empty).collect() == []
    assert whiten(spark.createDataFrame([(1, None), (2, [])], NEEDED)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], NEEDED)).collect() == []


def test_deviation_is_exact_or_null(spark):
    frame = spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 2.0]), (3, [0.0, 2.0])], "vec_id bigint, embedding array<double>")
    found = {r["vec_id"]: r["deviation"] for r in whiten(frame).collect()}
    assert found[1] is None  # (3 x 64e9)^2 has 75 bits
    assert found[3] == (3 * 0 - 0) ** 2 + (3 * 128 - 192) ** 2


def test_triangles_join_in_rounds(spark):
    rng = np.random.default_rng(5)
    rows = rng.integers(-50, 50, size=(300, 8))
    means = rows.mean(0)
    fit = spark.createDataFrame([(r,) for r in rows.tolist()], "x array<bigint>").repartition(12)
    r = reduced_triangle(fit, rows.sum(0).tolist(), 300, joined=3)
    np.testing.assert_allclose(r.T @ r, (rows - means).T @ (rows - means), rtol=1e-9, atol=1e-6)
