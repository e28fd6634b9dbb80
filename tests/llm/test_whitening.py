"""Whitening against a dense eigensolver, and the eigensolver against hard matrices."""

from __future__ import annotations

import math

import numpy as np
import pytest
from loanmill.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vector):
    return bool(vector) and all(c is not None and math.isfinite(c) for c in vector)


def expected(rows, components=16):
    """Per row of a usable vector: (id, exact deviation, whitened components), and n, the shares explained."""
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if usable(v)]
    fit_list = sorted({tuple(v) for _, v in x})
    n, sums = len(fit_list), [sum(column) for column in zip(*fit_list)]
    mean = np.array([s / n for s in sums])
    y = np.array(fit_list, float) - mean
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    white = [(np.array(v, float) - mean) @ vectors / np.sqrt(values) for _, v in x]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for _, v in x]
    return [(i, d, w) for (i, _), d, w in zip(x, deviation, white)], n, values / np.trace(y.T @ y / n)


def by_row(frame):
    out = {}
    for r in frame.collect():
        out.setdefault((r.vec_id, r.deviation), []).append(r)
    return {k: sorted(v, key=lambda r: r.component) for k, v in out.items()}


def test_whitened_rows_match_a_dense_solver(spark):
    source = np.random.default_rng(3)
    base = source.normal(size=(400, 20)) @ np.diag(np.linspace(4, 0.5, 20))
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(base)]
    rows += [(1_000 + k, rows[0][1]) for k in range(300)]  # copies: they do not weigh in the fit
    bad = [(2_000, None), (2_001, []), (2_002, [None] * 20), (2_003, [float("nan")] * 20), (2_004, [math.inf] + [0.0] * 19), (2_005, [1.0] * 7)]
    got = by_row(wh.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows + bad], SCHEMA)))
    want, n, shares = expected(rows)
    assert len(got) == len({i for i, _ in rows})
    signs = None
    for i, deviation, white in want:
        found = got[i, deviation]
        assert [r.component for r in found] == list(range(1, 17)) and all(r.n == n for r in found)
        values = np.array([r.whitened for r in found])
        signs = np.sign(values * white) if signs is None else signs
        assert values == pytest.approx(signs * white, abs=1e-7)
        assert [r.explained for r in found] == pytest.approx(shares.tolist(), rel=1e-9)
        assert found[0].identity_error < 1e-9


def test_query_on_the_given_embeddings(spark):
    got = by_row(wh.op12_whitening(spark, "/root/testdata/sf0.001"))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    want, n, shares = expected(rows)
    first = np.array([[r.whitened for r in got[i, d]] for i, d, _ in want])
    white = np.array([w for _, _, w in want])
    assert np.abs(first) == pytest.approx(np.abs(white), abs=1e-6)
    assert {r.n for rows in got.values() for r in rows} == {n} and max(r.identity_error for r in got[want[0][:2]]) < 1e-9


@pytest.mark.parametrize(
    "values",
    [
        [5, 5, 5, 5, 1, 1, 1, 0, 0], [3] * 8, [1 + 1e-9 * k for k in range(12)], [1e8, 1, 1e-3, 1e-4], [7], [2, 2], [0.0, 0.0, 0.0],
        list(range(40, 0, -1)),
    ],
)
def test_eigensolver_with_close_equal_and_absent_values(values):
    source = np.random.default_rng(len(values))
    basis, _ = np.linalg.qr(source.normal(size=(len(values), len(values))))
    matrix = (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = wh.leading(matrix, 16)
    top = np.sort(values)[::-1][:16]
    top = top[top > 1e-10]
    assert found == pytest.approx(top, abs=1e-12 * max(top, default=1))
    assert vectors.T @ vectors == pytest.approx(np.eye(len(found)), abs=1e-11)
    assert matrix @ vectors == pytest.approx(vectors * found, abs=1e-11 * max(top, default=1))


def test_matrices_that_fall_apart():
    matrix = np.zeros((9, 9))
    matrix[:3, :3] = [[2, 1, 0], [1, 2, 1], [0, 1, 2]]
    matrix[3:6, 3:6] = matrix[:3, :3]
    matrix[6:, 6:] = np.diag([2, 2, 9])
    found, vectors = wh.leading(matrix, 9)
    assert found == pytest.approx(np.sort(np.linalg.eigvalsh(matrix))[::-1], abs=1e-13)
    assert vectors.T @ vectors == pytest.approx(np.eye(9), abs=1e-12)
    assert matrix @ vectors == pytest.approx(vectors * found, abs=1e-11)


def test_edge_tables(spark):
    def rows(*vectors):
        return wh.whiten(spark.createDataFrame([(k, v, None) for k, v in enumerate(vectors)], SCHEMA)).collect()

    assert rows() == [] and rows(None, []) == [] and rows([1.0, 2.0], [1.0, 2.0]) == []
    two = rows([0.0, 0.0, 5.0], [1.0, 0.0, 5.0], [1.0, 0.0, 5.0])  # one direction with spread
    assert [(r.vec_id, r.component, r.n, r.deviation, r.explained) for r in two] == [(k, 1, 2, 64 * 64, 1.0) for k in range(3)]
    assert sorted(abs(r.whitened) for r in two) == pytest.approx([1, 1, 1])
    far = rows([1e11, 0.0], [-1e11, 1.0], [3.0, 3.0])  # squares beyond a long
    assert {r.deviation for r in far if r.vec_id < 2} == {None} and len(far) == 3  # the second direction drowns in rounding
    assert rows([1e30, 1.0], [2.0, 1.0], [3.0, 1.0])[0].n == 2


def test_clashing_columns_and_null_ids(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (4, [2.0, 5.0], 1), (5, [4.0, 3.0], 1)], SCHEMA)
    frame = frame.withColumns({c: F.lit("clash") for c in ("id", "x", "n", "vector", "component", "whitened")})
    out = wh.whiten(frame)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert sorted((r.vec_id or 0, r.component, r.n) for r in out.collect()) == [(0, 1, 3)] * 2 + [(0, 2, 3)] * 2 + [(4, 1, 3), (4, 2, 3), (5, 1, 3), (5, 2, 3)]
