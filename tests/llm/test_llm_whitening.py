"""Whitening against dense linear algebra on the whole table."""

import math
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF_DIR
from tabularium.llm import refined_whitening as rw
from tabularium.llm.queries import QUERIES


def integers(rows):
    return [[math.floor(1024 * c) + 100_000 for c in v] for v in rows]


def held_against(got, rows, ids):
    """`got` rows of the operator for vectors `rows`, whose ids are distinct."""
    x = integers(rows)
    n, d = len(x), len(x[0])
    s = [sum(col) for col in zip(*x)]
    y = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(r, s)] for r in x])
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    by = {(r.id, r.component): r for r in got}
    k = min(8, d)
    assert len(got) == len(by) == n * k
    for i, (key, v) in enumerate(zip(ids, x)):
        assert by[key, 1].deviation == sum((n * a - b) ** 2 for a, b in zip(v, s))
        assert by[key, 1].n == n
    w = np.array([[by[i, c + 1].whitened for c in range(k)] for i in ids])
    for c in range(k):
        want = y @ vectors[:, c] / math.sqrt(values[c])
        if min(abs(values[c] - np.delete(values, c))) > 1e-6 * values[0]:
            assert min(np.abs(w[:, c] - want).max(), np.abs(w[:, c] + want).max()) < 1e-9 * (1 + np.abs(want).max())
        assert math.isclose(by[ids[0], c + 1].explained, values[c] / np.trace(cov), rel_tol=1e-9)
    centred = w - w.mean(0)
    error = np.abs(centred.T @ centred / n - np.eye(k)).max()
    assert error < 1e-9 and {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    got = QUERIES["op12_refined_whitening"](spark, SF_DIR)
    assert dict(got.dtypes)["deviation"] == "bigint" and dict(got.dtypes)["component"] == "int"
    held_against(got.withColumnRenamed("vec_id", "id").collect(), [list(r.embedding) for r in rows], [r.vec_id for r in rows])


def test_edges(spark):
    rng = np.random.default_rng(4)
    good = rng.normal(size=(120, 5)) * [1, 0.5, 0.5, 0.2, 3]
    rows = [(i, v.tolist()) for i, v in enumerate(good)]
    bad = [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0]), (502, [math.nan] * 5), (503, [1.0] * 4 + [-math.inf]), (504, []), (505, [1.0, 2.0])]
    shape = "vec_id long, embedding array<double>, n string"
    frame = spark.createDataFrame([(*r, "x") for r in rows + bad], shape)
    held_against(rw.whiten(frame.repartition(7)).collect(), good.tolist(), list(range(120)))
    assert rw.whiten(frame.limit(0)).collect() == rw.whiten(spark.createDataFrame([(*r, "") for r in bad[:5]], shape)).collect() == []

    # repeated rows and null ids stay; directions without variance are nought
    flat = spark.createDataFrame([(1, [0.5, 1.0, 2.0], ""), (1, [0.5, 1.0, 2.0], ""), (None, [0.25, 1.0, 2.0], "")], shape)
    got = rw.whiten(flat).collect()
    assert len(got) == 9 and [r.id for r in got].count(None) == 3 and all(r.n == 3 for r in got)
    assert all(r.whitened == 0 and r.explained == 0 for r in got if r.component > 1)
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-9 for r in got if r.component == 1)
    one = rw.whiten(flat.filter("vec_id IS NULL")).collect()
    assert [(r.deviation, r.whitened, r.identity_error) for r in one] == [(0, 0, 0)] * 3

    # entries far apart: sums stay exact
    far = [[1e15, 1.0], [-1e15, 2.0], [5e14, -7.0], [3e9, 0.5], [12.0, 0.25]]
    got = rw.whiten(spark.createDataFrame([(i, v, "") for i, v in enumerate(far)], shape)).collect()
    x = integers(far)
    s = [sum(c) for c in zip(*x)]
    assert {(r.id, int(r.deviation)) for r in got} == {(i, sum((5 * a - b) ** 2 for a, b in zip(v, s))) for i, v in enumerate(x)}
    assert rw.whiten(spark.createDataFrame([(1, [1e300], ""), (2, [-1e300], "")], shape)).count() == 2


@pytest.mark.parametrize("values", [
    [9, 5, 3, 1], [4, 4, 4, 1], [1, 1, 1, 1], [1e6, 1e6 * (1 + 1e-9), 1e6 * (1 - 1e-9), 1], [8, 4 + 1e-12, 4, 4 - 1e-12, 1e-9],
    [0, 0, 0], [5, 0, 0], list(np.linspace(1, 1.001, 40)) + [7.0]])
def test_refined_reaches_double_precision(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal in extended precision
        q = q @ (1.5 * np.eye(d) - 0.5 * (q.T @ q))
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    e, x = rw.refined(a)
    size = max(values) or 1
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-17 * d + 1e-18
    assert np.abs(a @ x - x * e).max() < 1e-16 * size
    assert np.abs(e - np.sort(np.array(values, float))[::-1]).max() < 1e-15 * size
    assert (np.diff(e) <= 0).all()


def test_single_precision_alone_is_not_enough():
    rng = np.random.default_rng(3)
    b = rng.normal(size=(64, 64))
    a = (b @ b.T).astype(np.longdouble)
    single = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    rough = single.T @ (a @ single)
    e, x = rw.refined(a)
    off = lambda m: np.abs(m - np.diag(np.diag(m))).max()
    assert off(rough) > 1e-6 and off(x.T @ (a @ x)) < 1e-14
