"""Whitening of embeddings: principal components of the exact covariance, refined from single to double precision.

Components become integers, x = floor(1024 * c) + 100000. Sums and centred second moments are folded as whole numbers
(every task sends one row per pair of dimensions), so the covariance does not depend on how rows are dealt out. The
moments are taken about the rounded mean; what rounding leaves is put right exactly.

The eigenvectors are found in single precision and corrected by the matrix-multiplication iteration of Ogita and Aishima
in extended precision: with R = I - X'X and S = X'AX, eigenvalues are s_ii / (1 - r_ii), and X moves by X E, where
e_ij = (s_ij + l_j r_ij) / (l_j - l_i). Where eigenvalues are as close as the error still is, that quotient says nothing:
e_ij = r_ij / 2 only makes the vectors orthogonal, and the subspace of the cluster is solved by itself, shifted by the
cluster's mean, before the next round. Only the covariance (d x d numbers, whatever the number of rows) is on the driver.

Edge cases: a row takes no part if its vector is null, empty, or holds a null or non-finite entry. Vectors have one
length; those of another length than most (the longer of two equally frequent ones) take no part. |1024 c| stops at
2**60; a deviation of more than 38 digits is null. Repeated rows and null ids are rows like others. Without rows, nothing
is returned. Components without variance (fewer distinct rows than dimensions) have whitened 0 and explained 0 and are
left out of identity_error. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import written

SCALE = 1024
OFFSET = 100_000
FARTHEST = 2.0 ** 60
ROUNDS = 40
LIMB = 62
FINEST = float(np.finfo(np.longdouble).eps)


def whole_numbers(column: pa.Array, n: int, dim: int) -> np.ndarray:
    v = np.asarray(column.flatten()).reshape(n, dim)
    return np.clip(np.floor(SCALE * v), -FARTHEST, FARTHEST).astype(np.int64) + OFFSET


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): rows whose vector has an entry and only finite ones."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    slim = rows.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return slim.filter((F.size("v") > 0) & ~bad)


class Whole:
    """Whole numbers of any size added up in two 64-bit parts."""

    def __init__(self, shape: tuple[int, ...]):
        self.high, self.low = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        self.rest = None

    def add(self, x: np.ndarray) -> None:
        if x.dtype == object:
            self.rest = x if self.rest is None else self.rest + x
        else:
            self.high += x >> 32
            self.low += x & 0xFFFFFFFF

    def value(self) -> np.ndarray:
        out = (self.high.astype(object) << 32) + self.low.astype(object)
        return out if self.rest is None else out + self.rest


def folded(rows: DataFrame, dim: int, width: int, part: Callable[[np.ndarray, Whole], None]) -> dict[tuple[int, int], int]:
    """Sums over all rows of the matrix that `part` adds up in a task: (i, j) -> value, for a matrix of dim x width.

    A value travels as value = high * 2**62 + low, so that no sum of decimals overflows.
    """
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = Whole((dim, width)), False
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                piece = batch.slice(i, 4096)
                part(whole_numbers(piece.column(0), piece.num_rows, dim), total)
                seen = True
        if seen:
            i, j = np.triu_indices(dim) if width > 1 else (np.arange(dim), np.zeros(dim, int))
            v = total.value()[i, j]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array([Decimal(x >> LIMB) for x in v], pa.decimal128(38, 0)),
                 pa.array([Decimal(x & ((1 << LIMB) - 1)) for x in v], pa.decimal128(38, 0))], ["i", "j", "high", "low"])

    partial = rows.select("v").mapInArrow(fold, "i int, j int, high decimal(38,0), low decimal(38,0)")
    sums = partial.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r.i, r.j): (int(r.high) << LIMB) + int(r.low) for r in sums.collect()}


def sums_part(x: np.ndarray, total: Whole) -> None:
    total.high += (x >> 32).sum(axis=0)[:, None]
    total.low += (x & 0xFFFFFFFF).sum(axis=0)[:, None]


def moments_part(mean: np.ndarray) -> Callable[[np.ndarray, Whole], None]:
    """Adds y'y with y = x - mean; sums of products of small numbers are exact in doubles."""

    def part(x: np.ndarray, total: Whole) -> None:
        y = x - mean
        wide = np.abs(y).max(axis=1) >= 1 << 20
        small = y[~wide].astype(np.float64)
        if len(small):  # 4096 rows of products below 2**40
            total.add((small.T @ small).astype(np.int64))
        if wide.any():
            big = y[wide].astype(object)
            total.add(big.T @ big)

    return part


def extended(top: int, bottom: int) -> np.longdouble:
    with localcontext() as context:
        context.prec = 40
        return np.longdouble(str(Decimal(top) / Decimal(bottom)))


def clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Places of eigenvalues that are linked by steps of at most `near`."""
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, cut) if len(c) > 1]


def orthogonal(x: np.ndarray) -> np.ndarray:
    """Nearly orthogonal columns made orthogonal (one Newton step, which squares the error)."""
    return x + x @ (np.eye(len(x), dtype=np.longdouble) - x.T @ x) / 2


def refined(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix in extended precision."""
    d = len(a)
    size = np.abs(a).max() if d else 0
    if not size:
        return np.zeros(d, np.longdouble), np.eye(d, dtype=np.longdouble)
    a = a / size
    eye = np.eye(d, dtype=np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm = np.sqrt((a * a).sum())
    before = np.inf
    for _ in range(ROUNDS):
        r = eye - x.T @ x
        ax = a @ x
        s = x.T @ ax
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        # the error that is left: of the directions, and of the lengths and angles
        left = np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum())
        near = 2 * left
        gap = values[None, :] - values[:, None]
        close = np.abs(gap) <= near
        e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
        x = x + x @ e
        for c in clusters(values, near):
            own = x[:, c]
            shift = values[c].mean()
            inner = own.T @ (a @ own) - shift * (own.T @ own)
            turn = np.linalg.eigh(((inner + inner.T) / 2).astype(np.float64))[1].astype(np.longdouble)
            x[:, c] = own @ orthogonal(turn)
        if left <= 4 * d * FINEST or left >= before and left <= 1e-13 * d:
            break
        before = left
    x = orthogonal(x)
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


@dataclass(frozen=True)
class Fit:
    """n rows with mean `centre` + `rest` / n; variances and unit vectors by falling variance."""

    n: int
    centre: np.ndarray
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def fit(rows: DataFrame, dim: int, n: int) -> Fit:
    sums = folded(rows, dim, 1, sums_part)
    s = [sums[i, 0] for i in range(dim)]
    centre = [(2 * t + n) // (2 * n) for t in s]
    rest = [t - n * c for t, c in zip(s, centre)]
    squares = folded(rows, dim, dim, moments_part(np.array(centre, np.int64)))
    cov = np.zeros((dim, dim), np.longdouble)
    for (i, j), v in squares.items():
        cov[i, j] = cov[j, i] = extended(n * v - rest[i] * rest[j], n * n)
    values, vectors = refined(cov)
    flat = values <= np.abs(values).max(initial=0) * dim * 1e-15
    values = np.where(flat, 0, values)
    return Fit(n, np.array(centre, np.int64), rest, values.astype(np.float64), vectors.astype(np.float64), float(np.trace(cov)))


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """Sums of (n y - rest)^2 over the dimensions, exact."""
    r = np.array(rest, object)
    most = int(np.abs(y).max(initial=0))
    fits = len(rest) * max(most, max(map(abs, rest), default=0), 1) * max(most, 1) < 1 << 62
    w, r64 = (y, np.array(rest, np.int64)) if fits else (y.astype(object), r)
    squares, mixed, own = (w * w).sum(axis=1), (w * r64).sum(axis=1), int((r * r).sum())
    return [n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares, mixed)]


def whiten(rows: DataFrame, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, component (from 1), n, deviation (decimal), whitened, explained, identity_error, for up to k components."""
    spark = rows.sparkSession
    valid = usable(rows, id_col, vec_col)
    kind = valid.schema["id"].dataType.simpleString()
    shape = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    lengths = valid.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.col("n").desc(), F.col("dim").desc()).first()
    if most is None:
        return spark.createDataFrame([], shape)
    valid = valid.filter(F.size("v") == most.dim)
    model = fit(valid, most.dim, most.n)
    k = min(k, most.dim)
    sent = spark.sparkContext.broadcast(vars(model))  # arrays; the class comes with the task

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Fit(**sent.value)
        scale = np.where(m.values[:k] > 0, m.values[:k], np.inf) ** -0.5
        turn = m.vectors[:, :k] * scale
        mean = np.array([x / m.n for x in m.rest])
        for batch in batches:
            y = whole_numbers(batch.column(1), batch.num_rows, len(mean)) - m.centre
            w = (y - mean) @ turn
            far = pa.array([Decimal(x) if x < 10 ** 38 else None for x in deviations(y, m.n, m.rest)], pa.decimal128(38, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * k, pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), far, lists], ["id", "deviation", "w"])

    # rows are read again for the check below and for the result, so they are kept
    done = written(valid.mapInArrow(project, f"id {kind}, deviation decimal(38,0), w array<double>"), "whitened")
    live = [i for i in range(k) if model.values[i] > 0]
    pairs = [(i, j) for i in live for j in live if i <= j]
    error = 0.0
    if pairs:
        got = done.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for (i, j), c in zip(pairs, got))
    explained = [float(model.values[i] / model.trace) if model.trace else 0.0 for i in range(k)]
    out = done.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        "id", (F.col("at") + 1).cast("int").alias("component"), F.lit(most.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*map(F.lit, explained)), F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
