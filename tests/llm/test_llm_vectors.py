"""Exact top-k against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_DIR
from tabularium.llm import pivot_topk
from tabularium.llm.queries import QUERIES


def brute(rows, asked, k=5):
    valid = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        valid.append((i, [math.floor(256 * x) for x in v]))
    out = set()
    for q, v in valid:
        if asked(q):
            scores = {(-sum(a * b for a, b in zip(v, w)), i) for i, w in valid if i != q and len(w) == len(v)}
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])}
    return out


def rows_of(frame):
    return {(r.query_id, r["rank"], r[2], r.score) for r in frame.collect()}


def test_whole_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert rows_of(QUERIES["op2_pivot_topk"](spark, SF_DIR)) == brute(rows, lambda i: i % 50 == 0)


def test_edges(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 6) for i in range(40)]  # ties
    rows += [(300, None), (301, [0.1, None] * 3), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [0.1] * 6),
             (304, [0.25] * 3), (305, [0.5] * 3), (306, []), rows[0], rows[0], (1000, [0.5] * 6)]
    frame = spark.createDataFrame([(a, b, "x") for a, b in rows], "vec_id long, embedding array<double>, rank string")
    got = pivot_topk.search(frame, F.col("id") % 10 == 0)
    once = [r for i, r in enumerate(rows) if r not in rows[:i]]
    assert rows_of(got) == brute(once, lambda i: i % 10 == 0)
    assert pivot_topk.search(frame.limit(0), F.col("id") % 10 == 0).collect() == []
    few = frame.filter("vec_id IN (304, 305)")
    assert rows_of(pivot_topk.search(few, F.lit(True))) == brute([(304, [0.25] * 3), (305, [0.5] * 3)], lambda i: True)


def test_bound_order_stops_exactly():
    rng = np.random.default_rng(1)
    x = rng.integers(-20, 20, (500, 4)).astype(float)
    ids, q = np.arange(500), x[7]
    pivots = pivot_topk.spread(x, 8)
    apart = np.abs(pivot_topk.distances(x, pivots) - pivot_topk.distances(q[None], pivots)).max(1)
    bound = ((q @ q) + (x * x).sum(1) - np.maximum(apart - 1e-6, 0) ** 2) / 2 + 1e-3
    assert (bound >= x @ q).all()
    got, score = pivot_topk.best_of(q, 7, ids, x, bound, -np.inf, 5, step=16)
    want = sorted((-float(s), i) for i, s in enumerate(x @ q) if i != 7)[:5]
    assert list(zip(-score, got)) == want


def test_large_components(spark):
    """Vectors of any finite size take part, as queries and as candidates, with exact scores."""
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(80)]
    rows += [(100 + i, [rng.choice([1.0, 5e4, 3e6]) * rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(200, [16384.0, 0.0, 0.0, 0.0]), (201, [16384.0, 0.0, 0.0, 1 / 256]), (202, [16384.0, 0.0, 0.0, 1 / 256]), (203, [-16384.0, 0.0, 0.0, 0.0]), rows[90], rows[90],
             (204, [2e6, 0.0, 0.0, 0.0]), (205, [2e6, 1 / 256, 0.0, 0.0]), (300, [2e5, 3.0]), (301, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    once = [r for i, r in enumerate(rows) if r not in rows[:i]]
    assert rows_of(pivot_topk.search(frame, F.col("id") % 10 == 0)) == brute(once, lambda i: i % 10 == 0)
    top = pivot_topk.search(spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [1.0])], frame.schema), F.lit(True))
    assert {(r.query_id, r.id): r.score for r in top.collect()}[1, 2] == -(1 << 63)
