"""Exact top-k by integer inner product, with pivot-table elimination.

Vectors become integers floor(256 * x). Distances of every vector to the pivots are computed once per block. For a query
q and a candidate x, |d(q, p) - d(x, p)| never exceeds d(q, x); its maximum over the pivots bounds the distance from
below and so the inner product (|q|^2 + |x|^2 - d^2) / 2 from above. Candidates of a block are evaluated in the order of
that bound until it falls below the k-th score known, so the answer is exact.

Queries are a stated set and are set against all rows in blocks: blocks of queries are copied to every slot of candidate
blocks and a task takes one pair of blocks at a time. Only pivots and seeds (bounded samples, `PIVOTS` and `SEEDS` rows)
are collected. Each block of queries starts from the k-th score over the seeds, which is a score of k real candidates.

Vectors with a component of |256 x| >= 2**22 (`LARGEST`), beyond which the bounds are not safe in doubles, take a second
path: candidates whose score in doubles is within its error of the k-th are scored again in whole numbers of any size.

Edge cases: a vector that is null, or holds a null or non-finite component, and a row with a null id take no part.
Components and scores beyond 64 bits stop at the ends of their range. Vectors of different length are not compared. Rows that
have the query's id are its own. Repeated rows count once: a (query, candidate, score) is listed once. A query without
candidates gives no row, as does an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 16
SEEDS = 1024
BLOCK_ROWS = 2048
QUERY_ROWS = 512
SCALE = 256
LARGEST = 2 ** 22


def finite_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, _v array<double>, wide boolean) of the rows that take part."""
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    wide = F.exists("_v", lambda x: F.abs(x) >= LARGEST / SCALE)
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("_v"))
            .filter(F.col("id").isNotNull() & F.col("_v").isNotNull() & ~bad).withColumn("wide", wide))


def integers(rows: DataFrame, kind: str) -> DataFrame:
    """(id, dim int, v) with components as `int` or, held within 63 bits, as `long`."""
    most = float(1 << 62)
    v = F.transform("_v", lambda x: F.floor(F.least(F.greatest(x * SCALE, F.lit(-most)), F.lit(most))).cast(kind))
    return rows.select("id", F.size("_v").alias("dim"), v.alias("v"))


def matrix(column: pa.Array, n: int, dim: int, kind=np.int32) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind).reshape(n, dim)


def fitted(points: np.ndarray, dim: int) -> np.ndarray:
    """Points cut or filled with zeros to `dim`; any point may serve as a pivot."""
    out = np.zeros((len(points), dim))
    width = min(dim, points.shape[1])
    out[:, :width] = points[:, :width]
    return out


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x = points.astype(np.float64)
    sq = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2.0 * (x @ pivots.T)
    return np.sqrt(np.maximum(sq, 0.0))


def spread(points: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice of n pivots."""
    chosen = [0]
    near = distances(points, points[:1].astype(np.float64))[:, 0]
    while len(chosen) < min(n, len(points)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(points, points[chosen[-1:]].astype(np.float64))[:, 0])
    return points[chosen]


def blocks(rows: DataFrame, size: int, pivots=None) -> DataFrame:
    """Rows of one length packed together with their distances to the pivots; without pivots, as 64-bit integers."""
    kind = np.int64 if pivots is None else np.int32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, x = (np.concatenate(c) for c in zip(*held.pop(dim)))
            table = distances(x, fitted(pivots.value, dim)) if pivots is not None else np.empty(0)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([x.tobytes()], pa.binary()), pa.array([table.tobytes()], pa.binary())],
                ["dim", "ids", "x", "table"])

        for batch in batches:
            dims = np.asarray(batch.column(1))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                ids, x = np.asarray(part.column(0)), matrix(part.column(2), part.num_rows, dim, kind)
                for i in range(0, len(ids), size):
                    held.setdefault(dim, []).append((ids[i:i + size], x[i:i + size]))
                    if sum(len(p[0]) for p in held[dim]) >= size:
                        yield out(dim)
        for dim in list(held):
            yield out(dim)

    return rows.mapInArrow(pack, "dim int, ids binary, x binary, table binary")


def best_of(q: np.ndarray, own: int, ids: np.ndarray, x: np.ndarray, bound: np.ndarray, least: float, k: int,
            step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates with a score of `least` or more, ties to the smaller id."""
    near = np.flatnonzero((bound >= least) & (ids != own))
    near = near[np.argsort(-bound[near], kind="stable")]
    best_id, best = np.empty(0, np.int64), np.empty(0)
    for i in range(0, len(near), step):
        if bound[near[i]] < least:
            break
        at = near[i:i + step]
        score = x[at] @ q
        high = score >= least
        if high.any():
            merged = set(zip(-best, best_id.tolist())) | set(zip((-score[high]).tolist(), ids[at][high].tolist()))
            first = sorted(merged)[:k]  # by score, then id
            best, best_id = -np.array([s for s, _ in first]), np.array([n for _, n in first], np.int64)
            if len(best) == k:
                least = max(least, best[-1])
    kept = best >= least
    return best_id[kept], best[kept]


def exact_best(own: int, q: np.ndarray, ids: np.ndarray, x: np.ndarray, rough: np.ndarray, slack: float, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best candidates; `rough` are scores in doubles, wrong by at most `slack`."""
    near = np.flatnonzero(ids != own)
    if len(near) > k and len(np.unique(ids)) == len(ids):
        near = near[rough[near] >= -np.partition(-rough[near], k - 1)[k - 1] - 2 * slack]
    query, top = q.tolist(), (1 << 63) - 1
    found = {(max(-top - 1, min(top, sum(a * b for a, b in zip(query, x[i].tolist())))), int(ids[i])) for i in near}
    return sorted(found, key=lambda f: (-f[0], f[1]))[:k]


def wide_search(asked: DataFrame, held: DataFrame, k: int, slots: int) -> DataFrame:
    """query_id, id, score as `search` finds them, for components of any size."""
    asked = blocks(integers(asked, "long"), QUERY_ROWS).select(
        "dim", "ids", "x", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    held = blocks(integers(held, "long"), BLOCK_ROWS).select(
        "dim", F.col("ids").alias("c_ids"), F.col("x").alias("c_x"), F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int").alias("slot"))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, c_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["c_ids"], np.int64)
                x = np.frombuffer(row["x"], np.int64).reshape(len(ids), row["dim"])
                c = np.frombuffer(row["c_x"], np.int64).reshape(len(c_ids), row["dim"])
                c_ids, c = (u := np.unique(np.column_stack([c_ids, c]), axis=0))[:, 0], u[:, 1:]  # repeated rows once
                near, far = c.astype(np.float64), x.astype(np.float64)
                longest = np.sqrt((near * near).sum(1)).max()
                slack = (row["dim"] + 4) * 2.0 ** -51 * longest * np.sqrt((far * far).sum(1))
                out = [(int(i), n, s) for i, q, f, e in zip(ids, x, far, slack)
                       for s, n in exact_best(int(i), q, c_ids, c, near @ f, float(e), k)]
                yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], pa.int64()) for j in range(3)], ["query_id", "id", "score"])

    pairs = asked.join(held, ["dim", "slot"]).select("dim", "ids", "x", "c_ids", "c_x")
    return pairs.mapInArrow(evaluate, "query_id long, id long, score long")


def search(rows: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score: the k highest inner products of every row for which `queries` (over id) holds."""
    spark = rows.sparkSession
    finite = finite_vectors(rows, id_col, vec_col)
    valid = integers(finite.filter("NOT wide"), "int")
    seeds = valid.orderBy(F.xxhash64("id"), "id").limit(SEEDS).collect()  # SEEDS rows
    width = max((r.dim for r in seeds), default=0)
    # ids may be as large as longs are, vectors are doubles: a seed is (id, vector)
    seed_ids = np.array([r.id for r in seeds], np.int64)
    seed_dims = np.array([r.dim for r in seeds], np.int64)
    seed_x = np.zeros((len(seeds), width), np.int32)
    for i, r in enumerate(seeds):
        seed_x[i, :r.dim] = r.v
    pivots = spark.sparkContext.broadcast(spread(seed_x, PIVOTS) if len(seeds) else np.zeros((1, 1), np.int32))
    seeded = spark.sparkContext.broadcast((seed_ids, seed_dims, seed_x))

    slots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = blocks(valid.filter(queries), QUERY_ROWS, pivots).select(
        "dim", F.struct("ids", "x", "table").alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    held = blocks(valid, BLOCK_ROWS, pivots).select(
        "dim", F.struct("ids", "x", "table").alias("c"), F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int").alias("slot"))
    pairs = asked.join(held, ["dim", "slot"]).select("dim", "q.*", F.col("c.ids").alias("c_ids"),
                                                     F.col("c.x").alias("c_x"), F.col("c.table").alias("c_table"))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}

        def starts(ids: np.ndarray, x: np.ndarray, dim: int) -> np.ndarray:
            s_ids, s_dims, s_x = seeded.value
            s_ids, s_x = s_ids[s_dims == dim], s_x[s_dims == dim][:, :dim].astype(np.float64)
            once = np.unique(s_ids, return_index=True)[1]
            s_ids, s_x = s_ids[once], s_x[once]
            if len(s_ids) <= k:
                return np.full(len(ids), -np.inf)
            score = x @ s_x.T
            score[ids[:, None] == s_ids[None, :]] = -np.inf
            return -np.partition(-score, k - 1, axis=1)[:, k - 1]

        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                ids, c_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["c_ids"], np.int64)
                x = np.frombuffer(row["x"], np.int32).reshape(len(ids), dim).astype(np.float64)
                c = np.frombuffer(row["c_x"], np.int32).reshape(len(c_ids), dim).astype(np.float64)
                table = np.frombuffer(row["table"]).reshape(len(ids), -1)
                c_table = np.ascontiguousarray(np.frombuffer(row["c_table"]).reshape(len(c_ids), -1).T)
                if row["ids"] not in known:
                    known[row["ids"]] = starts(ids, x, dim)
                    while len(known) > 64:
                        known.pop(next(iter(known)))
                sq, c_sq, least = (x * x).sum(1), (c * c).sum(1), known[row["ids"]]
                found = []
                for i in range(len(ids)):
                    apart = np.abs(c_table[0] - table[i, 0])
                    for p in range(1, len(c_table)):
                        np.maximum(apart, np.abs(c_table[p] - table[i, p]), out=apart)
                    apart = np.maximum(apart - 1e-6, 0.0)  # rounding of the square roots
                    bound = (sq[i] + c_sq - apart * apart) / 2.0 + 1e-3
                    got, score = best_of(x[i], ids[i], c_ids, c, bound, least[i], k)
                    found.append((np.full(len(got), ids[i]), got, score.astype(np.int64)))
                a, b, s = (np.concatenate(p) for p in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], ["query_id", "id", "score"])

    found = pairs.mapInArrow(evaluate, "query_id long, id long, score long")
    wide = finite.filter("wide")
    if wide.limit(1).count():  # every pair with a wide side
        asked = finite.filter(queries)
        found = found.union(wide_search(asked, wide, k, slots)).union(wide_search(asked.filter("wide"), finite.filter("NOT wide"), k, slots))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k)
            .groupBy("query_id", "rank", "id", "score").agg(F.lit(1).alias("_")).drop("_"))
