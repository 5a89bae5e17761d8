"""Ordered scans against brute force, with one key that holds most rows and many slices."""

import random

import pytest
from check_twins import cross_joins
from pyspark.sql import functions as F

from tabularium.operators import grouping, joins, ordered, quality, windows


def scans():
    v = F.col("v")
    return (ordered.row_number("rn"), ordered.running_sum("total", v), ordered.running_max("best", v), ordered.running_min("least", v),
            ordered.lag("before", v), ordered.lead("after", v), ordered.first("start", v), ordered.last_known("known", v))


def data(n=400, seed=1):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None, "z"]
    ids = list(range(n))
    rng.shuffle(ids)
    return [(rng.choice(keys), i, rng.choice([None, rng.randint(0, 50), rng.randint(0, 50)])) for i in ids]


def brute(rows, key_of):
    out, groups = {}, {}
    for r in sorted(rows, key=lambda r: r[1]):
        groups.setdefault(key_of(r), []).append(r)
    for group in groups.values():
        known = total = best = least = None
        for i, (_, ident, v) in enumerate(group):
            if v is not None:
                known, total = v, (total or 0) + v
                best = v if best is None else max(best, v)
                least = v if least is None else min(least, v)
            out[ident] = (i + 1, total, best, least, group[i - 1][2] if i else None,
                          group[i + 1][2] if i + 1 < len(group) else None, group[0][2], known)
    return out


def got(df):
    return {r["i"]: (r["rn"], r["total"], r["best"], r["least"], r["before"], r["after"], r["start"], r["known"]) for r in df.collect()}


@pytest.mark.parametrize("max_group", [10_000, 50, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_scan_by_key(spark, max_group, seed):
    rows = data(seed=seed)
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(5)
    out = ordered.scan(df, ["k"], [F.col("i").asc()], *scans(), max_group=max_group)
    assert cross_joins(out) == []
    assert got(out) == brute(rows, lambda r: r[0])


def test_scan_whole_table(spark):
    rows = data()
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(5)
    assert got(ordered.scan(df, [], [F.col("i").asc()], *scans())) == brute(rows, lambda r: None)


def test_more_slices_than_rows(spark):
    df = spark.createDataFrame([("a", 2, 5), ("a", 1, None)], "k string, i int, v int")
    placed = ordered.sliced(df, ["k"], [F.col("i").asc()], slices=30)
    assert got(ordered.scan_slices(placed, ["k"], *scans())) == brute([("a", 2, 5), ("a", 1, None)], lambda r: r[0])


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, i int, v int")
    assert ordered.scan(df, ["k"], [F.col("i").asc()], *scans()).count() == 0
    assert ordered.numbered(df, [], [F.col("i").asc()]).count() == 0


def test_value_ranks(spark):
    df = spark.createDataFrame([(v,) for v in [5, 5, 5, 9, 1, 1]], "v int")
    rows = {r["v"]: (r["value_rank"], r["value_dense_rank"]) for r in ordered.value_ranks(df, "v", True).collect()}
    assert rows == {9: (1, 1), 5: (2, 2), 1: (5, 3)}


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_percentile(spark, p):
    rng = random.Random(3)
    rows = [("a", rng.randint(0, 9)) for _ in range(101)] + [("b", 7)] + [("c", 1), ("c", 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    expected = {}
    for k in "abc":
        vs = sorted(v for kk, v in rows if kk == k)
        at = p * (len(vs) - 1)
        lo = int(at)
        hi = min(lo + (at > lo), len(vs) - 1)
        expected[k] = vs[lo] + (vs[hi] - vs[lo]) * (at - lo)
    out = {r["k"]: r["x"] for r in ordered.exact_percentile(df, ["k"], "v", p, "x").collect()}
    assert out == pytest.approx(expected)


@pytest.mark.parametrize("chunk,max_group", [(3, 1000), (3, 10), (1000, 1000)])
def test_chunks_hold_every_row(spark, chunk, max_group):
    rows = [("hot", i % 7, i) for i in range(50)] + [("b", 1, 1)]
    df = spark.createDataFrame(rows, "k string, a int, i int").repartition(4)
    out = grouping.collect_ordered(df, ["k"], ["a", "i"], F.col("i"), "ids", chunk, max_group).collect()
    assert all(len(r["ids"]) <= chunk for r in out)
    joined = [i for r in sorted((r for r in out if r["k"] == "hot"), key=lambda r: r["chunk_no"]) for i in r["ids"]]
    assert joined == [i for _, _, i in sorted((a, i, i) for k, a, i in rows if k == "hot")]
    assert {r["k"] for r in out} == {"hot", "b"}


@pytest.mark.parametrize("max_group", [1000, 0])
def test_sessions(spark, max_group):
    times = [0, 5, 10, 21, 22, 40]
    df = spark.createDataFrame([("u", i, t) for i, t in enumerate(times)], "u string, i int, t int").repartition(3)
    out = windows.sessions(df, ["u"], "t", ["i"], F.lit(10), max_group)
    assert [r["session_no"] for r in out.orderBy("i").collect()] == [1, 1, 1, 2, 2, 3]


@pytest.mark.parametrize("max_group", [1000, 0])
def test_versions(spark, max_group):
    df = spark.createDataFrame([("x", 3), ("x", 1), ("y", 2), ("x", 9)], "k string, i int")
    out = quality.versions(df, ["k"], [F.col("i").asc()], "i", max_group).orderBy("i").collect()
    assert [(r["i"], r["version_no"], r["canonical_id"]) for r in out] == [(1, 1, 1), (2, 1, 2), (3, 2, 1), (9, 3, 1)]


@pytest.mark.parametrize("total,tiles", [(10, 4), (3, 4), (8, 4), (1, 3)])
def test_ntile(spark, total, tiles):
    out = spark.range(1, total + 1).select(windows.ntile(F.col("id"), F.lit(total), tiles).alias("t")).collect()
    size, larger = divmod(total, tiles)
    expected = [t + 1 for t in range(tiles) for _ in range(size + (t < larger))]
    assert [r["t"] for r in out] == expected


@pytest.mark.parametrize("max_group", [1000, 0])
def test_asof_gaps_and_open_ends(spark, max_group):
    dim = spark.createDataFrame([("k", 10, 20, "a"), ("k", 30, None, "b")], "k string, lo int, hi int, city string")
    fact = spark.createDataFrame([("k", t, t) for t in (5, 10, 19, 20, 25, 30, 99)] + [("n", 50, 50)], "k string, t int, id int")
    out = joins.asof_join(fact, dim, "k", "t", "lo", "hi", ["city"], ["id"], "left", max_group)
    found = {(r["k"], r["t"]): r["city"] for r in out.collect()}
    assert found == {("k", 5): None, ("k", 10): "a", ("k", 19): "a", ("k", 20): None, ("k", 25): None, ("k", 30): "b", ("k", 99): "b", ("n", 50): None}


def test_topn_beyond_the_group_limit(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), "id")
    out = grouping.topn_per_group(df, ["k"], [F.col("id").asc()], 1200)
    assert out.count() == 2400 and out.agg(F.max("id")).first()[0] == 2399


def test_slices_follow_from_the_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ordered.slices_for(spark.range(1000), slice_rows=10) == 100
    assert ordered.slices_for(spark.range(10)) == least


@pytest.mark.parametrize("chunk,max_group", [(1000, 1_000_000), (3, 1_000_000), (3, 0)])
def test_distinct_values_stay_at_their_first_place(spark, chunk, max_group):
    values = {k: [v for _, v in rows] for k, rows in {"a": [(i, f"v{i * 7 % 10}") for i in range(40)], "b": [(0, "x"), (1, None), (2, "x"), (3, None)], None: [(0, "q")]}.items()}
    df = spark.createDataFrame([(k, i, v) for k, vs in values.items() for i, v in enumerate(vs)], "k string, i int, v string").repartition(5)
    for distinct in (True, False):
        out = grouping.collect_ordered(df, ["k"], ["i"], F.col("v"), "vs", chunk, max_group, distinct).collect()
        got = {}
        for r in sorted(out, key=lambda r: r["chunk_no"]):
            assert len(r["vs"]) <= chunk
            got.setdefault(r["k"], []).extend(r["vs"])
        assert got == {k: list(dict.fromkeys(vs)) if distinct else vs for k, vs in values.items()}


def test_arrays_take_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 9).alias("k"), "id")
    plan = grouping.collect_ordered(df, ["k"], ["id"], F.col("id"), "ids")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
