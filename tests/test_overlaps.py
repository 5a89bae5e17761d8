"""Overlapping versions in as-of joins, and late changes in type 2 dimensions, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tabularium.operators import joins
from tabularium.plans import marts as M


def brute(facts, versions):
    """(fact id, attribute) of the version that began last among those valid, then the longest."""
    out = set()
    for i, k, at in facts:
        valid = [(lo, hi is None, hi or 0, v) for kk, lo, hi, v in versions if k is not None and kk == k and lo <= at and (hi is None or at < hi)]
        if valid:
            out.add((i, max(valid)[3]))
    return out


@pytest.mark.parametrize("max_group,seed", [(1_000_000, 1), (0, 2)])
def test_overlapping_versions(spark, max_group, seed):
    rng = random.Random(seed)
    versions = []
    for k in range(12):
        spans = {(rng.randint(0, 60), rng.choice([None, *range(1, 70)])) for _ in range(rng.choice([0, 1, 3, 25]))}
        versions += [(k, lo, hi, f"{k}:{lo}:{hi}") for lo, hi in spans]
    versions += [(100, 0, 10, "a"), (100, 10, 20, "b"), (100, 20, None, "c"), (None, 0, None, "lost"), (101, 5, 5, "empty"), (101, 9, 3, "reversed")]
    facts = [(i, rng.choice([*range(12), 100, 101, None, 200]), rng.randint(-3, 75)) for i in range(600)]
    fact = spark.createDataFrame(facts, "id int, k int, t int")
    dim = spark.createDataFrame(versions, "k int, lo int, hi int, v string")
    got = joins.asof_join(fact, dim, "k", "t", "lo", "hi", ["v"], ["id"], max_group=max_group)
    assert {(r.id, r.v) for r in got.collect()} == brute(facts, [x for x in versions if x[2] is None or x[2] > x[1]])
    left = joins.asof_join(fact, dim, "k", "t", "lo", "hi", ["v"], ["id"], "left", max_group)
    assert left.count() == len(facts)


def test_a_short_version_inside_a_long_one(spark):
    fact = spark.createDataFrame([(1, 7, 5), (2, 7, 12), (3, 7, 30)], "id int, k int, t int")
    dim = spark.createDataFrame([(7, 0, 100, "long"), (7, 10, 20, "short")], "k int, lo int, hi int, v string")
    got = joins.asof_join(fact, dim, "k", "t", "lo", "hi", ["v"], ["id"])
    assert {(r.id, r.v) for r in got.collect()} == {(1, "long"), (2, "short"), (3, "long")}
    cut = joins.disjoint_versions(dim, "k", "lo", "hi", ["v"])
    assert sorted(tuple(r) for r in cut.collect()) == [(7, 0, 10, "long"), (7, 10, 20, "short"), (7, 20, 100, "long")]
    apart = dim.filter("v = 'long'")
    assert "Generate" not in joins.disjoint_versions(apart, "k", "lo", "hi", ["v"])._jdf.queryExecution().optimizedPlan().toString()


def test_many_nested_versions_of_one_key(spark):
    n = 700
    dim = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("lo"), (2 * n - F.col("id")).alias("hi"), F.col("id").alias("v"))
    fact = spark.range(2 * n).select("id", F.lit(1).alias("k"), F.col("id").alias("t"))
    got = {r.id: r.v for r in joins.asof_join(fact, dim, "k", "t", "lo", "hi", ["v"], ["id"]).collect()}
    assert got == {t: t if t < n else 2 * n - t - 1 for t in range(2 * n)}


@pytest.mark.parametrize("max_group", [1_000_000, 0])
def test_late_changes_in_any_order(spark, max_group):
    rng = random.Random(max_group)
    log = [(rng.choice([1, 2, 3, None]), rng.choice(["a", "b", None]), t, t % 7) for t in rng.sample(range(500), 90)]
    ddl = "k int, city string, at int, seq int"
    whole = spark.createDataFrame(log, ddl)
    want = sorted(map(str, M.scd2_history(whole, "k", ["city"], "at", ["seq"], max_group).collect()))
    rng.shuffle(log)
    seen = whole.limit(0)
    dim = M.scd2_history(seen, "k", ["city"], "at", ["seq"], max_group)
    for part in (log[:30], log[30:31], log[31:], log[:10]):  # the last one arrives again
        dim, seen = M.scd2_late(dim, seen, spark.createDataFrame(part + part[:2], ddl), "k", ["city"], "at", ["seq"], max_group)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    assert sorted(map(str, dim.collect())) == want and seen.count() == 90


def test_a_late_change_splits_a_version(spark):
    ddl = "k int, city string, at int"
    seen = spark.createDataFrame([(1, "a", 1), (1, "a", 3), (2, "x", 1)], ddl)
    dim = M.scd2_history(seen, "k", ["city"], "at", [])
    out, _ = M.scd2_late(dim, seen, spark.createDataFrame([(1, "b", 2)], ddl), "k", ["city"], "at", [])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 1, 2, False), (1, "a", 3, None, True), (1, "b", 2, 3, False), (2, "x", 1, None, True)]
