import pytest
from pyspark.sql import functions as F

from tabularium.operators import grouping, joins, sets


@pytest.fixture(scope="module")
def sides(spark):
    big = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return big, small


def same(a, b):
    return sets.frame_diff(a.select(sorted(a.columns)), b.select(sorted(b.columns))).count() == 0


def test_salted_join_keeps_rows(sides):
    big, small = sides
    assert same(joins.salted_join(big, small, "k", salts=5), big.join(small, "k"))


def test_salted_join_spreads_copies(spark):
    copies = spark.range(800).select(F.lit(1).alias("k"), F.lit("same").alias("t")).repartition(8)
    salts = copies.select(grouping.spread_salt(4, "k", "t").alias("s")).distinct().count()
    assert salts > 1


def test_hints_give_one_result(sides):
    big, small = sides
    plain = big.join(small, "k")
    for hint in ("merge", "shuffle_hash", "broadcast"):
        assert same(joins.hinted_join(big, small, ["k"], hint), plain)
    with pytest.raises(ValueError):
        joins.hinted_join(big, small, ["k"], "shuffle_replicate_nl")


def test_broadcast_only_below_the_bound(sides):
    big, small = sides
    below = joins.broadcast_checked(big, small, ["k"], max_bytes=1 << 20)
    above = joins.broadcast_checked(big, small, ["k"], max_bytes=8)
    assert same(below, above)
    assert "ResolvedHint (strategy=broadcast)" in below._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in above._jdf.queryExecution().analyzed().toString()


def test_bucketed_join_without_shuffle(spark, sides):
    _, small = sides
    even = spark.range(900).select((F.col("id") % 45).alias("k"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.bucketed_join(even, small, "k", 8)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert same(joined, even.join(small, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_join_refuses_a_hot_key(sides):
    big, small = sides
    with pytest.raises(ValueError, match="more than the 100"):
        joins.bucketed_join(big, small, "k", bucket_rows=100)


def test_null_keys_are_kept(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "g int, v int")
    from tabularium.operators.grouping import with_group_agg
    from tabularium.operators.ordered import exact_percentile

    assert sorted(r["n"] for r in with_group_agg(rows, ["g"], {"n": F.count(F.lit(1))}).collect()) == [1, 2, 2]
    assert joins.later_partners(rows, "g", "v").count() == 3
    assert {(r["g"], r["m"]) for r in exact_percentile(rows, ["g"], "v", 0.5, "m").collect()} == {(None, 1.5), (1, 3.0)}


def test_period_join_over_uneven_periods(spark):
    facts = spark.createDataFrame([(i, i) for i in range(30)] + [(99, None)], "id int, at int")
    starts = spark.createDataFrame([(3,), (4,), (20,)], "start int")
    got = {(r["id"], r["start"]) for r in joins.period_join(facts, starts, "at", "start", ["id"]).collect()}
    assert got == {(i, max(s for s in (3, 4, 20) if s <= i)) for i in range(3, 30)}


def test_anti_join_with_null_on_the_right(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(str(r["k"]) for r in joins.anti_join(left, right, ["k"]).collect()) == ["2", "None"]


def test_two_stage_equals_one_stage(sides):
    big, _ = sides
    two = grouping.two_stage_agg(big, ["k"], ["id"], {"n": F.count(F.lit(1)), "m": F.max("id")}, {"n": F.sum("n"), "m": F.max("m")})
    assert same(two, big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m")))


def test_frame_diff_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert {(r["x"], r["copies"]) for r in sets.frame_diff(a, b).collect()} == {(1, 1), (3, -1)}


def test_distance_golden(spark):
    one = spark.range(1).select(*[joins.distance_km(*[F.lit(float(v)) for v in p]).alias(f"d{i}") for i, p in enumerate([(0, 0, 0, 0), (0, 0, 0, 1)])]).first()
    assert round(one["d0"], 3) == 0.0 and round(one["d1"], 3) == 111.195
