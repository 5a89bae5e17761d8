import pytest
from pyspark.sql import functions as F

from tabularium.operators import layout
from tabularium.operators.projection import sample_by_key
from tabularium.sources import storage


def test_hash_parts_count_every_row(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 800, "HOT").otherwise(F.col("id").cast("string")).alias("k"))
    parts = layout.hash_parts(df, ["k"], 4)
    report = layout.skew(parts).first()
    assert parts.agg(F.sum("rows_count")).first()[0] == 1000
    assert report["parts"] == 4 and report["max_rows"] >= 800 and report["max_over_avg"] >= 3.2


def test_skew_of_even_parts(spark):
    parts = layout.partition_rows(spark.range(0, 400, 1, 4))
    report = layout.skew(parts).first()
    assert (report["parts"], report["empty_parts"], report["max_over_avg"], report["skew_pct"]) == (4, 0, 1.0, 0.0)


def test_empty_parts_are_seen(spark):
    report = layout.skew(layout.hash_parts(spark.range(50).select(F.lit(1).alias("k")), ["k"], 8)).first()
    assert report["empty_parts"] == 7


def test_candidate_keys(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("few"), F.when(F.col("id") < 15_000, 0).otherwise(F.col("id")).alias("hot"))
    verdicts = {r["candidate"]: r["verdict"] for r in layout.compare_keys(df, [["id"], ["few"], ["hot"]], 8).collect()}
    assert verdicts == {"id": "even", "few": "too few values", "hot": "skewed"}


def test_cluster_keeps_keys_together(spark):
    placed = layout.cluster(spark.range(500).select((F.col("id") % 20).alias("k"), "id"), 4, "k")
    homes = placed.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.countDistinct("p").alias("n"))
    assert homes.agg(F.max("n")).first()[0] == 1


def test_sample_is_fixed_by_key(spark):
    a = sample_by_key(spark.range(10_000), ["id"], 0.1)
    assert a.exceptAll(sample_by_key(spark.range(10_000).repartition(9), ["id"], 0.1)).count() == 0
    assert 850 < a.count() < 1150


def test_hot_side_is_refused_by_buckets(spark):
    hot = spark.range(100).select(F.when(F.col("id") < 40, 1).otherwise(F.col("id")).alias("k"))
    even = spark.range(100).select(F.col("id").alias("k"))
    assert storage.hottest_share(hot, "k") == 0.4
    plan = storage.write_bucketed(even, "k", bucket_rows=30).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 4 out of 4" in plan
    with pytest.raises(ValueError):
        storage.write_bucketed(hot, "k", bucket_rows=30)


def test_parts_are_those_spark_makes(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("k"))
    placed = df.repartition(4, "k").groupBy(F.spark_partition_id().alias("p")).count()
    real = sorted(r["count"] for r in placed.collect())
    assert [n for n in sorted(r["rows_count"] for r in layout.hash_parts(df, ["k"], 4).collect()) if n] == real


def test_estimates_are_close(spark, tables):
    from tabularium.catalog import load_all
    from conftest import SF_DIR

    for row in load_all()["a6_approx_distinct"](spark, SF_DIR).collect():
        assert row["exact"] == tables.orders.select(row["column_name"]).distinct().count() and row["estimate_is_close"]
