import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.session import scratch_path
from tabularium.sources import storage as S


def put_text(spark, lines, label="text"):
    path = scratch_path(spark, label)
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_rejects(spark):
    path = put_text(spark, ["id,day", "1,2024-01-01", "x,2024-01-02", "3,2024-01-03", "4,soon", "5,2024-01-05"])
    schema = T.StructType.fromDDL("id int, day date")
    good, bad = S.read_with_rejects(spark, path, schema, limit=2)
    assert good.count() == 3 and good.select("id").count() == 3
    assert {(r["raw_line"], r["unread_fields"]) for r in bad.collect()} == {("x,2024-01-02", "id"), ("4,soon", "day")}
    with pytest.raises(ValueError):
        S.read_with_rejects(spark, path, schema, limit=1)


def test_null_and_empty_are_told_apart(spark):
    path = put_text(spark, ["1|\\N|x", "2||y"])
    rows = S.read_delimited(spark, path, ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [("1", None, "x"), ("2", "", "y")]


def test_quoted_fields(spark):
    path = put_text(spark, ["id,name", '1,"a, b"', '2,"say ""hi"""'])
    assert [r["name"] for r in S.read_csv(spark, path, "id int, name string").orderBy("id").collect()] == ["a, b", 'say "hi"']



def test_dynamic_overwrite_twice(spark):
    path = scratch_path(spark, "dyn")
    rows = spark.range(10).withColumn("m", F.col("id") % 2)
    S.write_partitioned(rows, path, ["m"])
    for _ in range(2):
        S.overwrite_partitions(rows.filter("m = 1").limit(3), path, ["m"])
    assert {r["m"]: r["count"] for r in S.read_partitioned(spark, path).groupBy("m").count().collect()} == {0: 5, 1: 3}


def test_one_partition_value_gets_several_files(spark):
    path = scratch_path(spark, "hot-partition")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("t"), F.lit("hot").alias("m"))
        S.write_partitioned(rows, path, ["m"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert S.partition_profile(S.read_partitioned(spark, path), "m").first()["files"] > 1


def test_schema_reports(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([("1", 3)], "x string, z int")
    assert {r["column_name"]: r["state"] for r in S.reconcile_schema(a, b).collect()} == {"x": "type_changed", "y": "removed", "z": "added"}


def test_managed_table_loses_its_files(spark):
    rows = spark.range(3)
    managed, path = S.create_table(spark, "m", rows), scratch_path(spark, "ext")
    external = S.create_table(spark, "e", rows, location=path)
    spark.sql(f"DROP TABLE {managed}")
    spark.sql(f"DROP TABLE {external}")
    assert not spark.catalog.tableExists(managed)
    assert spark.read.parquet(path).count() == 3


def test_partition_commands(spark):
    name = S.create_table(spark, "parts", spark.range(6).select("id", (F.col("id") % 3).cast("string").alias("p")), ["p"])
    S.add_partition(spark, name, p="9")
    S.truncate_partition(spark, name, p="0")
    S.drop_partition(spark, name, p="1")
    assert {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"p=0", "p=2", "p=9"}
    assert {r["p"]: r["count"] for r in spark.table(name).groupBy("p").count().collect()} == {"2": 2}


def test_cached_is_released(spark):
    df = spark.range(5)
    with S.cached(df) as kept:
        assert kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_compaction_report(spark):
    many, few = scratch_path(spark, "many"), scratch_path(spark, "few")
    spark.range(100).repartition(10).write.parquet(many)
    out = S.compact(spark, many, few)
    report = S.file_profile(out, 1 << 20).first()
    assert report["file_count"] == 1 and report["rows_count"] == 100 and report["small_files"] == 1
    more = S.compact(spark, many, scratch_path(spark, "some"), file_bytes=2000)
    assert S.file_profile(more, 1 << 20).first()["file_count"] > 1
