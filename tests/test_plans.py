"""Plan facts that must hold at any size; that no query has a cross join is checked with its twin."""

from pyspark.sql import functions as F

from conftest import SF_DIR
from tabularium.catalog import load_all
from tabularium.operators.grouping import topn_per_group
from tabularium.session import scratch_path, scratch_root
from tabularium.sources import storage

QUERIES = load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topn_limits_groups_before_the_shuffle(tables):
    text = plan(topn_per_group(tables.orders, ["customer_id"], [F.col("amount").desc()], 3))
    assert text.count("WindowGroupLimit") == 2 and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["p4_half_open_range"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    schema = text[text.index("ReadSchema"):]
    assert "o_totalprice" not in schema and "o_orderkey" in schema


def test_partition_filters(spark, tables):
    path = scratch_path(spark, "pruned")
    storage.write_partitioned(tables.orders, path, ["order_status"])
    text = plan(storage.read_partitioned(spark, path).filter("order_status = 'F'"))
    assert "PartitionFilters: [isnotnull(order_status" in text


def test_scratch_uses_the_named_folder(spark):
    assert scratch_path(spark, "x").startswith(scratch_root(spark))
