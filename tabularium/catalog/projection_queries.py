"""Projection, filter, predicate and NULL-rule queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.catalog.registry import query
from tabularium.operators import projection as P
from tabularium.tables import TABLE_NAMES, Tables, dbl


@query("p1_projection", "item", """SELECT order_id, item_id AS line_no, product_id, seller_id,
    CAST(price AS DOUBLE) AS price, CAST(price + freight AS DOUBLE) AS gross FROM item""")
def projection(t: Tables):
    return (t.items.withColumn("gross", dbl(F.col("price") + F.col("freight")))
            .withColumnRenamed("item_id", "line_no").withColumn("price", dbl("price"))
            .drop("freight", "quantity", "flag", "shipped_at"))


@query("p2_typed_projection", "", """SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS amount,
    CAST(o_orderdate AS DATE) AS day, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_no,
    CAST(NULL AS INTEGER) AS priority_text_no FROM orders""")
def typed_projection(t: Tables):
    text = t.raw("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.substring("o_orderpriority", 1, 1).alias("priority_no"),
        F.col("o_orderpriority").alias("priority_text_no"),
    )
    schema = T.StructType.fromDDL("order_id bigint, amount double, day date, priority_no int, priority_text_no int")
    return P.typed(text, schema)


@query("p3_status_filter", "ord", """SELECT order_id, order_status, purchased_at FROM ord
    WHERE order_status IN ('F', 'P') AND lower(priority) = '1-urgent'""")
def status_filter(t: Tables):
    return t.orders.filter(F.col("order_status").isin("F", "P") & (F.lower("priority") == "1-urgent")).select(
        "order_id", "order_status", "purchased_at")


@query("p4_half_open_range", "ord", """SELECT order_id, purchased_at FROM ord
    WHERE purchased_at >= TIMESTAMP '1998-01-01' AND purchased_at < TIMESTAMP '1998-02-01'""")
def half_open_range(t: Tables):
    low, high = F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1998-02-01").cast("timestamp_ntz")
    return t.orders.filter(P.between_half_open(F.col("purchased_at"), low, high)).select("order_id", "purchased_at")


@query("p5_prefix_match", "prod", "SELECT product_id, product_name FROM prod WHERE product_name LIKE 'red %'")
def prefix_match(t: Tables):
    return t.products.filter(F.col("product_name").startswith("red ")).select("product_id", "product_name")


@query("p6_null_rules", "ord", """WITH n AS (SELECT order_id, nullif(priority, '5-LOW') AS priority,
    nullif(order_status, 'P') AS order_status FROM ord)
    SELECT priority IS NULL AS priority_missing, order_status IS NOT DISTINCT FROM priority AS same_or_both_null,
    COUNT(*) AS rows_count, COUNT(CASE WHEN priority <> '1-URGENT' THEN 1 END) AS kept_by_where
    FROM n GROUP BY 1, 2""")
def null_rules(t: Tables):
    n = t.orders.select(F.nullif("priority", F.lit("5-LOW")).alias("priority"),
                        F.nullif("order_status", F.lit("P")).alias("order_status"))
    return n.groupBy(F.col("priority").isNull().alias("priority_missing"),
                     F.col("order_status").eqNullSafe(F.col("priority")).alias("same_or_both_null")).agg(
        F.count(F.lit(1)).alias("rows_count"),
        F.count_if(F.col("priority") != "1-URGENT").alias("kept_by_where"))


@query("p7_fill_drop_replace", "fin", """SELECT order_id, COALESCE(CAST(payment_value AS DOUBLE), 0.0) AS payment_value,
    CASE order_status WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE order_status END AS order_status,
    delivered_at IS NULL AS undelivered FROM fin WHERE purchased_at IS NOT NULL""")
def fill_drop_replace(t: Tables):
    return (t.finance.select("order_id", dbl("payment_value").alias("payment_value"), "order_status", "purchased_at",
                             F.col("delivered_at").isNull().alias("undelivered"))
            .na.fill({"payment_value": 0.0}).na.drop(subset=["purchased_at"])
            .na.replace({"F": "finished", "O": "open"}, subset=["order_status"]).drop("purchased_at"))


@query("p8_labels", "ord", """SELECT order_id, CASE WHEN amount < 100000 THEN 'small' WHEN amount < 300000 THEN 'medium'
    ELSE 'large' END AS amount_label FROM ord""")
def labels(t: Tables):
    label = P.bucketize(F.col("amount"), [(100000, "small"), (300000, "medium")], "large")
    return t.orders.select("order_id", label.alias("amount_label"))


@query("p9_optional_filters", "ord cust", """SELECT order_id, order_status, state FROM ord JOIN cust USING (customer_id)
    WHERE order_status = 'F' AND priority IN ('1-URGENT', '2-HIGH')""")
def optional_filters(t: Tables):
    df = t.orders.join(t.customers.select("customer_id", "state"), "customer_id")
    found = P.search(df, {"order_status": "F", "state": None, "priority": ["1-URGENT", "2-HIGH"]})
    return found.select("order_id", "order_status", "state")


@query("p10_sample_split", "", """WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
    CAST('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
        CAST(l_partkey AS VARCHAR))), 1, 8) AS BIGINT) / 4294967296.0 AS share FROM lineitem)
    SELECT CASE WHEN share < 0.8 THEN 'main' ELSE 'rest' END AS part, COUNT(*) AS rows_count,
    SUM(CASE WHEN share < 0.1 THEN 1 ELSE 0 END)::BIGINT AS sampled_rows,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM p GROUP BY 1""")
def sample_split(t: Tables):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    parts = P.split_by_key(t.raw("lineitem"), keys, {"main": 0.8, "rest": 0.2})
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows_count"), F.count_if(P.hash_share(*keys) < 0.1).alias("sampled_rows"),
        dbl(F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))).alias("price"))


@query("p11_row_counts", "", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS rows_count FROM {n}" for n in TABLE_NAMES))
def row_counts(t: Tables):
    allowed = {n: t.path(n) for n in TABLE_NAMES}
    return reduce(lambda a, b: a.unionByName(b), [P.row_count(t.spark, n, allowed) for n in TABLE_NAMES])
