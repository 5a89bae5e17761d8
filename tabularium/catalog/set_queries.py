"""Set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.catalog.registry import query
from tabularium.operators import sets
from tabularium.tables import Tables, dbl


@query("u1_unions", "cust seller", """SELECT 'distinct' AS form, state, 1::BIGINT AS copies FROM (SELECT state FROM cust UNION SELECT state FROM seller)
    UNION ALL SELECT 'all', state, COUNT(*) FROM (SELECT state FROM cust UNION ALL SELECT state FROM seller) GROUP BY state""")
def unions(t: Tables):
    both = t.customers.select("state").unionAll(t.sellers.select("state"))
    folded = both.groupBy("state").agg(F.count(F.lit(1)).alias("copies")).select(F.lit("all").alias("form"), "state", "copies")
    return both.distinct().select(F.lit("distinct").alias("form"), "state", F.lit(1).cast("long").alias("copies")).unionByName(folded)


@query("u2_set_compare", "ord item", """SELECT CASE WHEN bool_and(here) THEN 'order_only' WHEN bool_or(here) THEN 'both' ELSE 'item_only' END AS set_name, order_id
    FROM (SELECT order_id, true AS here FROM ord UNION ALL SELECT order_id + 3, false FROM item) GROUP BY order_id""")
def set_compare(t: Tables):
    # order ids of the items are moved by three, so that either side has ids of its own
    return sets.set_compare(t.orders.select("order_id"), t.items.select((F.col("order_id") + 3).alias("order_id")), "order_only", "item_only")


@query("u3_union_by_name", "ord", """SELECT order_id, CAST(amount AS DOUBLE) AS amount, NULL AS priority, purchased_at FROM ord WHERE purchased_at < TIMESTAMP '1998-01-01'
    UNION ALL SELECT order_id, NULL, priority, purchased_at FROM ord WHERE purchased_at >= TIMESTAMP '1998-01-01'""")
def union_by_name(t: Tables):
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old = t.orders.filter(F.col("purchased_at") < cut).select("purchased_at", dbl("amount").alias("amount"), "order_id")
    new = t.orders.filter(F.col("purchased_at") >= cut).select("order_id", "priority", "purchased_at")
    return old.unionByName(new, allowMissingColumns=True)


@query("u4_distinct", "item", "SELECT DISTINCT order_id, item_id FROM item")
def distinct(t: Tables):
    return t.items.select("order_id", "item_id").distinct()


@query("u5_frame_diff", "ord", """WITH a AS (SELECT order_id, order_status FROM ord), b AS (SELECT order_id, CASE WHEN priority = '1-URGENT' THEN 'P' ELSE order_status END AS order_status FROM ord)
    SELECT order_id, order_status, 1::BIGINT AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL
    SELECT order_id, order_status, -1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def frame_diff(t: Tables):
    a = t.orders.select("order_id", "order_status")
    b = t.orders.select("order_id", F.when(F.col("priority") == "1-URGENT", "P").otherwise(F.col("order_status")).alias("order_status"))
    return sets.frame_diff(a, b)
