"""Sort, top-k and placement queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.catalog.registry import query
from tabularium.operators import layout
from tabularium.tables import Tables, dbl


@query("o1_global_order", "ord", """SELECT order_id, purchased_at, nullif(order_status, 'P') AS order_status FROM ord ORDER BY order_status DESC NULLS LAST, purchased_at, order_id""")
def global_order(t: Tables):
    return t.orders.select("order_id", "purchased_at", F.nullif("order_status", F.lit("P")).alias("order_status")).orderBy(
        F.col("order_status").desc_nulls_last(), "purchased_at", "order_id")


@query("o2_top_k", "ord", "SELECT order_id, purchased_at, CAST(amount AS DOUBLE) AS amount FROM ord ORDER BY purchased_at DESC, order_id LIMIT 20")
def top_k(t: Tables):
    return t.orders.orderBy(F.col("purchased_at").desc(), "order_id").limit(20).select("order_id", "purchased_at", dbl("amount").alias("amount"))


@query("o3_cluster_by", "ord", "SELECT order_status, customer_id, order_id FROM ord")
def cluster_by(t: Tables):
    return layout.cluster(t.orders.select("order_status", "customer_id", "order_id"), int(t.spark.conf.get("spark.sql.shuffle.partitions")), "customer_id", "order_id")


@query("o4_repartition", "item", "SELECT 'hash' AS placement, COUNT(*) AS rows_count, CAST(SUM(price) AS DOUBLE) AS price FROM item UNION ALL SELECT 'range', COUNT(*), CAST(SUM(price) AS DOUBLE) FROM item UNION ALL SELECT 'round_robin', COUNT(*), CAST(SUM(price) AS DOUBLE) FROM item UNION ALL SELECT 'coalesced', COUNT(*), CAST(SUM(price) AS DOUBLE) FROM item")
def repartition(t: Tables):
    rows = t.items.select("order_id", "price")
    # without a number, adaptive execution sizes the parts
    parts = rows.rdd.getNumPartitions()
    forms = {"hash": rows.repartition("order_id"), "range": rows.repartitionByRange("order_id"),
             "round_robin": rows.repartition(2 * parts), "coalesced": rows.coalesce(max(1, parts // 2))}
    out = None
    for name, df in forms.items():
        one = df.agg(F.count(F.lit(1)).alias("rows_count"), dbl(F.sum("price")).alias("price")).select(F.lit(name).alias("placement"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("o5_skew_profile", "item", """WITH p AS (SELECT month(shipped_at) AS part_no, COUNT(*) AS rows_count FROM item GROUP BY 1),
    f AS (SELECT g.range AS part_no, COALESCE(p.rows_count, 0) AS rows_count FROM range(16) g LEFT JOIN p ON p.part_no = g.range)
    SELECT COUNT(*) AS parts, COUNT(*) FILTER (WHERE rows_count = 0) AS empty_parts, MAX(rows_count) AS max_rows,
    ROUND(MAX(rows_count) / AVG(rows_count), 6) AS max_over_avg, ROUND(100 * stddev_pop(rows_count) / AVG(rows_count), 6) AS skew_pct FROM f""")
def skew_profile(t: Tables):
    counts = t.items.groupBy(F.month("shipped_at").cast("long").alias("part_no")).agg(F.count(F.lit(1)).alias("rows_count"))
    parts = t.spark.range(16).withColumnRenamed("id", "part_no").join(counts, "part_no", "left").na.fill({"rows_count": 0})
    return layout.skew(parts).withColumn("max_over_avg", F.round("max_over_avg", 6)).withColumn("skew_pct", F.round("skew_pct", 6))


@query("o5_real_partitions", "item", """SELECT 'by order' AS placement, 16::BIGINT AS parts, COUNT(*) AS rows_count, true AS forecast_holds, 'even' AS verdict FROM item
    UNION ALL SELECT 'by flag', 16, COUNT(*), true, 'skewed' FROM item""")
def real_partitions(t: Tables):
    """Rows of each of Spark's partitions, after placing and as forecast from key counts; few flags leave most parts empty."""
    out = []
    for label, key in (("by order", "order_id"), ("by flag", "flag")):
        placed = layout.partition_rows(t.items.select(key).repartition(16, key))
        both = layout.hash_parts(t.items, [key], 16).join(placed.withColumnRenamed("rows_count", "placed"), "part_no", "left").na.fill({"placed": 0})
        measured = both.agg(F.count(F.lit(1)).alias("parts"), F.sum("placed").alias("rows_count"), F.bool_and(F.col("placed") == F.col("rows_count")).alias("forecast_holds"),
                            F.when(F.max("placed") > 2 * F.avg("placed"), "skewed").otherwise("even").alias("verdict"))
        out.append(measured.select(F.lit(label).alias("placement"), "*"))
    return out[0].unionByName(out[1])


@query("o6_compare_keys", "item", " UNION ALL ".join(f"""SELECT '{k}' AS candidate, COUNT(*) AS distinct_keys, ROUND(MAX(n) / SUM(n), 9) AS hottest_share,
    CASE WHEN COUNT(*) < 16 THEN 'too few values' WHEN MAX(n) * 16 > 1.5 * SUM(n) THEN 'skewed' ELSE 'even' END AS verdict FROM (SELECT COUNT(*) AS n FROM item GROUP BY {k})""" for k in ("order_id", "product_id", "flag", "product_id,seller_id")))
def compare_keys(t: Tables):
    return layout.compare_keys(t.items, [["order_id"], ["product_id"], ["flag"], ["product_id", "seller_id"]], 16).withColumn("hottest_share", F.round("hottest_share", 9))
