"""Dimension and mart queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.catalog.quality_queries import checksum_sql
from tabularium.catalog.registry import query
from tabularium.functions import text, timeops
from tabularium.operators.joins import semi_join
from tabularium.operators.ordered import exact_percentile
from tabularium.plans import marts as M
from tabularium.session import scratch_path, written
from tabularium.sources import storage
from tabularium.sources.stored import StoredTable
from tabularium.tables import Tables, dbl, lng

DIMS = """dc AS (SELECT ROW_NUMBER() OVER (ORDER BY customer_id) AS customer_sk, * FROM cust), dp AS (SELECT ROW_NUMBER() OVER (ORDER BY product_id) AS product_sk, * FROM prod),
    ds AS (SELECT ROW_NUMBER() OVER (ORDER BY seller_id) AS seller_sk, * FROM seller)"""
FACT = f"""{DIMS}, fact AS (SELECT i.order_id, i.item_id, CAST(strftime(o.purchased_at, '%Y%m%d') AS BIGINT) AS date_sk, dc.customer_sk, dp.product_sk, ds.seller_sk, i.price, i.freight
    FROM item i JOIN ord o USING (order_id) JOIN dc USING (customer_id) JOIN dp USING (product_id) JOIN ds USING (seller_id))"""


def customer_dim(t: Tables):
    return M.build_dim(t.customers, "customer_id", ["city", "state"], "customer_sk")


def product_dim(t: Tables):
    return M.build_dim(t.products, "product_id", ["category", "size"], "product_sk")


def seller_dim(t: Tables):
    return M.build_dim(t.sellers, "seller_id", ["state"], "seller_sk")


def date_dim(t: Tables):
    return M.dim_date(timeops.calendar_of(t.orders.select(F.to_date("purchased_at").alias("day")), "day"), "day")


def all_dims(t: Tables):
    """The dimensions as stored tables: facts look keys up in them and star queries join them again."""
    return [(written(d, k), k, sk) for d, k, sk in (
        (date_dim(t), "calendar_date", "date_sk"), (customer_dim(t), "customer_id", "customer_sk"),
        (product_dim(t), "product_id", "product_sk"), (seller_dim(t), "seller_id", "seller_sk"))]


def item_fact(t: Tables, dims):
    rows = t.items.select("order_id", "item_id", "product_id", "seller_id", "price", "freight").join(
        t.orders.select("order_id", "customer_id", F.to_date("purchased_at").alias("calendar_date")), "order_id")
    return M.build_fact(rows, dims, ["order_id", "item_id", "price", "freight"])


@query("m1_dimensions", "cust prod seller", f"""WITH {DIMS} SELECT 'customer' AS dim, customer_sk AS sk, customer_id AS business_key, state AS attribute FROM dc UNION ALL
    SELECT 'product', product_sk, product_id, category FROM dp UNION ALL SELECT 'seller', seller_sk, seller_id, state FROM ds""")
def dimensions(t: Tables):
    parts = [("customer", customer_dim(t), "customer_sk", "customer_id", "state"), ("product", product_dim(t), "product_sk", "product_id", "category"),
             ("seller", seller_dim(t), "seller_sk", "seller_id", "state")]
    out = [d.select(F.lit(n).alias("dim"), F.col(sk).alias("sk"), F.col(k).alias("business_key"), F.col(a).alias("attribute")) for n, d, sk, k, a in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("m2_date_dimension", "daily", """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_sk, d AS calendar_date, year(d) AS year_num, quarter(d) AS quarter_num, month(d) AS month_num, day(d) AS day_num, isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series((SELECT MIN(day) FROM daily), (SELECT MAX(day) FROM daily), INTERVAL 1 DAY)) AS DATE) AS d)""")
def date_dimension(t: Tables):
    return date_dim(t)


@query("m3_item_fact", "ord item cust prod seller", f"""WITH {FACT} SELECT order_id, item_id, date_sk, customer_sk, product_sk, seller_sk, CAST(price AS DOUBLE) AS price, CAST(freight AS DOUBLE) AS freight FROM fact""")
def fact_items(t: Tables):
    return item_fact(t, all_dims(t)).withColumn("price", dbl("price")).withColumn("freight", dbl("freight"))


@query("m3_payment_fact", "ord item pay cust", """WITH dc AS (SELECT ROW_NUMBER() OVER (ORDER BY customer_id) AS customer_sk, customer_id FROM cust)
    SELECT order_id, payment_sequence, CAST(strftime(purchased_at, '%Y%m%d') AS BIGINT) AS date_sk, customer_sk, payment_type, CAST(payment_value AS DOUBLE) AS payment_value FROM pay JOIN ord USING (order_id) JOIN dc USING (customer_id)""")
def fact_payments(t: Tables):
    dims = [(written(date_dim(t), "dates"), "calendar_date", "date_sk"), (written(customer_dim(t), "customers"), "customer_id", "customer_sk")]
    rows = t.payments.join(t.orders.select("order_id", "customer_id", F.to_date("purchased_at").alias("calendar_date")), "order_id")
    return M.build_fact(rows, dims, ["order_id", "payment_sequence", "payment_type", "payment_value"]).withColumn("payment_value", dbl("payment_value"))


@query("m4_accumulating_snapshot", "fin", "SELECT order_id, purchased_at, estimated_at, delivered_at, CASE WHEN delivered_at IS NULL THEN 'purchased' ELSE 'delivered' END AS milestone FROM fin")
def accumulating(t: Tables):
    # orders are opened in a stored table; deliveries change the rows of their files
    cols = ["order_id", "purchased_at", "estimated_at", "delivered_at", "milestone"]
    opened = t.finance.select("order_id", "purchased_at", "estimated_at", F.lit(None).cast("timestamp_ntz").alias("delivered_at"), F.lit("purchased").alias("milestone"))
    done = t.finance.filter(F.col("delivered_at").isNotNull()).withColumn("milestone", F.lit("delivered")).select(cols)
    table = StoredTable.create(opened, scratch_path(t.spark, "milestones"), ["order_id"])
    table.merge(done, "order_id", ["delivered_at", "milestone"])
    return table.read()


@query("m5_periodic_snapshot", "ord cust", """SELECT CAST(date_trunc('month', purchased_at) AS DATE) AS snapshot_month, state, COUNT(*) AS orders_count, CAST(SUM(amount) AS DOUBLE) AS revenue FROM ord JOIN cust USING (customer_id) GROUP BY 1, 2""")
def periodic(t: Tables):
    rows = t.orders.select("customer_id", "amount", F.trunc("purchased_at", "month").alias("snapshot_month")).join(t.customers.select("customer_id", "state"), "customer_id")
    return rows.groupBy("snapshot_month", "state").agg(F.count(F.lit(1)).alias("orders_count"), dbl(F.sum("amount")).alias("revenue"))


@query("m6_junk_and_roles", "fin", """WITH x AS (SELECT *, COALESCE(delivered_late, false) AS late FROM fin), j AS (SELECT order_status, late, ROW_NUMBER() OVER (ORDER BY order_status, late) AS flags_sk FROM (SELECT DISTINCT order_status, late FROM x)),
    b AS (SELECT CAST(MIN(purchased_at) AS DATE) AS lo, CAST(MAX(purchased_at) AS DATE) AS hi FROM x) SELECT x.order_id, j.flags_sk, CAST(strftime(purchased_at, '%Y%m%d') AS BIGINT) AS purchase_date_sk,
    CASE WHEN CAST(delivered_at AS DATE) BETWEEN lo AND hi THEN CAST(strftime(delivered_at, '%Y%m%d') AS BIGINT) END AS delivery_date_sk, CASE WHEN CAST(estimated_at AS DATE) BETWEEN lo AND hi THEN CAST(strftime(estimated_at, '%Y%m%d') AS BIGINT) END AS estimated_date_sk
    FROM x JOIN j USING (order_status, late), b""")
def junk_and_roles(t: Tables):
    from pyspark.sql import Window
    rows = t.finance.withColumn("late", F.coalesce("delivered_late", F.lit(False)))
    # as many rows as there are flag combinations
    junk = rows.select("order_status", "late").distinct().withColumn("flags_sk", lng(F.row_number().over(Window.orderBy("order_status", "late"))))
    dates = date_dim(t)
    out = rows.join(junk, ["order_status", "late"])
    for role, col in (("purchase", "purchased_at"), ("delivery", "delivered_at"), ("estimated", "estimated_at")):
        side = dates.select(F.col("calendar_date").alias(f"{role}_day"), F.col("date_sk").alias(f"{role}_date_sk"))
        out = out.join(side, F.to_date(col) == F.col(f"{role}_day"), "left")
    return out.select("order_id", "flags_sk", "purchase_date_sk", "delivery_date_sk", "estimated_date_sk")


@query("m7_unknown_member", "ord cust", """WITH d AS (SELECT ROW_NUMBER() OVER (ORDER BY CAST(customer_id AS VARCHAR)) AS customer_sk, CAST(customer_id AS VARCHAR) AS customer_key, city FROM cust WHERE city <> 'MACHINERY')
    SELECT o.order_id, COALESCE(d.customer_sk, -1) AS customer_sk, COALESCE(d.city, 'Unknown') AS city, COALESCE(d.city, 'MACHINERY') AS resolved_city FROM ord o LEFT JOIN d ON d.customer_key = CAST(o.customer_id AS VARCHAR)""")
def unknown_member(t: Tables):
    key = F.col("customer_id").cast("string").alias("customer_key")
    known = M.with_unknown(M.build_dim(t.customers.filter("city <> 'MACHINERY'").select(key, "city"), "customer_key", ["city"], "customer_sk"),
                           "customer_key", "customer_sk", {"city": "Unknown"})
    facts = M.lookup_or_unknown(t.orders.select("order_id", key), known, "customer_key", "customer_sk")
    named = facts.join(known.select("customer_sk", "city"), "customer_sk")
    # members that came late: stubs filled once the source has them
    stubs = t.customers.select(key, F.when(F.col("city") == "MACHINERY", "Unknown").otherwise(F.col("city")).alias("resolved_city"), (F.col("city") == "MACHINERY").alias("is_stub"))
    full = M.resolve_late(stubs, t.customers.select(key, F.col("city").alias("resolved_city")), "customer_key", ["resolved_city"], "is_stub")
    return named.join(full.select("customer_key", "resolved_city"), "customer_key").select("order_id", "customer_sk", "city", "resolved_city")


def first_versions(t: Tables):
    return t.customers.select("customer_id", "city", "state", F.lit("1900-01-01").cast("timestamp_ntz").alias("valid_from"),
                              F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))


def moved_customers(t: Tables):
    """Customers of one segment change city; those of another are not in the source."""
    return t.customers.filter("city <> 'BUILDING'").select("customer_id", F.when(F.col("city") == "MACHINERY", "MOVED").otherwise(F.col("city")).alias("city"), "state")


@query("m8_scd2", "cust", """SELECT customer_id, city, state, TIMESTAMP '1900-01-01' AS valid_from, CASE WHEN city = 'MACHINERY' THEN TIMESTAMP '1998-01-01' END AS valid_to, city <> 'MACHINERY' AS is_current FROM cust
    UNION ALL SELECT customer_id, 'MOVED', state, TIMESTAMP '1998-01-01', NULL, true FROM cust WHERE city = 'MACHINERY'""")
def scd2(t: Tables):
    at = F.lit("1998-01-01").cast("timestamp_ntz")
    once = M.scd2(first_versions(t), moved_customers(t), "customer_id", ["city", "state"], at)
    return M.scd2(once, moved_customers(t), "customer_id", ["city", "state"], F.lit("1999-01-01").cast("timestamp_ntz"))  # a rerun changes nothing


@query("m8_scd1", "cust", "SELECT customer_id, CASE WHEN city = 'MACHINERY' THEN 'MOVED' ELSE city END AS city, state FROM cust")
def scd1(t: Tables):
    return M.scd1(t.customers.select("customer_id", "city", "state"), moved_customers(t), "customer_id", ["city", "state"])


SCD2_HISTORY = """WITH s AS (SELECT customer_id, order_status, purchased_at, order_id, LAG(order_status) OVER (PARTITION BY customer_id ORDER BY purchased_at, order_id) AS before FROM ord), k AS (SELECT * FROM s WHERE before IS NULL OR before <> order_status)
    SELECT customer_id, order_status, purchased_at AS valid_from, LEAD(purchased_at) OVER w AS valid_to, LEAD(purchased_at) OVER w IS NULL AS is_current FROM k WINDOW w AS (PARTITION BY customer_id ORDER BY purchased_at, order_id)"""


@query("m8_scd2_history", "ord", SCD2_HISTORY)
def scd2_history(t: Tables):
    return M.scd2_history(t.orders.select("customer_id", "order_status", "purchased_at", "order_id"), "customer_id", ["order_status"], "purchased_at", ["order_id"])


@query("m8_scd2_late", "ord", SCD2_HISTORY)
def scd2_late(t: Tables):
    """Changes arrive in three loads, the urgent ones last and the newest first: the history is that of the whole log."""
    changes = t.orders.select("customer_id", "order_status", "purchased_at", "order_id", "priority")
    old = F.col("purchased_at") < F.lit("1999-01-01").cast("timestamp_ntz")
    loads = [changes.filter(~old & (F.col("priority") != "1-URGENT")), changes.filter(old & (F.col("priority") != "1-URGENT")),
             changes.filter(F.col("priority") == "1-URGENT")]
    log = changes.drop("priority").limit(0)
    dim = M.scd2_history(log, "customer_id", ["order_status"], "purchased_at", ["order_id"])
    for load in loads:
        dim, log = M.scd2_late(dim, log, load, "customer_id", ["order_status"], "purchased_at", ["order_id"])
        dim = written(dim, "versions")
    return dim


@query("m9_drill_across", "ord item cust", """WITH a AS (SELECT customer_id, COUNT(DISTINCT order_id) AS orders_with_items FROM item JOIN ord USING (order_id) GROUP BY 1), b AS (SELECT customer_id, COUNT(*) AS big_orders FROM ord WHERE amount > 300000 GROUP BY 1)
    SELECT customer_id, COALESCE(orders_with_items, 0) AS orders_with_items, COALESCE(big_orders, 0) AS big_orders FROM cust LEFT JOIN a USING (customer_id) LEFT JOIN b USING (customer_id)""")
def drill_across(t: Tables):
    a = semi_join(t.orders, t.items, ["order_id"]).groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders_with_items"))
    b = t.orders.filter("amount > 300000").groupBy("customer_id").agg(F.count(F.lit(1)).alias("big_orders"))
    return t.customers.select("customer_id").join(a, "customer_id", "left").join(b, "customer_id", "left").na.fill({"orders_with_items": 0, "big_orders": 0})


@query("m10_star_sales", "ord item cust prod seller", f"""WITH {FACT} SELECT CAST(strptime(CAST(f.date_sk AS VARCHAR), '%Y%m%d') AS DATE) AS calendar_date, c.state, p.category, COUNT(DISTINCT f.order_id) AS orders_count, CAST(SUM(f.price) AS DOUBLE) AS product_revenue,
    CAST(SUM(f.freight) AS DOUBLE) AS freight_revenue, CAST(SUM(f.price) AS DOUBLE) / nullif(COUNT(*), 0) AS average_item_price FROM fact f JOIN dc c USING (customer_sk) JOIN dp p USING (product_sk) GROUP BY 1, 2, 3""")
def star_sales(t: Tables):
    # keys that are hashes need no numbering, and attributes come along with the key: one join per dimension
    customers = M.hashed_dim(t.customers, "customer_id", ["state"], "customer_sk")
    products = M.hashed_dim(t.products, "product_id", ["category"], "product_sk")
    rows = (t.items.select("order_id", "product_id", "price", "freight")
            .join(t.orders.select("order_id", "customer_id", F.to_date("purchased_at").alias("calendar_date")), "order_id")
            .join(customers, "customer_id").join(products, "product_id"))
    return rows.groupBy("calendar_date", "state", "category").agg(
        F.countDistinct("order_id").alias("orders_count"), dbl(F.sum("price")).alias("product_revenue"), dbl(F.sum("freight")).alias("freight_revenue"),
        (dbl(F.sum("price")) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("average_item_price"))


@query("m10_snowflake", "item prod", """WITH c AS (SELECT category, ROW_NUMBER() OVER (ORDER BY category) AS category_sk FROM (SELECT DISTINCT category FROM prod))
    SELECT category_sk, c.category, COUNT(*) AS items_count, CAST(SUM(price) AS DOUBLE) AS revenue FROM item JOIN prod USING (product_id) JOIN c USING (category) GROUP BY ALL""")
def snowflake(t: Tables):
    """The product dimension holds the key of a category dimension of its own."""
    categories = written(M.build_dim(t.products.select("category").distinct(), "category", [], "category_sk"), "categories")
    products = t.products.select("product_id", "category").join(categories, "category").select("product_id", "category_sk")
    sums = t.items.select("product_id", "price").join(products, "product_id").groupBy("category_sk").agg(
        F.count(F.lit(1)).alias("items_count"), dbl(F.sum("price")).alias("revenue"))
    return sums.join(categories, "category_sk").select("category_sk", "category", "items_count", "revenue")


@query("m10_factless_activity", "ord cust", """SELECT CAST(purchased_at AS DATE) AS day, COUNT(DISTINCT customer_id) AS active_customers, COUNT(DISTINCT state) AS active_states FROM ord JOIN cust USING (customer_id) GROUP BY 1""")
def factless_activity(t: Tables):
    """A fact without measures: a customer was active on a day. Counting its rows is the measure."""
    active = t.orders.select("customer_id", F.to_date("purchased_at").alias("day")).distinct()
    return active.join(t.customers.select("customer_id", "state"), "customer_id").groupBy("day").agg(
        F.count(F.lit(1)).alias("active_customers"), F.countDistinct("state").alias("active_states"))


@query("m10_bridge_weights", "item", "SELECT order_id, product_id, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY order_id) AS weight FROM item GROUP BY 1, 2")
def bridge(t: Tables):
    return M.bridge_weights(t.items, "order_id", "product_id")


@query("m11_order_finance", "fin cust", """SELECT f.order_id, f.order_status, f.purchased_at, f.customer_id, c.state, f.items_count, CAST(f.product_value AS DOUBLE) AS product_value, CAST(f.freight_value AS DOUBLE) AS freight_value,
    CAST(f.payment_value AS DOUBLE) AS payment_value, f.delivered_late FROM fin f JOIN cust c USING (customer_id)""")
def order_finance(t: Tables):
    return t.finance.join(t.customers.select("customer_id", "state"), "customer_id").select(
        "order_id", "order_status", "purchased_at", "customer_id", "state", "items_count", dbl("product_value").alias("product_value"),
        dbl("freight_value").alias("freight_value"), dbl("payment_value").alias("payment_value"), "delivered_late")


@query("m12_customer_segments", "ord cust", """WITH s AS (SELECT customer_id, COUNT(order_id) AS orders_count, COALESCE(CAST(SUM(amount) AS DOUBLE), 0.0) AS lifetime_value FROM cust LEFT JOIN ord USING (customer_id) GROUP BY 1)
    SELECT *, CASE orders_count WHEN 0 THEN 'unknown' ELSE CASE WHEN lifetime_value = (SELECT MAX(lifetime_value) FROM s) THEN 'VIP' WHEN orders_count = 1 THEN 'regular' ELSE 'loyal' END END AS segment FROM s""")
def segments(t: Tables):
    summary = t.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders_count"), F.sum("amount").alias("lifetime_value"))
    return M.customer_segments(t.customers, summary, "customer_id")


@query("m12_customer_summary", "ord cust", """WITH c AS (SELECT customer_id FROM cust UNION ALL SELECT -customer_id FROM cust WHERE customer_id % 10 = 3),
    s AS (SELECT customer_id, COUNT(order_id) AS orders_count, COALESCE(CAST(SUM(amount) AS DOUBLE), 0.0) AS lifetime_value FROM c LEFT JOIN ord USING (customer_id) GROUP BY 1)
    SELECT *, CASE orders_count WHEN 0 THEN 'unknown' ELSE CASE WHEN lifetime_value = (SELECT MAX(lifetime_value) FROM s) THEN 'VIP' WHEN orders_count = 1 THEN 'regular' ELSE 'loyal' END END AS segment FROM s""")
def customer_summary(t: Tables):
    # every order counts; customers without orders are added ones, with negative ids
    ids = t.customers.select("customer_id")
    added = ids.filter(F.pmod("customer_id", F.lit(10)) == 3).select((-F.col("customer_id")).alias("customer_id"))
    summary = t.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders_count"), F.sum("amount").alias("lifetime_value"))
    return M.customer_segments(ids.unionByName(added), summary, "customer_id")


@query("m13_top_deal", "trade", """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY secid, day, side ORDER BY value DESC, shipped_at, order_id, item_id, product_id, seller_id) AS rn FROM trade)
    SELECT secid, day, side, CAST(value AS DOUBLE) AS value, quantity, order_id, item_id, seller_id FROM r WHERE rn = 1""")
def top_deal(t: Tables):
    return M.top_deal(t.trades).select("secid", "day", "side", dbl("value").alias("value"), "quantity", "order_id", "item_id", "seller_id")


BARS = """bars AS (SELECT secid, day, COUNT(*) AS trades, CAST(SUM(quantity) AS BIGINT) AS quantity, SUM(value) AS value, first(value ORDER BY shipped_at, order_id, item_id, product_id, seller_id, value) AS open, MAX(value) AS high, MIN(value) AS low,
    last(value ORDER BY shipped_at, order_id, item_id, product_id, seller_id, value) AS close FROM trade GROUP BY 1, 2)"""


def money_out(df, *cols):
    return df.withColumns({c: dbl(c) for c in cols})


@query("m14_daily_bars", "trade", f"""WITH {BARS} SELECT secid, day, trades, quantity, CAST(value AS DOUBLE) AS value, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(LAG(close) OVER w AS DOUBLE) AS previous_close, CAST(close - LAG(close) OVER w AS DOUBLE) AS abs_change, DENSE_RANK() OVER (PARTITION BY day ORDER BY bars.value DESC) AS liquidity_rank,
    100 * CAST(close - LAG(close) OVER w AS DOUBLE) / nullif(CAST(LAG(close) OVER w AS DOUBLE), 0) AS change_pct FROM bars WINDOW w AS (PARTITION BY secid ORDER BY day)""")
def bars(t: Tables):
    return money_out(M.with_changes(M.daily_bars(t.trades)), "value", "open", "high", "low", "close", "previous_close", "abs_change")


@query("m15_monthly_bars", "trade", f"""WITH {BARS} SELECT 'month' AS mart, secid, CAST(strftime(day, '%Y%m') AS BIGINT) AS period, COUNT(*) AS days, CAST(SUM(trades) AS BIGINT) AS trades, CAST(SUM(value) AS DOUBLE) AS value FROM bars GROUP BY 2, 3
    UNION ALL SELECT 'season', secid, month(day), COUNT(*), CAST(SUM(trades) AS BIGINT), CAST(SUM(value) AS DOUBLE) FROM bars GROUP BY 2, 3""")
def monthly_bars(t: Tables):
    days = M.daily_bars(t.trades)
    month = M.monthly_bars(days).select(F.lit("month").alias("mart"), "secid", F.date_format("month", "yyyyMM").cast("long").alias("period"), F.col("trading_days").alias("days"), "trades", dbl("value").alias("value"))
    return month.unionByName(M.seasonality(days).select(F.lit("season").alias("mart"), "secid", F.col("month_num").alias("period"), F.col("active_days").alias("days"), "trades", dbl("value").alias("value")))


@query("m16_listing_marts", "item prod", """SELECT p.category, COUNT(*) AS listings, COUNT(DISTINCT i.seller_id) AS sellers, CAST(MIN(i.price) AS DOUBLE) AS min_price, CAST(MAX(i.price) AS DOUBLE) AS max_price, CAST(SUM(i.price) AS DOUBLE) / COUNT(*) AS avg_price,
    quantile_cont(CAST(i.price AS DOUBLE), 0.5) AS median_price, CAST(COUNT(*) FILTER (WHERE i.freight = 0) AS DOUBLE) / COUNT(*) AS free_shipping_share FROM item i JOIN prod p USING (product_id) GROUP BY 1""")
def listing_marts(t: Tables):
    rows = t.items.select("product_id", "seller_id", "price", "freight").join(t.products.select("product_id", "category"), "product_id")
    stats = rows.groupBy("category").agg(
        F.count(F.lit(1)).alias("listings"), F.countDistinct("seller_id").alias("sellers"), dbl(F.min("price")).alias("min_price"), dbl(F.max("price")).alias("max_price"),
        (dbl(F.sum("price")) / F.count(F.lit(1))).alias("avg_price"), (dbl(F.count_if(F.col("freight") == 0)) / F.count(F.lit(1))).alias("free_shipping_share"))
    median = exact_percentile(rows, ["category"], "price", 0.5, "median_price").withColumnRenamed("category", "_c")
    return stats.join(median, F.col("category").eqNullSafe(F.col("_c")), "left").drop("_c")  # listings without a category are one too


@query("m16_normalised_prices", "item prod", """WITH r AS (SELECT flag AS currency, starts, CAST(1 + (CAST(strftime(starts, '%Y') AS INTEGER) * 4 + quarter(starts)) % 9 * 0.05 + ascii(flag) % 5 * 0.1 AS DECIMAL(9,4)) AS rate FROM (SELECT DISTINCT flag, date_trunc('quarter', shipped_at) AS starts FROM item) WHERE flag <> 'N'),
    x AS (SELECT p.category, i.price, i.flag, CASE WHEN flag = 'N' THEN CAST(1 AS DECIMAL(9,4)) ELSE (SELECT rate FROM r WHERE r.currency = i.flag AND r.starts = date_trunc('quarter', i.shipped_at)) END AS rate FROM item i JOIN prod p USING (product_id))
    SELECT category, flag AS currency, COUNT(*) AS listings, CAST(SUM(price) AS DOUBLE) AS listed, CAST(SUM(ROUND(price * rate, 2)) AS DOUBLE) AS normalised FROM x GROUP BY 1, 2""")
def normalised_prices(t: Tables):
    """Listing prices in one currency, by the rate that held on the day; a rate holds until the next one of its currency."""
    rows = t.items.select("product_id", "order_id", "item_id", "seller_id", "price", "quantity", "freight", "shipped_at", F.col("flag").alias("currency"))
    rows = rows.join(t.products.select("product_id", "category"), "product_id")
    starts = F.date_trunc("quarter", "shipped_at").cast("timestamp_ntz")
    step = F.pmod(F.year("starts") * 4 + F.quarter("starts"), F.lit(9)) * F.lit("0.05").cast("decimal(3,2)")
    rates = (t.items.filter("flag <> 'N'").select(F.col("flag").alias("currency"), starts.alias("starts")).distinct()
             .withColumn("rate", (1 + step + F.ascii("currency") % 5 * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(9,4)")))
    priced = M.normalised(rows, rates, "price", "currency", "shipped_at", "starts", "N",
                          ["order_id", "item_id", "product_id", "seller_id", "price", "quantity", "freight"])
    return priced.groupBy("category", "currency").agg(F.count(F.lit(1)).alias("listings"), dbl(F.sum("price")).alias("listed"),
                                                      dbl(F.sum("price_normalised")).alias("normalised"))


@query("m16_seller_mart", "item seller", """SELECT s.seller_id, s.state, COUNT(i.order_id) AS listings, CAST(SUM(i.price) AS DOUBLE) AS revenue, CAST(COUNT(*) FILTER (WHERE i.freight = 0) AS DOUBLE) / COUNT(*) AS free_shipping_share FROM seller s JOIN item i USING (seller_id) GROUP BY 1, 2""")
def seller_mart(t: Tables):
    sales = t.items.groupBy("seller_id").agg(F.count("order_id").alias("listings"), dbl(F.sum("price")).alias("revenue"), (dbl(F.count_if(F.col("freight") == 0)) / F.count(F.lit(1))).alias("free_shipping_share"))
    return t.sellers.select("seller_id", "state").join(sales, "seller_id")


@query("m17_incremental_refresh", "trade", f"""WITH {BARS} SELECT 'day' AS mart, secid, day, trades, CAST(value AS DOUBLE) AS value FROM bars UNION ALL SELECT 'month', secid, CAST(date_trunc('month', day) AS DATE), CAST(SUM(trades) AS BIGINT), CAST(SUM(value) AS DOUBLE) FROM bars GROUP BY 2, 3""")
def incremental_refresh(t: Tables):
    # trades of two weeks arrive late; facts and marts are stored by month
    late = (F.col("side") == "A") & (F.col("day") >= F.lit("2000-05-01").cast("date")) & (F.col("day") < F.lit("2000-05-15").cast("date"))
    facts, days, months = (scratch_path(t.spark, p) for p in ("trades-by-month", "bars-by-month", "months"))
    trades = t.trades.withColumn("month", M.month_text())
    storage.write_partitioned(trades.filter(~late), facts, ["month"])
    M.store_bars(storage.read_partitioned(t.spark, facts), days, months)
    change = written(trades.filter(late), "late-trades")
    storage.write_partitioned(change, facts, ["month"], "append")
    M.refresh_stored_bars(t.spark, facts, days, months, change)
    a, b = storage.read_partitioned(t.spark, days), storage.read_partitioned(t.spark, months)
    first = F.to_date(F.concat("month", F.lit("-01"))).alias("day")
    return a.select(F.lit("day").alias("mart"), "secid", "day", "trades", dbl("value").alias("value")).unionByName(
        b.select(F.lit("month").alias("mart"), "secid", first, "trades", dbl("value").alias("value")))


@query("m18_mart_catalog", "ord item", f"""WITH v AS (SELECT 'orders' AS mart, 1::BIGINT AS version, 'READY' AS status, COUNT(*) AS row_count, COUNT(DISTINCT order_id) AS key_count, CAST({checksum_sql('order_id', 'order_status')} AS VARCHAR) AS checksum FROM ord WHERE order_status <> 'P'
    UNION ALL SELECT 'orders', 2, 'READY', COUNT(*), COUNT(DISTINCT order_id), CAST({checksum_sql('order_id', 'order_status')} AS VARCHAR) FROM ord
    UNION ALL SELECT 'items', 1, 'READY', COUNT(*), COUNT(DISTINCT order_id), CAST({checksum_sql('order_id', 'flag')} AS VARCHAR) FROM item)
    SELECT mart, 'order_id' AS grain, version, CASE WHEN row_count = key_count THEN 'PUBLISHED' ELSE status END AS status, row_count, key_count, checksum, row_count = key_count AND version = 2 AS served FROM v""")
def mart_catalog(t: Tables):
    texts = ["order_id", "order_status"]
    one = M.catalog_entry(t.orders.filter("order_status <> 'P'"), "orders", 1, "READY", ["order_id"], texts)
    two = M.catalog_entry(t.orders, "orders", 2, "READY", ["order_id"], texts)
    bad = M.catalog_entry(t.items, "items", 1, "READY", ["order_id"], ["order_id", "flag"])  # several rows per key: stays unpublished
    return M.latest_published(one.unionByName(two).unionByName(bad))


@query("m19_enrichment", "fin cust item", """WITH r AS (SELECT seller_id, DENSE_RANK() OVER (ORDER BY SUM(price) DESC) AS seller_rank FROM item GROUP BY 1), s AS (SELECT state, COUNT(*) AS state_orders FROM fin JOIN cust USING (customer_id) GROUP BY 1),
    p AS (SELECT DISTINCT order_id, seller_id FROM item) SELECT p.order_id, p.seller_id, CAST(f.payment_value AS DOUBLE) AS order_total, r.seller_rank, s.state_orders, date_diff('day', f.purchased_at, f.delivered_at) AS delivery_days
    FROM p JOIN fin f USING (order_id) JOIN cust c USING (customer_id) JOIN s USING (state) JOIN r USING (seller_id)""")
def enrichment(t: Tables):
    # both sides are read twice, items and orders once: sums per order and seller serve ranks and orders
    sold = written(t.items.groupBy("order_id", "seller_id").agg(F.sum("price").alias("price"), F.sum("freight").alias("freight"),
                                                                F.max("shipped_at").alias("shipped_at")), "sold")
    totals = sold.groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight")).alias("payment_value"), F.max("shipped_at").alias("delivered_at"))
    orders = t.orders.select("order_id", "customer_id", "purchased_at").join(t.customers.select("customer_id", "state"), "customer_id")
    placed = written(orders.join(totals, "order_id", "left"), "placed")
    states = placed.groupBy(F.col("state").alias("_s")).agg(F.count(F.lit(1)).alias("state_orders"))
    rows = sold.select("order_id", "seller_id").join(placed, "order_id").join(states, F.col("state").eqNullSafe(F.col("_s")))
    return rows.join(M.seller_ranks(sold).select("seller_id", "seller_rank"), "seller_id").select(
        "order_id", "seller_id", dbl("payment_value").alias("order_total"), "seller_rank", "state_orders",
        timeops.calendar_days(F.col("delivered_at"), F.col("purchased_at")).alias("delivery_days"))


@query("m20_entitled_rows", "cust", r"""SELECT customer_id, state, lower(customer_name)[1] || repeat('*', 3) || '@mail.example' AS email FROM cust WHERE state IN (SELECT n_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA')""")
def entitled_rows(t: Tables):
    # each user may see the states of one region
    user_map = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("user_name"), F.col("n_name").alias("state"))
    mail = text.mask_email(F.concat(F.lower("customer_name"), F.lit("@mail.example")))
    return M.entitled(t.customers, user_map, "ASIA", "state", {"customer_id": F.col("customer_id"), "state": F.col("state"), "email": mail})


@query("m18_mart_reconciliation", "trade", f"""WITH {BARS}, m AS (SELECT secid, date_trunc('month', day) AS month, SUM(value) AS value, SUM(trades) AS trades FROM bars GROUP BY 1, 2)
    SELECT CAST((SELECT SUM(value) FROM trade) AS DOUBLE) AS fact_value, CAST((SELECT SUM(value) FROM bars) AS DOUBLE) AS daily_value, CAST((SELECT SUM(value) FROM m) AS DOUBLE) AS monthly_value,
    (SELECT COUNT(*) FROM trade) AS fact_trades, CAST((SELECT SUM(trades) FROM bars) AS BIGINT) AS daily_trades, CAST((SELECT SUM(trades) FROM m) AS BIGINT) AS monthly_trades, 0::BIGINT AS missing_groups, true AS reconciled""")
def mart_reconciliation(t: Tables):
    days = M.daily_bars(t.trades)
    return M.reconcile_marts(t.trades, days, M.monthly_bars(days))
