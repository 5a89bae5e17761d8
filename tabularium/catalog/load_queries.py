"""Batch load queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.catalog.quality_queries import DIRTY, ORDER_VERSIONS, dirty_events, event_rules, order_versions
from tabularium.catalog.registry import query
from tabularium.functions import text
from tabularium.operators import quality as Q
from tabularium.plans import loads as L
from tabularium.session import scratch_path
from tabularium.sources.stored import StoredTable
from tabularium.tables import Tables, dbl, money

CUT = "1998-01-01"


def ntz(s: str):
    return F.lit(s).cast("timestamp_ntz")


def halves(t: Tables):
    """Orders loaded before the cut, and the whole source."""
    src = t.orders.select("order_id", "customer_id", "order_status", "purchased_at", "amount")
    return src.filter(F.col("purchased_at") < ntz(CUT)), src


def plain(df):
    return df.withColumn("amount", dbl("amount"))


@query("e1_land", "ord", """SELECT order_id, order_status, 'batch-1' AS batch_id, 'orders' AS source_name, md5(concat_ws('|', CAST(order_id AS VARCHAR), order_status)) AS source_hash FROM ord""")
def land(t: Tables):
    return L.land(t.orders.select("order_id", "order_status"), "batch-1", "orders", ["order_id", "order_status"])


def order_text(t: Tables):
    p = F.col("priority")
    return t.orders.select(
        F.when(p == "1-URGENT", "  ").otherwise(F.concat(F.lit(" "), F.col("order_id").cast("string"), F.lit(" "))).alias("order_id"),
        F.concat(F.lit(" "), "order_status").alias("order_status"),
        F.when(p == "2-HIGH", "unknown").otherwise(F.date_format("purchased_at", "yyyy-MM-dd HH:mm:ss")).alias("purchased_at"),
        F.col("amount").cast("string").alias("amount"))


def typed_orders(df):
    at = text.clean_text(F.col("purchased_at"))
    return df.select(text.clean_text(F.col("order_id")).try_cast("bigint").alias("order_id"), F.lower(text.clean_text(F.col("order_status"))).alias("order_status"),
                     F.when(at.rlike(text.DATE_SHAPE), at.try_cast("timestamp_ntz")).alias("purchased_at"), F.col("amount").try_cast("decimal(18,2)").alias("amount"))


def order_rules():
    return [Q.Rule("key_missing", "critical", F.col("order_id").isNull()), Q.Rule("date_bad", "critical", F.col("purchased_at").isNull())]


@query("e2_stage", "ord", """SELECT 'accepted' AS outcome, order_id, lower(order_status) AS order_status, purchased_at, CAST(amount AS DOUBLE) AS amount, NULL AS reason FROM ord WHERE priority NOT IN ('1-URGENT', '2-HIGH')
    UNION ALL SELECT 'rejected', CASE WHEN priority = '1-URGENT' THEN NULL ELSE order_id END, NULL, NULL, NULL, CASE WHEN priority = '1-URGENT' THEN 'key_missing' ELSE 'date_bad' END FROM ord WHERE priority IN ('1-URGENT', '2-HIGH')""")
def stage(t: Tables):
    ok, bad = Q.split_valid(typed_orders(order_text(t)), order_rules(), "order_id", "batch-1")
    good = plain(ok).select(F.lit("accepted").alias("outcome"), "*", F.lit(None).cast("string").alias("reason"))
    return good.unionByName(bad.select(F.lit("rejected").alias("outcome"), F.col("business_key").cast("bigint").alias("order_id"), "reason"), allowMissingColumns=True)


@query("e3_insert_new", "ord", """SELECT order_id, customer_id, order_status, purchased_at, CAST(amount AS DOUBLE) AS amount FROM ord
    UNION ALL SELECT NULL, customer_id, order_status, purchased_at, CAST(amount AS DOUBLE) FROM ord WHERE order_id = 1""")
def insert_new(t: Tables):
    # the source sends every row twice and one row without a key; a rerun adds nothing
    target, src = halves(t)
    sent = src.unionAll(src).unionByName(src.filter("order_id = 1").withColumn("order_id", F.when(F.col("order_status") == "none", F.col("order_id"))))
    table = StoredTable.create(target, scratch_path(t.spark, "orders"))
    for _ in range(2):
        L.append_missing(table, sent, "order_id")  # the target's files stay, of its rows only the keys are read
    return plain(table.read())


@query("e4_merge", "ord", f"""WITH t AS (SELECT * FROM ord WHERE purchased_at < TIMESTAMP '{CUT}'), s AS (SELECT order_id, customer_id, CASE WHEN priority = '1-URGENT' THEN 'X' ELSE order_status END AS order_status, purchased_at, amount FROM ord WHERE order_status <> 'P')
    SELECT COALESCE(s.order_id, t.order_id) AS order_id, COALESCE(s.customer_id, t.customer_id) AS customer_id, COALESCE(s.order_status, t.order_status) AS order_status, COALESCE(s.purchased_at, t.purchased_at) AS purchased_at, CAST(COALESCE(s.amount, t.amount) AS DOUBLE) AS amount,
    CASE WHEN t.order_id IS NULL THEN 'inserted' WHEN s.order_id IS NOT NULL AND s.order_status <> t.order_status THEN 'updated' ELSE 'kept' END AS action FROM t FULL JOIN s ON s.order_id = t.order_id""")
def merge(t: Tables):
    target, src = halves(t)
    urgent = t.orders.filter("priority = '1-URGENT'").select("order_id", F.lit(True).alias("urgent"))
    changed = src.filter("order_status <> 'P'").join(urgent, "order_id", "left").withColumn(
        "order_status", F.when(F.col("urgent"), "X").otherwise(F.col("order_status"))).drop("urgent")
    return plain(L.merge(target, changed, "order_id", ["customer_id", "order_status", "purchased_at", "amount"], note="action"))


@query("e4_stored_merge", "ord", f"""WITH t AS (SELECT * FROM ord WHERE purchased_at < TIMESTAMP '{CUT}'), s AS (SELECT order_id, customer_id, CASE WHEN customer_id % 100 = 7 THEN 'X' ELSE order_status END AS order_status, purchased_at, amount FROM ord)
    SELECT 'table' AS part, order_id, customer_id, order_status, purchased_at, CAST(amount AS DOUBLE) AS amount, NULL AS action FROM s UNION ALL
    SELECT 'report', order_id, NULL, NULL, NULL, NULL, CASE WHEN t.order_id IS NULL THEN 'inserted' WHEN s.order_status <> t.order_status THEN 'updated' ELSE 'kept' END FROM s LEFT JOIN t USING (order_id)""")
def stored_merge(t: Tables):
    # the source sends every order, those of some customers with another status; only files that hold these are rewritten
    target, src = halves(t)
    table = StoredTable.create(target, scratch_path(t.spark, "orders"), ["customer_id"])
    status = F.when(F.col("customer_id") % 100 == 7, "X").otherwise(F.col("order_status"))
    report = table.merge(src.withColumn("order_status", status), "order_id", ["customer_id", "order_status", "purchased_at", "amount"])
    return plain(table.read()).select(F.lit("table").alias("part"), "*").unionByName(
        report.select(F.lit("report").alias("part"), "*"), allowMissingColumns=True)


@query("e5_reload_slice", "ord", f"""SELECT order_id, order_status, purchased_at, CAST(CASE WHEN purchased_at >= TIMESTAMP '1997-05-01' AND purchased_at < TIMESTAMP '1997-06-01' THEN amount + 10 ELSE amount END AS DOUBLE) AS amount FROM ord""")
def reload_slice(t: Tables):
    rows = t.orders.select("order_id", "order_status", "purchased_at", "amount")
    src = rows.withColumn("amount", money(F.col("amount") + 10))
    table = StoredTable.create(rows, scratch_path(t.spark, "orders"), ["purchased_at"])  # so that a month lies in few files
    for _ in range(2):  # the second run gives the same rows
        L.reload_stored_slice(table, src, "purchased_at", ntz("1997-05-01"), ntz("1997-06-01"))
    return plain(table.read())


@query("e6_full_refresh", "ord", """SELECT COUNT(*) AS source_rows, COUNT(*) AS target_rows, CAST(SUM(amount) AS DOUBLE) AS source_amount, CAST(SUM(amount) AS DOUBLE) AS target_amount, 0::BIGINT AS missing_keys, 0::BIGINT AS extra_keys, 0::BIGINT AS differing_keys, true AS equal FROM ord""")
def full_refresh(t: Tables):
    _, report = L.full_refresh(t.orders, ["order_id"], ["amount"], ["order_id", "customer_id", "order_status"])
    return report.drop("source_checksum", "target_checksum")


@query("e7_increment", "", """WITH e AS (SELECT event_id, ts, CASE WHEN event_type = 'signup' THEN ts - INTERVAL 15 DAY ELSE ts END AS updated_at FROM events), l AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-20'),
    m AS (SELECT updated_at AS last_at, event_id AS last_id FROM l ORDER BY updated_at DESC, event_id DESC LIMIT 1) SELECT 'tuple' AS form, event_id FROM e, m WHERE (updated_at, event_id) > (last_at, last_id)
    UNION ALL SELECT 'with_late', event_id FROM e, m WHERE updated_at > last_at OR event_id > last_id UNION ALL SELECT 'first_load', event_id FROM e""")
def increment(t: Tables):
    # signups carry a time of two weeks before they arrive
    rows = t.events.select("event_id", F.when(F.col("event_type") == "signup", F.col("ts") - F.expr("INTERVAL 15 DAYS")).otherwise(F.col("ts")).alias("at"), "ts")
    mark = L.mark_of(rows.filter(F.col("ts") < ntz("2024-01-20")), "at", "event_id")
    a = L.increment(rows, mark, "at", "event_id").select(F.lit("tuple").alias("form"), "event_id")
    b = L.increment(rows, mark, "at", "event_id", late=True).select(F.lit("with_late").alias("form"), "event_id")
    first = L.increment(rows, L.mark_of(rows.limit(0), "at", "event_id"), "at", "event_id")
    return a.unionByName(b).unionByName(first.select(F.lit("first_load").alias("form"), "event_id"))


@query("e8_advance_mark", "", """SELECT 'failed' AS run, max(ts) AS last_at, max(event_id) AS last_id FROM events WHERE ts < TIMESTAMP '2024-01-20' UNION ALL SELECT 'succeeded', max(ts), max(event_id) FROM events""")
def advance_mark(t: Tables):
    table, rows = marked_events(t)
    batch = L.increment(rows, L.stored_mark(table, "ts", "event_id"), "ts", "event_id")
    table.put(batch)  # a run that dies here has written its rows and no record
    failed = L.stored_mark(table, "ts", "event_id")
    L.load_increment(table, rows, "ts", "event_id")
    return failed.select(F.lit("failed").alias("run"), "*").unionByName(
        L.stored_mark(table, "ts", "event_id").select(F.lit("succeeded").alias("run"), "*"))


def marked_events(t: Tables):
    """Events loaded up to a day, with the mark of that load, and the whole source."""
    rows = t.events.select("event_id", "ts")
    loaded = rows.filter(F.col("ts") < ntz("2024-01-20"))
    mark = L.mark_text(L.mark_of(loaded, "ts", "event_id"))
    return StoredTable.create(loaded, scratch_path(t.spark, "events"), mark=mark), rows


@query("e8_repeated_runs", "", "SELECT event_id, ts FROM events")
def repeated_runs(t: Tables):
    """Rows and mark are one record: runs that die before it, and runs that are repeated, leave every event once."""
    table, rows = marked_events(t)
    for _ in range(2):
        table.put(L.increment(rows, L.stored_mark(table, "ts", "event_id"), "ts", "event_id"))
        L.load_increment(table, rows, "ts", "event_id")
    return table.read()


@query("e9_late_overlap", "", """WITH seen AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'signup'), w AS (SELECT max(ts) AS wm FROM seen) SELECT event_id, ts, event_type FROM seen UNION ALL
    SELECT event_id, ts, event_type FROM events, w WHERE ts >= wm - INTERVAL 2 DAY AND event_id NOT IN (SELECT event_id FROM seen)""")
def late_overlap(t: Tables):
    src = t.events.select("event_id", "ts", "event_type")
    seen = src.filter((F.col("ts") < ntz("2024-01-20")) & (F.col("event_type") != "signup"))  # signups arrive late
    return L.increment_overlap(seen, src, "ts", "event_id", F.expr("INTERVAL 2 DAYS"))


@query("e10_run_log", "", f"""WITH d AS ({DIRTY}), n AS (SELECT COUNT(*) AS every, COUNT(*) FILTER (WHERE user_id IS NULL OR value < 0 OR day = 'soon') AS bad, COUNT(DISTINCT CASE WHEN user_id IS NULL OR value < 0 OR day = 'soon' THEN NULL ELSE day END) AS days FROM d)
    SELECT 'raw' AS stage, 1 AS attempt, 'SUCCESS' AS status, every AS rows_read, every AS rows_written, 0::BIGINT AS rows_rejected, true AS took_time FROM n
    UNION ALL SELECT 'quality', 1, 'SUCCESS', every, every - bad, bad, true FROM n UNION ALL SELECT 'mart', 1, 'SUCCESS', days, days, 0, true FROM n""")
def run_log(t: Tables):
    def quality(): return Q.split_valid(dirty_events(t), event_rules(), "event_id", "run-1")
    def mart(): return quality()[0].groupBy("day").agg(F.count(F.lit(1)).alias("n")), None
    log = L.run_log(t.spark, "run-1", [L.Stage("raw", lambda: (dirty_events(t), None)), L.Stage("quality", quality), L.Stage("mart", mart)])
    return log.select("stage", "attempt", "status", "rows_read", "rows_written", "rows_rejected", (F.col("duration_s") > 0).alias("took_time"))


@query("e11_update", "ord cust", """SELECT o.order_id, CASE WHEN o.order_status = 'P' THEN 'O' ELSE o.order_status END AS order_status, CAST(CASE WHEN c.state = 'FRANCE' OR c.city = 'MACHINERY' THEN ROUND(o.amount * CAST(0.9 AS DECIMAL(2,1)), 2) ELSE o.amount END AS DOUBLE) AS amount FROM ord o JOIN cust c USING (customer_id)""")
def update(t: Tables):
    rows = t.orders.select("order_id", "customer_id", "order_status", "amount")
    opened = L.update(rows, F.col("order_status") == "P", {"order_status": F.lit("O")})
    discounted = F.round(F.col("amount") * F.lit("0.9").cast("decimal(2,1)"), 2)
    cut = L.update_from(opened, t.customers.select("customer_id", "state", "city"), "customer_id",
                        (F.col("state") == "FRANCE") | (F.col("city") == "MACHINERY"), {"amount": discounted})
    return plain(cut).drop("customer_id")


@query("e12_delete", "ord", "SELECT order_id, nullif(order_status, 'P') AS order_status FROM ord WHERE order_status <> 'F'")
def delete(t: Tables):
    return L.delete(t.orders.select("order_id", F.nullif("order_status", F.lit("P")).alias("order_status")), F.col("order_status") == "F")


@query("e13_archive", "ord", f"SELECT order_id, CASE WHEN purchased_at < TIMESTAMP '{CUT}' THEN 'cold' ELSE 'hot' END AS part FROM ord")
def archive(t: Tables):
    hot, cold = L.archive(t.orders, F.col("purchased_at") < ntz(CUT))
    return hot.select("order_id", F.lit("hot").alias("part")).unionByName(cold.select("order_id", F.lit("cold").alias("part")))


@query("e14_append", "ord", """SELECT order_status AS event_name, COUNT(*) AS amount, 'counted' AS message FROM ord GROUP BY 1 UNION ALL
    SELECT order_status, k + 1, 'batch_' || (k + 1) FROM (SELECT order_status, COUNT(*) AS n FROM ord GROUP BY 1), range(5) r(k)""")
def append(t: Tables):
    counts = t.orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("amount"))
    log = counts.select(F.col("order_status").alias("event_name"), "amount", F.lit("counted").alias("message"))
    made = counts.select(F.col("order_status").alias("event_name"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(5).cast("long"))).alias("amount"))
    path = scratch_path(t.spark, "log")
    log.write.parquet(path)
    # new files beside the old ones: what is there is neither read nor rewritten
    L.append(t.spark, path, made.withColumn("message", F.concat(F.lit("batch_"), F.col("amount").cast("string"))).select(log.columns))
    return t.spark.read.schema(log.schema).parquet(path)


@query("e15_guarded_load", "item", "SELECT order_id, item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price FROM item")
def guarded_load(t: Tables):
    rows = L.require(t.items, F.col("price") >= 0, "price must not be negative")
    rows = L.require(rows, F.col("quantity").between(0, 100), "quantity out of range")
    return rows.select("order_id", "item_id", "product_id", "seller_id", dbl("price").alias("price"))


@query("e16_ledger", "cust", """WITH p AS (SELECT event_id AS operation_id, user_id AS from_account, (user_id + 1) % 150 AS to_account, CAST(value AS DECIMAL(18,2)) AS amount FROM events WHERE event_type = 'purchase'),
    c AS (SELECT from_account AS account_id, -amount AS change FROM p UNION ALL SELECT to_account, amount FROM p), s AS (SELECT account_id, SUM(change) AS change FROM c GROUP BY 1)
    SELECT customer_id AS account_id, CAST(balance + COALESCE(change, 0) AS DOUBLE) AS balance FROM cust LEFT JOIN s ON account_id = customer_id""")
def ledger(t: Tables):
    sent = t.events.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("operation_id"), F.col("user_id").alias("from_account"), F.pmod(F.col("user_id") + 1, F.lit(150)).alias("to_account"), money("value").alias("amount"))
    accounts = t.customers.select(F.col("customer_id").alias("account_id"), "balance")
    return L.apply_operations(accounts, sent.unionByName(sent)).withColumn("balance", dbl("balance"))  # every operation sent twice


@query("e17_snapshot", "ord", """SELECT DATE '1997-12-31' AS as_of_date, customer_id, COUNT(*) AS orders_count FROM ord WHERE purchased_at < TIMESTAMP '1998-01-01' GROUP BY 2 UNION ALL
    SELECT DATE '1996-12-31', customer_id, COUNT(*) FROM ord WHERE purchased_at < TIMESTAMP '1997-01-01' GROUP BY 2""")
def snapshot(t: Tables):
    empty = t.spark.createDataFrame([], "as_of_date date, customer_id long, orders_count long")
    table = StoredTable.create(empty, scratch_path(t.spark, "snapshots"))
    for day in ("1996-12-31", "1997-12-31", "1996-12-31"):  # the first date is built again
        L.store_snapshot(table, t.orders, "customer_id", "purchased_at", day)
    return table.read()


@query("e18_layered_load", "ord", f"""WITH {ORDER_VERSIONS}, r AS (SELECT v.*, o.priority FROM v JOIN ord o USING (order_id)), a AS (SELECT * FROM r WHERE priority <> '2-HIGH')
    SELECT 'raw' AS layer, COUNT(*) AS rows_count FROM r UNION ALL SELECT 'staging', COUNT(*) FROM r UNION ALL SELECT 'accepted', COUNT(*) FROM a UNION ALL
    SELECT 'rejected', COUNT(*) FROM r WHERE priority = '2-HIGH' UNION ALL SELECT 'core', COUNT(DISTINCT order_id) FROM a""")
def layered(t: Tables):
    bad = t.orders.filter("priority = '2-HIGH'").select("order_id", F.lit("no date").alias("day"))
    raw = order_versions(t).join(bad, "order_id", "left").withColumn("day", F.coalesce("day", F.lit("1998-01-01"))).withColumn("amount", F.col("amount").cast("string"))
    def typed(df): return df.withColumn("amount", F.col("amount").try_cast("decimal(18,2)"))
    rules = [Q.Rule("day_shape", "critical", ~F.col("day").rlike(text.DATE_SHAPE)), Q.Rule("amount_missing", "critical", F.col("amount").isNull())]
    return L.layer_counts(raw, L.layered_load(raw, typed, rules, "order_id", [F.col("version").desc()], "run-1"))
