"""Deduplication and data-quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.catalog.registry import query
from tabularium.functions import text
from tabularium.operators import quality as Q
from tabularium.plans.marts import snapshot_quality as snapshot_quality_of
from tabularium.tables import Tables, dbl

KEY = ["order_id", "item_id"]
TIE = ["product_id", "seller_id", "price", "flag", "quantity", "shipped_at", "freight"]
TIES = "product_id, seller_id, price, flag, quantity, shipped_at, freight"
PROFILED = {"order_status": "o_orderstatus", "priority": "o_orderpriority", "customer_id": "o_custkey", "order_id": "o_orderkey"}


def _profile_sql(name: str, col: str) -> str:
    return f"""SELECT '{name}' AS column_name, CAST(SUM(n) AS BIGINT) AS rows_count, CAST(COALESCE(SUM(CASE WHEN v IS NULL THEN n END), 0) AS BIGINT) AS nulls, COUNT(v) AS distinct_values,
        CAST(MIN(v) AS VARCHAR) AS lowest, CAST(MAX(v) AS VARCHAR) AS highest, MAX(length(CAST(v AS VARCHAR))) AS longest,
        CAST(first(v ORDER BY CASE WHEN v IS NULL THEN 1 ELSE 0 END, n DESC, v) AS VARCHAR) AS top_value, MAX(CASE WHEN v IS NOT NULL THEN n END) AS top_rows
        FROM (SELECT {col} AS v, COUNT(*) AS n FROM (SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders) GROUP BY 1)"""


@query("q1_profile", "", " UNION ALL ".join(_profile_sql(n, c) for n, c in PROFILED.items()))
def profile(t: Tables):
    rows = t.orders.withColumn("order_status", F.nullif("order_status", F.lit("P")))
    return Q.profile(rows, list(PROFILED))


@query("q2_duplicate_groups", "item", f"""SELECT 'key' AS kind, order_id, item_id, COUNT(*) AS rows_count FROM item GROUP BY order_id, item_id HAVING COUNT(*) > 1
    UNION ALL SELECT 'row', order_id, item_id, COUNT(*) FROM (SELECT order_id, item_id, flag, quantity % 2 AS half FROM item) GROUP BY order_id, item_id, flag, half HAVING COUNT(*) > 1""")
def duplicate_groups(t: Tables):
    rows = t.items.select("order_id", "item_id", "flag", (F.col("quantity") % 2).alias("half"))
    full = Q.duplicate_groups(rows, rows.columns).select(F.lit("row").alias("kind"), "order_id", "item_id", "rows_count")
    return Q.duplicate_groups(t.items, KEY).select(F.lit("key").alias("kind"), "*").unionByName(full)


@query("q3_duplicate_metrics", "item", """WITH per_key AS (SELECT COUNT(*) AS copies, COUNT(DISTINCT CASE WHEN flag <> 'N' THEN flag END) AS marks FROM item GROUP BY order_id, item_id)
    SELECT CAST(SUM(copies) AS BIGINT) AS total_rows, COUNT(*) AS unique_keys, CAST(SUM(copies - 1) AS BIGINT) AS duplicate_rows, COUNT(*) FILTER (WHERE marks >= 2) AS conflict_keys,
    ROUND(100.0::DOUBLE * CAST(SUM(copies - 1) AS BIGINT) / CAST(SUM(copies) AS BIGINT), 2) AS duplicate_pct FROM per_key""")
def duplicate_metrics(t: Tables):
    return Q.dup_metrics(t.items.withColumn("flag", F.nullif("flag", F.lit("N"))), KEY, "flag")


@query("q4_keep_one", "item", f"""WITH x AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, item_id ORDER BY shipped_at, {TIES}) AS a,
    ROW_NUMBER() OVER (PARTITION BY order_id, item_id ORDER BY (CASE WHEN flag <> 'N' THEN 1 ELSE 0 END) + (CASE WHEN quantity <> 1 THEN 1 ELSE 0 END) DESC, shipped_at DESC, {TIES}) AS b FROM item)
    SELECT 'first' AS rule, order_id, item_id, product_id, seller_id, shipped_at FROM x WHERE a = 1 UNION ALL SELECT 'most_complete', order_id, item_id, product_id, seller_id, shipped_at FROM x WHERE b = 1""")
def keep_one(t: Tables):
    tie = [F.col(c).asc() for c in TIE]
    rows = t.items.withColumn("known_flag", F.nullif("flag", F.lit("N"))).withColumn("known_quantity", F.nullif("quantity", F.lit(1)))
    cols = [*KEY, "product_id", "seller_id", "shipped_at"]
    first = Q.dedup_keep(rows, KEY, F.col("shipped_at").asc(), *tie).select(F.lit("first").alias("rule"), *cols)
    full = Q.dedup_keep(rows, KEY, Q.completeness("known_flag", "known_quantity").desc(), F.col("shipped_at").desc(), *tie)
    return first.unionByName(full.select(F.lit("most_complete").alias("rule"), *cols))


@query("q5_versions", "", """SELECT doc_id, ROW_NUMBER() OVER w AS version_no, first_value(doc_id) OVER w AS canonical_id, ROW_NUMBER() OVER w > 1 AS is_surplus
    FROM documents WINDOW w AS (PARTITION BY md5(text) ORDER BY doc_id)""")
def versions(t: Tables):
    rows = t.raw("documents").select("doc_id", F.md5("text").alias("text_key"))
    return Q.versions(rows, ["text_key"], [F.col("doc_id").asc()], "doc_id").select(
        "doc_id", "version_no", "canonical_id", (F.col("version_no") > 1).alias("is_surplus"))


@query("q6_conflicts", "item", "SELECT order_id, item_id, COUNT(DISTINCT nullif(flag, 'N')) AS distinct_values FROM item GROUP BY 1, 2 HAVING COUNT(DISTINCT nullif(flag, 'N')) > 1")
def conflicts(t: Tables):
    return Q.conflicts(t.items.withColumn("flag", F.nullif("flag", F.lit("N"))), KEY, "flag")


@query("q7_normalised_duplicates", "", r"""SELECT lang, md5(lower(trim(COALESCE(text, '')))) AS text_key, COUNT(*) AS rows_count FROM documents GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def normalised_duplicates(t: Tables):
    rows = t.raw("documents").select("lang", F.md5(F.lower(F.trim(F.coalesce("text", F.lit(""))))).alias("text_key"))
    return Q.duplicate_groups(rows, ["lang", "text_key"])


ORDER_VERSIONS = """v AS (SELECT order_id, order_status, amount, 1 AS version, false AS is_deleted FROM ord UNION ALL
    SELECT order_id, 'P', amount * 2, 2, false FROM ord WHERE priority = '1-URGENT' UNION ALL
    SELECT order_id, order_status, amount, 3, true FROM ord WHERE amount < 50000)"""


def order_versions(t: Tables):
    """Orders, a changed copy of the urgent ones, and tombstones for the small ones."""
    cols = ["order_id", "order_status", "amount"]
    first = t.orders.select(*cols, F.lit(1).alias("version"), F.lit(False).alias("is_deleted"))
    changed = t.orders.filter("priority = '1-URGENT'").select(
        "order_id", F.lit("P").alias("order_status"), (F.col("amount") * 2).cast("decimal(18,2)").alias("amount"), F.lit(2).alias("version"), F.lit(False).alias("is_deleted"))
    gone = t.orders.filter("amount < 50000").select(*cols, F.lit(3).alias("version"), F.lit(True).alias("is_deleted"))
    return first.unionByName(changed).unionByName(gone)


@query("q8_latest_alive", "ord", f"""WITH {ORDER_VERSIONS}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY version DESC) AS rn FROM v)
    SELECT order_id, order_status, CAST(amount AS DOUBLE) AS amount, version FROM r WHERE rn = 1 AND NOT is_deleted""")
def latest_alive(t: Tables):
    return Q.latest_alive(order_versions(t), ["order_id"], [F.col("version").desc()], "is_deleted").select(
        "order_id", "order_status", dbl("amount").alias("amount"), "version")


HALVES = "CAST(CAST('0x' || substr(m, 1, 16) AS UBIGINT) AS HUGEINT) + CAST('0x' || substr(m, 17, 16) AS UBIGINT)"


def row_text_sql(*cols: str) -> str:
    """SQL form of `text.row_text`."""
    return " || ".join(f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)


def checksum_sql(*cols: str) -> str:
    """SQL form of `quality.text_checksum`."""
    return f"SUM(list_transform([md5({row_text_sql(*cols)})], lambda m: {HALVES})[1])"


@query("q9_reconcile", "ord", f"""WITH b AS (SELECT order_id, amount, nullif(CASE WHEN priority = '1-URGENT' THEN 'P' ELSE order_status END, 'O') AS order_status FROM ord WHERE amount > 5000),
    x AS (SELECT COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount, CAST({checksum_sql('order_id', 'order_status')} AS VARCHAR) AS c FROM ord), y AS (SELECT COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount, CAST({checksum_sql('order_id', 'order_status')} AS VARCHAR) AS c FROM b),
    k AS (SELECT COUNT(*) FILTER (WHERE b.order_id IS NULL) AS gone, COUNT(*) FILTER (WHERE b.order_id IS NOT NULL AND b.order_status IS DISTINCT FROM ord.order_status) AS other FROM ord LEFT JOIN b USING (order_id))
    SELECT 'changed' AS load, x.n AS source_rows, x.amount AS source_amount, x.c AS source_checksum, y.n AS target_rows, y.amount AS target_amount, y.c AS target_checksum, gone AS missing_keys, 0::BIGINT AS extra_keys, other AS differing_keys, false AS equal FROM x, y, k
    UNION ALL SELECT 'same', n, amount, c, n, amount, c, 0, 0, 0, true FROM x""")
def reconcile(t: Tables):
    changed = F.nullif(F.when(F.col("priority") == "1-URGENT", "P").otherwise(F.col("order_status")), F.lit("O"))
    reloaded = t.orders.filter("amount > 5000").select("order_id", "amount", changed.alias("order_status"))
    one = Q.reconcile(t.orders, reloaded, ["order_id"], ["amount"], ["order_id", "order_status"]).withColumn("load", F.lit("changed"))
    same = Q.reconcile(t.orders, t.orders, ["order_id"], ["amount"], ["order_id", "order_status"]).withColumn("load", F.lit("same"))
    return one.unionByName(same)


@query("q9_exchanged_values", "ord", """WITH e AS (SELECT customer_id, MIN(order_id) AS lo, MAX(order_id) AS hi FROM ord GROUP BY 1), p AS (SELECT lo AS order_id, hi AS other FROM e WHERE lo < hi UNION ALL SELECT hi, lo FROM e WHERE lo < hi),
    x AS (SELECT COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount FROM ord)
    SELECT n AS source_rows, n AS target_rows, amount AS source_amount, amount AS target_amount, 0::BIGINT AS missing_keys, 0::BIGINT AS extra_keys, (SELECT COUNT(*) FROM p JOIN ord a USING (order_id) JOIN ord b ON b.order_id = p.other WHERE a.amount <> b.amount) AS differing_keys, false AS equal FROM x""")
def exchanged_values(t: Tables):
    """The first and last order of every customer exchange their amounts: all totals agree, the keys do not."""
    ends = t.orders.groupBy("customer_id").agg(F.min("order_id").alias("lo"), F.max("order_id").alias("hi"),
                                               F.min_by("amount", "order_id").alias("first"), F.max_by("amount", "order_id").alias("last"))
    swapped = F.when(F.col("order_id") == F.col("lo"), F.col("last")).when(F.col("order_id") == F.col("hi"), F.col("first")).otherwise(F.col("amount"))
    loaded = t.orders.join(ends, "customer_id").select("order_id", swapped.alias("amount"))
    return Q.reconcile(t.orders, loaded, ["order_id"], ["amount"], ["order_id"]).drop("source_checksum", "target_checksum")


@query("q10_grain", "ord item", """SELECT 'orders' AS table_name, COUNT(*) AS rows_count, COUNT(DISTINCT order_id) AS unique_keys, COUNT(*) = COUNT(DISTINCT order_id) AS grain_is_unique FROM ord
    UNION ALL SELECT 'items', COUNT(*), COUNT(DISTINCT (order_id, item_id)), COUNT(*) = COUNT(DISTINCT (order_id, item_id)) FROM item""")
def grain(t: Tables):
    a = Q.grain(t.orders, ["order_id"]).select(F.lit("orders").alias("table_name"), "*")
    return a.unionByName(Q.grain(t.items, KEY).select(F.lit("items").alias("table_name"), "*"))


@query("q11_schema_contract", "ord", """SELECT 'order_id' AS column_name, 'bigint' AS expected_type, true AS present, 0::BIGINT AS bad_values UNION ALL
    SELECT 'priority', 'int', true, COUNT(*) FROM ord UNION ALL SELECT 'purchased_at', 'date', true, COUNT(*) FILTER (WHERE priority = '1-URGENT') FROM ord UNION ALL SELECT 'currency', 'string', false, NULL""")
def schema_contract(t: Tables):
    day = F.when(F.col("priority") == "1-URGENT", "no date").otherwise(F.date_format("purchased_at", "yyyy-MM-dd"))
    rows = t.orders.select(F.col("order_id").cast("string").alias("order_id"), "priority", day.alias("purchased_at"))
    return Q.check_schema(rows, T.StructType.fromDDL("order_id bigint, priority int, purchased_at date, currency string"))


def item_rules():
    return [Q.Rule("flag_known", "critical", Q.not_null("flag")), Q.Rule("quantity_range", "warning", Q.outside("quantity", 1, 45)),
            Q.Rule("flag_domain", "warning", Q.not_in("flag", ["A", "R"])), Q.Rule("price_positive", "critical", F.col("price") <= 0)]


@query("q12_rules", "item seller", """WITH n AS (SELECT order_id, item_id, seller_id, quantity, price, nullif(flag, 'N') AS flag FROM item), r AS (
    SELECT 'flag_known' AS rule, 'critical' AS severity, COUNT(*) FILTER (WHERE flag IS NULL) AS violations FROM n UNION ALL
    SELECT 'quantity_range', 'warning', COUNT(*) FILTER (WHERE quantity NOT BETWEEN 1 AND 45) FROM n UNION ALL SELECT 'flag_domain', 'warning', COUNT(*) FILTER (WHERE flag NOT IN ('A', 'R')) FROM n UNION ALL
    SELECT 'price_positive', 'critical', COUNT(*) FILTER (WHERE price <= 0) FROM n UNION ALL SELECT 'item_unique', 'critical', COUNT(*) - COUNT(DISTINCT (order_id, item_id)) FROM n UNION ALL
    SELECT 'seller_known', 'critical', COUNT(*) FROM n WHERE seller_id NOT IN (SELECT seller_id FROM seller WHERE nation_id < 20))
    SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM r""")
def rules(t: Tables):
    rows = t.items.withColumn("flag", F.nullif("flag", F.lit("N")))
    return (Q.check_rules(rows, item_rules()).unionByName(Q.unique_rule(rows, KEY, "item_unique"))
            .unionByName(Q.reference_rule(rows, t.sellers.filter("nation_id < 20"), "seller_id", "seller_known")))


DIRTY = """SELECT event_id, CASE event_type WHEN 'error' THEN NULL ELSE user_id END AS user_id, CASE event_type WHEN 'signup' THEN -value ELSE value END AS value,
    CASE event_type WHEN 'click' THEN 'soon' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events"""


def dirty_events(t: Tables):
    kind = F.col("event_type")
    return t.events.select("event_id", F.when(kind != "error", F.col("user_id")).alias("user_id"), F.when(kind == "signup", -F.col("value")).otherwise(F.col("value")).alias("value"),
                           F.when(kind == "click", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"))


def event_rules():
    return [Q.Rule("user_missing", "critical", Q.not_null("user_id")), Q.Rule("value_negative", "warning", F.col("value") < 0),
            Q.Rule("day_shape", "critical", ~F.col("day").rlike(text.DATE_SHAPE))]


@query("q13_accept_reject", "", f"""WITH d AS ({DIRTY}), m AS (SELECT *, concat_ws(';', CASE WHEN user_id IS NULL THEN 'user_missing' END, CASE WHEN value < 0 THEN 'value_negative' END,
    CASE WHEN NOT regexp_matches(day, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN 'day_shape' END) AS reason FROM d)
    SELECT CAST(event_id AS VARCHAR) AS business_key, 'accepted' AS outcome, '' AS reason, CAST(NULL AS VARCHAR) AS batch_id, CAST(NULL AS VARCHAR) AS payload_user FROM m WHERE reason = '' UNION ALL
    SELECT CAST(event_id AS VARCHAR), 'rejected', reason, 'batch-1', CAST(user_id AS VARCHAR) FROM m WHERE reason <> ''""")
def accept_reject(t: Tables):
    ok, bad = Q.split_valid(dirty_events(t), event_rules(), "event_id", "batch-1")
    none = F.lit(None).cast("string")
    good = ok.select(F.col("event_id").cast("string").alias("business_key"), F.lit("accepted").alias("outcome"), F.lit("").alias("reason"), none.alias("batch_id"), none.alias("payload_user"))
    return good.unionByName(bad.select("business_key", F.lit("rejected").alias("outcome"), "reason", "batch_id", F.get_json_object("raw_payload", "$.user_id").alias("payload_user")))


@query("q14_freshness", "ord", """WITH d AS (SELECT DISTINCT CAST(purchased_at AS DATE) AS day FROM ord), s AS (SELECT CAST(unnest(generate_series((SELECT MIN(day) FROM d), (SELECT MAX(day) FROM d), INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT 'missing' AS kind, s.day, NULL::BIGINT AS age_days FROM s WHERE s.day NOT IN (SELECT day FROM d) UNION ALL SELECT 'latest', MAX(day), date_diff('day', MAX(day), DATE '2002-01-01') FROM d""")
def freshness(t: Tables):
    days = t.orders.select(F.to_date("purchased_at").alias("day"))
    last = Q.freshness(days, "day", F.lit("2002-01-01").cast("date")).select(F.lit("latest").alias("kind"), F.col("last_at").alias("day"), "age_days")
    return Q.missing_days(days, "day").select(F.lit("missing").alias("kind"), "day", F.lit(None).cast("long").alias("age_days")).unionByName(last)


@query("q15_quality_mart", "", f"""WITH d AS (SELECT x.*, e.ts FROM ({DIRTY}) x JOIN events e USING (event_id)), g AS (SELECT CAST(ts AS DATE) AS event_day, COUNT(*) AS rows_count,
    COUNT(*) FILTER (WHERE user_id IS NULL) AS user_missing, COUNT(*) FILTER (WHERE value < 0) AS value_negative, COUNT(*) FILTER (WHERE day = 'soon') AS day_shape FROM d GROUP BY 1)
    SELECT *, rows_count - user_missing - value_negative - day_shape AS valid_rows, user_missing + value_negative + day_shape AS rejected_rows, user_missing + day_shape = 0 AS publish FROM g""")
def quality_mart(t: Tables):
    rows = dirty_events(t).join(t.events.select("event_id", "ts"), "event_id")
    mart = Q.quality_mart(rows, {"event_day": F.to_date("ts")}, event_rules())
    critical = [F.col(r.name) for r in event_rules() if r.severity == "critical"]
    return mart.withColumn("publish", reduce(lambda a, b: a + b, critical) == 0)


@query("q15_publish_gate", "", f"""WITH d AS ({DIRTY}), n AS (SELECT COUNT(*) FILTER (WHERE user_id IS NULL) AS a, COUNT(*) FILTER (WHERE value < 0) AS b, COUNT(*) FILTER (WHERE day = 'soon') AS c FROM d)
    SELECT 'raw' AS batch, a + c = 0 AS publish, CAST(a + b + c AS BIGINT) AS violations FROM n UNION ALL SELECT 'accepted', true, 0 FROM n""")
def publish_gate(t: Tables):
    accepted, _ = Q.split_valid(dirty_events(t), event_rules(), "event_id", "batch-1")
    batches = {"raw": dirty_events(t), "accepted": accepted}
    gates = [Q.gate(Q.check_rules(rows, event_rules())).withColumn("batch", F.lit(name)) for name, rows in batches.items()]
    return gates[0].unionByName(gates[1])


@query("q15_snapshot_quality", "trade", """SELECT day, COUNT(*) AS snapshot_rows, COUNT(*) FILTER (WHERE side <> 'N') AS active_rows, COUNT(*) FILTER (WHERE side = 'N') AS zero_trade_rows,
    COUNT(DISTINCT secid) AS instruments, 0::BIGINT AS rejected_rows FROM trade GROUP BY day""")
def snapshot_quality(t: Tables):
    # one side is read as listed but not traded
    return snapshot_quality_of(t.trades.withColumn("quantity", F.when(F.col("side") == "N", 0).otherwise(F.col("quantity"))))


@query("q1_frequent_values", "", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{n}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS rows_count FROM orders GROUP BY {c} ORDER BY 3 DESC, {c} LIMIT 5)" for n, c in PROFILED.items()))
def frequent_values(t: Tables):
    return Q.frequent_values(t.orders, list(PROFILED), 5)
