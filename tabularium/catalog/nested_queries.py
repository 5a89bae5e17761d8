"""JSON, array and map queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.catalog.registry import query
from tabularium.functions import nested as N
from tabularium.tables import Tables, dbl, lng

ENVELOPE = """json_object('event_type', 'order_created', 'event_version', 1, 'occurred_at', strftime(purchased_at, '%Y-%m-%dT%H:%M:%S'),
    'data', json_object('customer_id', customer_id, 'status', nullif(order_status, 'P')))"""


def envelopes(t: Tables):
    return t.orders.select("order_id", N.event_envelope("order_created", 1, F.col("purchased_at"), {
        "customer_id": F.col("customer_id"), "status": F.nullif("order_status", F.lit("P"))}).alias("event"))


@query("n1_event_envelope", "ord", f"SELECT order_id, CAST({ENVELOPE} AS VARCHAR) AS event FROM ord")
def event_envelope(t: Tables):
    return envelopes(t)


@query("n2_path_access", "ord", f"SELECT order_id, json_extract_string(event, '$.data.customer_id') AS customer_id, json_extract_string(event, '$.event_type') AS event_type FROM (SELECT order_id, {ENVELOPE} AS event FROM ord)")
def path_access(t: Tables):
    doc = F.col("event")
    return envelopes(t).select("order_id", N.json_text(doc, "$.data.customer_id").alias("customer_id"), N.json_text(doc, "$.event_type").alias("event_type"))


@query("n3_key_tests", "ord", """SELECT order_id, true AS has_status, false AS has_other, COALESCE(order_status = 'F', false) AS is_finished FROM (SELECT order_id, nullif(order_status, 'P') AS order_status FROM ord)""")
def key_tests(t: Tables):
    data = envelopes(t).select("order_id", F.get_json_object("event", "$.data").alias("d"))
    return data.select("order_id", N.has_key(F.col("d"), "status").alias("has_status"), N.has_key(F.col("d"), "other").alias("has_other"),
                       N.contains_fields(F.col("d"), {"status": "F"}).alias("is_finished"))


@query("n4_object_to_rows", "ord", "SELECT order_id, 'customer' AS key, CAST(customer_id AS VARCHAR) AS value FROM ord UNION ALL SELECT order_id, 'status', order_status FROM ord")
def object_to_rows(t: Tables):
    docs = t.orders.select("order_id", N.json_object(customer=F.col("customer_id"), status=F.col("order_status")).alias("doc"))
    return N.json_each(docs, "doc")


def payment_arrays(t: Tables):
    """JSON array of the payment rows of an order: as many elements as there are payment types."""
    element = F.struct(F.col("payment_sequence").alias("seq"), F.col("payment_type").alias("type"), F.col("payment_value").alias("value"))
    return t.payments.groupBy("order_id").agg(F.to_json(F.array_sort(F.collect_list(element))).alias("doc"))


@query("n5_records_to_rows", "pay", "SELECT order_id, payment_sequence AS seq, payment_type AS type, CAST(payment_value AS DOUBLE) AS value FROM pay")
def records_to_rows(t: Tables):
    return N.explode_records(payment_arrays(t), "doc", "seq bigint, type string, value double")


@query("n6_path_predicate", "", "SELECT event_id, props FROM events WHERE CAST(json_extract_string(props, '$.k') AS DOUBLE) > 50")
def path_predicate(t: Tables):
    return t.events.filter(N.json_number(F.col("props"), "$.k") > 50).select("event_id", "props")


@query("n7_edit_fields", "", """SELECT event_id, '{"k":' || k || ',"seen":{"by":' || user_id || '},"done":true}' AS with_done, '{"seen":{"by":' || user_id || '}}' AS without_k,
    '{"k":' || k || ',"seen":{}}' AS without_by, '{"k":"' || event_type || '","seen":{"by":' || user_id || '},"gone":null}' AS merged, '{"k":' || k || ',"seen":{"by":' || user_id || ',"how":{"often":2}}}' AS nested
    FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)""")
def edit_fields(t: Tables):
    doc = N.set_field(F.col("props"), ["seen", "by"], F.col("user_id"))
    other = F.concat(F.lit('{"k":"'), F.col("event_type"), F.lit('","gone":null}'))
    return t.events.select(
        "event_id", N.set_field(doc, "done", F.lit(True)).alias("with_done"), N.drop_field(doc, "k").alias("without_k"),
        N.drop_field(doc, ["seen", "by"]).alias("without_by"), N.merge(doc, other).alias("merged"),
        N.set_field(doc, ["seen", "how", "often"], F.lit(2)).alias("nested"))


@query("n8_json_aggregates", "item pay", """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY item_id, product_id, seller_id, price, flag, quantity, shipped_at, freight) AS rn FROM item),
    a AS (SELECT order_id, (rn - 1) // 1000 AS chunk_no, '[' || string_agg('{"item_id":' || item_id || ',"product_id":' || product_id || '}', ',' ORDER BY rn) || ']' AS items FROM r GROUP BY 1, 2),
    p AS (SELECT order_id, '{' || string_agg('"' || payment_sequence || '":"' || payment_type || '"', ',' ORDER BY payment_sequence) || '}' AS types FROM pay GROUP BY 1)
    SELECT a.order_id, chunk_no, items, types FROM a JOIN p USING (order_id)""")
def json_aggregates(t: Tables):
    items = N.json_arrays(t.placed_items, ["order_id"], t.item_order, F.struct("item_id", "product_id"), "items")
    entry = F.struct(F.col("payment_sequence").cast("string").alias("k"), F.col("payment_type").alias("v"))
    types = t.payments.groupBy("order_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("types"))
    return items.join(types, "order_id")


@query("n9_null_kinds", "ord", """SELECT order_id, CASE priority WHEN '1-URGENT' THEN 'sql_null' WHEN '2-HIGH' THEN 'absent' WHEN '3-MEDIUM' THEN 'json_null' ELSE 'value' END AS kind FROM ord""")
def null_kinds(t: Tables):
    p = F.col("priority")
    doc = (F.when(p == "1-URGENT", F.lit(None).cast("string")).when(p == "2-HIGH", N.json_object(other=p))
           .when(p == "3-MEDIUM", N.json_object(status=F.lit(None).cast("string"))).otherwise(N.json_object(status=p)))
    return t.orders.select("order_id", N.null_kind(doc, "status").alias("kind"))


def type_arrays(t: Tables):
    """Payment types of an order in sequence; bounded by the number of types."""
    return t.payments.groupBy("order_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("payment_sequence", "payment_type"))), lambda x: x["payment_type"]).alias("types"))


@query("n10_array_positions", "pay", """SELECT order_id, payment_sequence AS position, payment_type FROM pay WHERE order_id IN (SELECT order_id FROM pay WHERE payment_type = 'R')""")
def array_positions(t: Tables):
    hit = type_arrays(t).filter(F.array_contains("types", "R"))
    return hit.select("order_id", F.posexplode("types").alias("p", "payment_type")).select("order_id", lng(F.col("p") + 1).alias("position"), "payment_type")


@query("n11_array_sets", "pay", """SELECT order_id, string_agg(payment_type, ',' ORDER BY payment_type) AS types, COALESCE(string_agg(payment_type, ',' ORDER BY payment_type) FILTER (WHERE payment_type IN ('A', 'R')), '') AS common FROM pay GROUP BY order_id""")
def array_sets(t: Tables):
    types = F.array_sort(F.array_distinct(F.concat("types", "types")))
    return type_arrays(t).select("order_id", F.array_join(types, ",").alias("types"),
                                 F.array_join(F.array_intersect(types, F.array(F.lit("R"), F.lit("A"), F.lit("X"))), ",").alias("common"))


@query("n12_matrix_element", "", "SELECT vec_id, CAST(embedding[9] AS DOUBLE) AS row2_col1 FROM embeddings")
def matrix_element(t: Tables):
    # the 64 numbers of a vector read as a matrix of eight columns
    matrix = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("embedding", r * 8 + 1, 8))
    return t.raw("embeddings").select("vec_id", dbl(N.matrix_get(matrix, 2, 1)).alias("row2_col1"))


@query("n13_event_validation", "ord", "SELECT order_id, priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS is_valid FROM ord")
def event_validation(t: Tables):
    p = F.col("priority")
    good = N.event_envelope("order_created", 1, F.col("purchased_at"), {"customer_id": F.col("customer_id")})
    empty_type = N.event_envelope("", 1, F.col("purchased_at"), {"customer_id": F.col("customer_id")})
    no_time = N.json_object(event_type=F.lit("order_created"), data=F.struct("customer_id"))
    bad_data = N.json_object(event_type=F.lit("order_created"), occurred_at=F.lit("x"), data=F.col("customer_id"))
    doc = F.when(p == "1-URGENT", empty_type).when(p == "2-HIGH", no_time).when(p == "3-MEDIUM", bad_data).otherwise(good)
    return t.orders.select("order_id", N.valid_event(doc).alias("is_valid"))


@query("n14_shred", "ord", "SELECT order_id, customer_id, nullif(order_status, 'P') AS status, purchased_at FROM ord")
def shred(t: Tables):
    schema = "event_type string, occurred_at timestamp_ntz, data struct<customer_id: bigint, status: string>"
    return envelopes(t).select("order_id", F.from_json("event", schema).alias("e")).select(
        "order_id", "e.data.customer_id", "e.data.status", F.col("e.occurred_at").alias("purchased_at"))


@query("n15_order_document", "fin item pay", """WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY item_id, product_id, seller_id, price, flag, quantity, shipped_at, freight) AS rn FROM item),
    a AS (SELECT order_id, (rn - 1) // 1000 AS chunk_no, '[' || string_agg('{"item_id":' || item_id || ',"product_id":' || product_id || '}', ',' ORDER BY rn) || ']' AS items FROM r GROUP BY 1, 2),
    p AS (SELECT order_id, string_agg(payment_type, ',' ORDER BY payment_type) AS payment_types FROM pay GROUP BY 1)
    SELECT f.order_id, f.customer_id, f.order_status, CAST(f.payment_value AS DOUBLE) AS payment_total, p.payment_types, COALESCE(a.chunk_no, 0) AS chunk_no, COALESCE(a.items, '[]') AS items,
    CAST(json_object('delivered_at', strftime(f.delivered_at, '%Y-%m-%d'), 'estimated_at', strftime(f.estimated_at, '%Y-%m-%d')) AS VARCHAR) AS delivery FROM fin f LEFT JOIN a USING (order_id) LEFT JOIN p USING (order_id)""")
def order_document(t: Tables):
    items = N.json_arrays(t.placed_items, ["order_id"], t.item_order, F.struct("item_id", "product_id"), "items")
    types = t.payments.groupBy("order_id").agg(F.array_join(F.array_sort(F.collect_set("payment_type")), ",").alias("payment_types"))
    day = "yyyy-MM-dd"
    return t.finance.join(items, "order_id", "left").join(types, "order_id", "left").select(
        "order_id", "customer_id", "order_status", dbl("payment_value").alias("payment_total"), "payment_types", F.coalesce("chunk_no", F.lit(0)).alias("chunk_no"),
        F.coalesce("items", F.lit("[]")).alias("items"), N.json_object(delivered_at=F.date_format("delivered_at", day), estimated_at=F.date_format("estimated_at", day)).alias("delivery"))
