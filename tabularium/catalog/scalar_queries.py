"""Text and number function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.catalog.registry import query
from tabularium.functions import text
from tabularium.operators.grouping import with_group_agg
from tabularium.tables import Tables, dbl


@query("f1_clean_text", "", """SELECT doc_id, nullif(trim(CASE WHEN lang = 'en' THEN '   ' ELSE '  ' || source || ' ' END), '') AS source, lower(lang) AS lang FROM documents""")
def clean_text(t: Tables):
    padded = F.when(F.col("lang") == "en", "   ").otherwise(F.concat(F.lit("  "), "source", F.lit(" ")))
    return t.raw("documents").select("doc_id", text.clean_text(padded).alias("source"), F.lower("lang").alias("lang"))


@query("f2_full_name", "prod", """SELECT product_id, concat_ws(' ', nullif(trim('  ' || split_part(product_name, ' ', 1) || ' '), ''), nullif(trim(CASE WHEN size > 25 THEN ' ' ELSE brand END), '')) AS full_name FROM prod""")
def full_name(t: Tables):
    first = F.concat(F.lit("  "), F.split_part("product_name", F.lit(" "), F.lit(1)), F.lit(" "))
    second = F.when(F.col("size") > 25, " ").otherwise(F.col("brand"))
    return t.products.select("product_id", text.full_name(first, second).alias("full_name"))


@query("f3_collapse_spaces", "", r"""SELECT doc_id, md5(lower(regexp_replace(trim(text), '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS text_md5 FROM documents""")
def collapse_spaces(t: Tables):
    return t.raw("documents").select("doc_id", F.md5(text.normalize_city(F.col("text"))).alias("text_md5"))


@query("f4_safe_int", "", """SELECT event_id, TRY_CAST(v AS INTEGER) AS number FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'bad' WHEN 'signup' THEN '99999999999' WHEN 'click' THEN NULL
    ELSE CAST(user_id AS VARCHAR) END AS v FROM events)""")
def safe_int(t: Tables):
    kind = F.col("event_type")
    value = (F.when(kind == "error", "bad").when(kind == "signup", "99999999999").when(kind == "click", F.lit(None).cast("string"))
             .otherwise(F.col("user_id").cast("string")))
    return t.events.select("event_id", text.safe_int(value).alias("number"))


@query("f5_add_tax", "", """SELECT l_orderkey, l_linenumber, l_partkey, CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 + l_tax AS DECIMAL(12,6)), 2) AS DOUBLE) AS with_tax FROM lineitem""")
def add_tax(t: Tables):
    gross = text.add_tax(F.col("l_extendedprice"), F.col("l_tax").cast("decimal(9,4)") * 100)
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", dbl(gross).alias("with_tax"))


@query("f6_pct_change", "item prod", """SELECT order_id, item_id, product_id, seller_id, CAST(ROUND(CAST(100 * (price - base) AS DOUBLE) / nullif(CAST(base AS DOUBLE), 0), 2) AS DOUBLE) AS pct
    FROM (SELECT i.*, CASE WHEN p.size < 10 THEN 0 ELSE p.retail_price END AS base FROM item i JOIN prod p USING (product_id))""")
def pct_change(t: Tables):
    base = F.when(F.col("size") < 10, F.lit(0)).otherwise(F.col("retail_price"))
    rows = t.items.join(t.products.select("product_id", "size", "retail_price"), "product_id")
    return rows.select("order_id", "item_id", "product_id", "seller_id",
                       text.pct_change(base, F.col("price")).alias("pct"))


@query("f7_shape_check", "", r"""SELECT event_id, regexp_matches(d, '^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2})?$') AS is_date, regexp_matches(e, '^[^\s@]+@[^\s@]+\.[^\s@]+$') AS is_email FROM (
    SELECT event_id, CASE event_type WHEN 'error' THEN 'no date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS d,
    CASE event_type WHEN 'signup' THEN 'user at mail' ELSE 'user' || user_id || '@mail.example' END AS e FROM events)""")
def shape_check(t: Tables):
    day = F.when(F.col("event_type") == "error", "no date").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    mail = F.when(F.col("event_type") == "signup", "user at mail").otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@mail.example")))
    return t.events.select("event_id", day.rlike(text.DATE_SHAPE).alias("is_date"), mail.rlike(text.EMAIL_SHAPE).alias("is_email"))


@query("f8_masking", "cust", r"""SELECT customer_id, lower(customer_name)[1] || repeat('*', 3) || '@mail.example' AS email, CAST(NULL AS DOUBLE) AS balance FROM cust""")
def masking(t: Tables):
    mail = F.concat(F.lower("customer_name"), F.lit("@mail.example"))
    return t.customers.select("customer_id", text.mask_email(mail).alias("email"), text.hidden("double").alias("balance"))


@query("f9_row_hash", "ord", """SELECT order_id, md5(concat_ws('|', CAST(order_id AS VARCHAR), CAST(customer_id AS VARCHAR), nullif(order_status, 'P'), strftime(purchased_at, '%Y-%m-%d'))) AS source_hash,
    md5(concat_ws('|', CAST(order_id AS VARCHAR), CAST(customer_id AS VARCHAR), COALESCE(nullif(order_status, 'P'), '<null>'), strftime(purchased_at, '%Y-%m-%d'))) AS strict_hash FROM ord""")
def row_hash(t: Tables):
    cols = [F.col("order_id"), F.col("customer_id"), F.nullif("order_status", F.lit("P")), F.date_format("purchased_at", "yyyy-MM-dd")]
    return t.orders.select("order_id", text.row_hash(*cols).alias("source_hash"), text.row_hash(*cols, null_text="<null>").alias("strict_hash"))


@query("f10_title_words", "prod", """SELECT product_id, upper(substr(split_part(product_name, ' ', 1), 1, 1)) || substr(split_part(product_name, ' ', 1), 2) || ' ' ||
    upper(substr(split_part(product_name, ' ', 2), 1, 1)) || substr(split_part(product_name, ' ', 2), 2) AS title FROM prod""")
def title_words(t: Tables):
    return t.products.select("product_id", text.title_words(F.concat(F.lit("  "), F.upper(F.replace("product_name", F.lit(" "), F.lit("   "))))).alias("title"))


@query("f11_allocation", "item", """SELECT order_id, product_id, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY order_id) AS weight FROM item GROUP BY order_id, product_id""")
def allocation(t: Tables):
    counts = t.items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return with_group_agg(counts, ["order_id"], {"total": F.sum("n")}).select(
        "order_id", "product_id", (dbl("n") / F.col("total")).alias("weight"))
