"""User-function queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabularium.catalog.registry import query
from tabularium.functions import udfs
from tabularium.tables import Tables, dbl


@query("x1_sql_function", "item", """SELECT order_id, item_id, product_id, seller_id, CAST(ROUND(price * CAST(1.2 AS DECIMAL(3,1)), 2) AS DOUBLE) AS with_tax, printf('%s-%010d', flag, order_id) AS label FROM item""")
def sql_function(t: Tables):
    udfs.create_sql_functions(t.spark)
    return t.items.select("order_id", "item_id", "product_id", "seller_id", dbl(F.expr("gross_price(price, 20)")).alias("with_tax"),
                          F.expr("order_label(flag, order_id)").alias("label"))


@query("x2_table_function", "item", """SELECT product_id, COUNT(*) AS items_count, CAST(SUM(quantity) AS BIGINT) AS pieces FROM item WHERE quantity BETWEEN 10 AND 20 GROUP BY product_id""")
def table_function(t: Tables):
    view, name = (f"tabularium_{kind}_{uuid.uuid4().hex}" for kind in ("items", "sold"))
    t.items.select("product_id", "quantity").createOrReplaceTempView(view)
    udfs.create_table_function(
        t.spark, name, "least BIGINT, most BIGINT DEFAULT 20", "product_id BIGINT, items_count BIGINT, pieces BIGINT",
        f"SELECT product_id, count(*), sum(quantity) FROM {view} WHERE quantity BETWEEN least AND most GROUP BY product_id")
    return t.spark.sql(f"SELECT * FROM {name}(10)")


@query("x3_vectorised_function", "", """SELECT doc_id, strip_accents(text) AS folded FROM documents""")
def vectorised_function(t: Tables):
    return t.raw("documents").select("doc_id", udfs.folded_letters("text").alias("folded"))


@query("x3_whole_documents", "", """SELECT doc_id, CAST(length(strip_accents(text)) AS BIGINT) AS n_chars, sha256(strip_accents(text)) AS folded_sha256 FROM documents""")
def whole_documents(t: Tables):
    """Every document, its whole text folded; the digest stands for the text."""
    folded = udfs.folded_letters("text")
    return t.raw("documents").select("doc_id", folded.alias("folded")).select(
        "doc_id", F.char_length("folded").cast("long").alias("n_chars"), F.sha2("folded", 256).alias("folded_sha256"))
