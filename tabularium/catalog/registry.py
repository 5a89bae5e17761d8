"""Query registry: a Spark callable and, where SQL can say it, the SQL text with the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabularium.tables import Tables

# SQL forms of the shapes in tabularium.tables, in dependency order
SHAPES = {
    "ord": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
        o_orderdate AS purchased_at, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
        o_orderpriority AS priority FROM orders""",
    "item": """SELECT l_orderkey AS order_id, l_linenumber AS item_id, l_partkey AS product_id,
        l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS freight,
        CAST(l_quantity AS BIGINT) AS quantity, l_returnflag AS flag, l_shipdate AS shipped_at FROM lineitem""",
    "pay": """SELECT order_id, flag AS payment_type, SUM(price + freight) AS payment_value,
        CAST(ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY flag) AS BIGINT) AS payment_sequence
        FROM item GROUP BY order_id, flag""",
    "cust": """SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS city,
        n_name AS state, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, CAST(n_nationkey AS BIGINT) AS nation_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "seller": """SELECT s_suppkey AS seller_id, s_name AS seller_name, n_name AS state,
        CAST(n_nationkey AS BIGINT) AS nation_id FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "prod": """SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category,
        CAST(p_size AS BIGINT) AS size, CAST(p_retailprice AS DECIMAL(18,2)) AS retail_price FROM part""",
    "itot": """SELECT order_id, COUNT(*) AS items_count, SUM(price) AS product_value,
        SUM(freight) AS freight_value, SUM(price + freight) AS payment_value,
        MAX(shipped_at) AS delivered_at FROM item GROUP BY order_id""",
    "fin": """SELECT o.order_id, o.customer_id, o.order_status, o.purchased_at,
        COALESCE(t.items_count, 0) AS items_count, t.product_value, t.freight_value, t.payment_value,
        t.delivered_at, o.purchased_at + INTERVAL 30 DAY AS estimated_at,
        t.delivered_at > o.purchased_at + INTERVAL 30 DAY AS delivered_late
        FROM ord o LEFT JOIN itot t USING (order_id)""",
    "psales": """SELECT i.product_id, COUNT(DISTINCT i.order_id) AS orders_count, SUM(i.price) AS revenue,
        p.category FROM item i JOIN prod p USING (product_id) GROUP BY i.product_id, p.category""",
    "daily": """SELECT CAST(purchased_at AS DATE) AS day, COUNT(*) AS orders_count, SUM(amount) AS revenue
        FROM ord GROUP BY 1""",
    "monthly": """SELECT CAST(date_trunc('month', purchased_at) AS DATE) AS month, COUNT(*) AS orders_count,
        SUM(amount) AS revenue FROM ord GROUP BY 1""",
    "csum": """SELECT customer_id, COUNT(*) AS orders_count, SUM(amount) AS lifetime_value,
        MAX(purchased_at) AS last_order_at FROM ord GROUP BY customer_id""",
    "trade": """SELECT p_brand AS secid, flag AS side, CAST(shipped_at AS DATE) AS day, shipped_at, price AS value,
        quantity, order_id, item_id, seller_id, product_id FROM item JOIN part ON p_partkey = product_id""",
}
_NEEDS = {
    "pay": ("item",), "itot": ("item",), "fin": ("ord", "item", "itot"), "psales": ("item", "prod"),
    "daily": ("ord",), "monthly": ("ord",), "csum": ("ord",), "trade": ("item",),
}


def twin(shapes: str, body: str) -> str:
    """SQL text with the named shapes in front; a leading WITH of `body` is merged."""
    wanted: set[str] = set()
    for name in shapes.split():
        wanted.add(name)
        wanted.update(_NEEDS.get(name, ()))
    parts = [f"{name} AS ({text})" for name, text in SHAPES.items() if name in wanted]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts + [body[5:]])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(name: str, shapes: str = "", sql: str | None = None):
    """Register a query under `name`; `sql` is the twin, after the SQL forms of `shapes`."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(build, None if sql is None else twin(shapes, sql))
        return build

    return add
