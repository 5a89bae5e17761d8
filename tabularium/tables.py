"""The given tables and the commerce, trade and event shapes that queries read them as."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def money(col: Column | str) -> Column:
    """Exact two-digit amount, so that sums do not depend on row order."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def dbl(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def lng(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("long")


class Tables:
    """Readers over one data folder; nothing is read until a query asks for it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        if name not in TABLE_NAMES:
            raise ValueError(f"unknown table {name}")
        return f"{self.root}/{name}.parquet"

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"), F.col("o_orderdate").alias("purchased_at"),
            money("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"),
        )

    @cached_property
    def items(self) -> DataFrame:
        return self._items(self.raw("lineitem"))

    @cached_property
    def placed_items(self) -> DataFrame:
        """Items with the file and row they were read from, which tells exact copies apart."""
        return self._items(self.raw("lineitem"), F.xxhash64("_metadata.file_path").alias("file_no"),
                           F.col("_metadata.row_index").alias("row_index"))

    # a total order of the placed items of one order
    item_order = ("item_id", "product_id", "seller_id", "price", "flag", "quantity", "shipped_at", "freight",
                  "file_no", "row_index")

    def _items(self, rows: DataFrame, *more: Column) -> DataFrame:
        price = money("l_extendedprice")
        return rows.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item_id"),
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
            price.alias("price"), money(price * F.col("l_tax").cast("decimal(4,2)")).alias("freight"),
            lng("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"),
            F.col("l_shipdate").alias("shipped_at"), *more,
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One row per order and payment type; an order has as many rows as there are flags."""
        sums = self.items.groupBy("order_id", F.col("flag").alias("payment_type")).agg(
            F.sum(F.col("price") + F.col("freight")).alias("payment_value")
        )
        order = Window.partitionBy("order_id").orderBy("payment_type")
        return sums.withColumn("payment_sequence", lng(F.row_number().over(order)))

    @cached_property
    def nations(self) -> DataFrame:
        return self.raw("nation").select(lng("n_nationkey").alias("nation_id"), F.col("n_name").alias("state"))

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customer").join(self.nations, F.col("c_nationkey") == F.col("nation_id")).select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("city"), "state", money("c_acctbal").alias("balance"), "nation_id",
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return self.raw("supplier").join(self.nations, F.col("s_nationkey") == F.col("nation_id")).select(
            F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"), "state", "nation_id",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), lng("p_size").alias("size"),
            money("p_retailprice").alias("retail_price"),
        )

    @cached_property
    def item_totals(self) -> DataFrame:
        return self.items.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("items_count"), F.sum("price").alias("product_value"),
            F.sum("freight").alias("freight_value"), F.max("shipped_at").alias("delivered_at"),
        ).withColumn("payment_value", F.col("product_value") + F.col("freight_value"))

    @cached_property
    def finance(self) -> DataFrame:
        """One row per order with its folded items."""
        estimated = F.col("purchased_at") + F.expr("INTERVAL 30 DAYS")
        return self.orders.join(self.item_totals, "order_id", "left").select(
            "order_id", "customer_id", "order_status", "purchased_at",
            F.coalesce("items_count", F.lit(0)).alias("items_count"), "product_value", "freight_value",
            "payment_value", "delivered_at", estimated.alias("estimated_at"),
            (F.col("delivered_at") > estimated).alias("delivered_late"),
        )

    @cached_property
    def product_sales(self) -> DataFrame:
        sales = self.items.groupBy("product_id").agg(
            F.countDistinct("order_id").alias("orders_count"), F.sum("price").alias("revenue")
        )
        return sales.join(self.products.select("product_id", "category"), "product_id")

    @cached_property
    def daily_sales(self) -> DataFrame:
        return self.orders.groupBy(F.to_date("purchased_at").alias("day")).agg(
            F.count(F.lit(1)).alias("orders_count"), F.sum("amount").alias("revenue")
        )

    @cached_property
    def monthly_sales(self) -> DataFrame:
        return self.orders.groupBy(F.trunc("purchased_at", "month").alias("month")).agg(
            F.count(F.lit(1)).alias("orders_count"), F.sum("amount").alias("revenue")
        )

    @cached_property
    def customer_summary(self) -> DataFrame:
        return self.orders.groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("orders_count"), F.sum("amount").alias("lifetime_value"),
            F.max("purchased_at").alias("last_order_at"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def trades(self) -> DataFrame:
        """Items of parts read as trades: ticker = brand, side = return flag, day = ship date."""
        ticker = self.raw("part").select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("secid"))
        return self.items.join(ticker, "product_id").select(
            "secid", F.col("flag").alias("side"), F.to_date("shipped_at").alias("day"), "shipped_at",
            F.col("price").alias("value"), "quantity", "order_id", "item_id", "seller_id", "product_id",
        )
