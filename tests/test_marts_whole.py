"""Marts keep rows without a category, a state, a currency or a revenue."""

import datetime

from pyspark.sql import functions as F

from tabularium.operators import ordered, windows
from tabularium.plans import marts as M


def test_sellers_without_revenue_have_a_rank(spark):
    items = spark.createDataFrame([(1, 10), (2, 30), (3, 30), (4, None)], "seller_id long, price long")
    assert {(r.seller_id, r.seller_rank) for r in M.seller_ranks(items).collect()} == {(2, 1), (3, 1), (1, 2), (4, 3)}


def test_prices_take_the_rate_of_their_day(spark):
    def day(d):
        return datetime.datetime(2024, 1, d)
    rows = spark.createDataFrame([(1, "E", day(1), 10), (2, "E", day(5), 10), (3, "E", day(9), 10), (4, "U", day(9), 10), (5, None, day(9), 10), (6, "X", day(9), 10)],
                                 "id long, currency string, at timestamp_ntz, price long").withColumn("price", F.col("price").cast("decimal(18,2)"))
    rates = spark.createDataFrame([("E", day(3), "1.5"), ("E", day(9), "2.0")], "currency string, starts timestamp_ntz, rate string").withColumn(
        "rate", F.col("rate").cast("decimal(9,4)"))
    got = M.normalised(rows, rates, "price", "currency", "at", "starts", "U", ["id"])
    assert {r.id: r.price_normalised and float(r.price_normalised) for r in got.collect()} == {1: None, 2: 15.0, 3: 20.0, 4: 10.0, 5: None, 6: None}


def test_both_numbers_from_one_placement(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 5, 1, None, 9, 5, None, 1, 2] * 30)], "id int, v int")
    up = {r.id: r.n for r in ordered.numbered(df, [], [F.col("v").asc(), F.col("id").asc()], "n").collect()}
    down = {r.id: r.n for r in ordered.numbered(df, [], [F.col("v").desc(), F.col("id").asc()], "n").collect()}
    got = {r.id: (r.up, r.down) for r in windows.both_numbers(df, "v", "id", "up", "down").collect()}
    assert got == {i: (up[i], down[i]) for i in up}
