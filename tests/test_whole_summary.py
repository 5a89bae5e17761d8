"""The customer summary counts every order."""

from decimal import Decimal

from conftest import SF_DIR
from tabularium.catalog import load_all


def test_every_order_counts(spark, tables):
    got = load_all()["m12_customer_summary"](spark, SF_DIR).collect()
    orders = tables.orders.select("customer_id", "amount").collect()
    assert sum(r.orders_count for r in got) == len(orders)
    assert abs(sum(Decimal(r.lifetime_value) for r in got) - sum(r.amount for r in orders)) < 1
    ids = [r.customer_id for r in tables.customers.select("customer_id").collect()]
    assert {r.customer_id for r in got} == {*ids, *(-i for i in ids if i % 10 == 3)}
    assert {r.segment for r in got if r.customer_id < 0} == {"unknown"}
