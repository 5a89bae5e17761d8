"""Golden values of scalar, time and JSON functions."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabularium.functions import nested, text, timeops, udfs


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def lit(v, t="string"):
    return F.lit(v).cast(t)


def test_text_golden(spark):
    row = one(spark, text.full_name(lit("  Ivan "), lit(" Petrov  ")), text.full_name(lit(" "), lit("Petrov")), text.normalize_city(lit("  São \t PAULO ")),
              text.title_words(lit(" ada   LOVELACE ")), text.mask_email(lit("anna@mail.example")), text.clean_text(lit("   ")))
    assert list(row) == ["Ivan Petrov", "Petrov", "são paulo", "Ada Lovelace", "a***@mail.example", None]


def test_numbers_golden(spark):
    row = one(spark, text.add_tax(lit("199.99"), lit(20, "int")), text.safe_int(lit("42")), text.safe_int(lit("4x")), text.safe_int(lit("99999999999")),
              text.pct_change(lit(50, "decimal(18,2)"), lit(75, "decimal(18,2)")), text.pct_change(lit(0, "decimal(18,2)"), lit(10, "decimal(18,2)")))
    assert row["c0"] == Decimal("239.99")
    assert list(row)[1:4] == [42, None, None]
    assert row["c4"] == 50.0 and row["c5"] is None


def test_row_hash_null_rules(spark):
    a = [lit("x"), lit(None), lit("y")]
    b = [lit("x"), lit("y"), lit(None)]
    row = one(spark, text.row_hash(*a), text.row_hash(*b), text.row_hash(*a, null_text="?"), text.row_hash(*b, null_text="?"))
    assert row["c0"] == row["c1"] and row["c2"] != row["c3"]


@pytest.mark.parametrize("wall,utc", [
    ("2021-03-14 01:30:00", "2021-03-14 06:30:00"), ("2021-03-14 02:30:00", "2021-03-14 07:30:00"), ("2021-03-14 03:30:00", "2021-03-14 07:30:00"),
    ("2021-11-07 01:30:00", "2021-11-07 06:30:00"), ("2021-11-07 00:30:00", "2021-11-07 04:30:00"), ("2021-11-07 02:30:00", "2021-11-07 07:30:00")])
def test_clock_changes(spark, wall, utc):
    assert one(spark, timeops.to_utc(lit(wall, "timestamp_ntz"), "America/New_York"))[0] == dt.datetime.fromisoformat(utc)


def test_half_hour_clock_change(spark):
    # Lord Howe goes back by 30 minutes at 02:00 summer time
    assert one(spark, timeops.to_utc(lit("2021-04-04 01:45:00", "timestamp_ntz"), "Australia/Lord_Howe"))[0] == dt.datetime(2021, 4, 3, 15, 15)


def test_month_end_is_clamped(spark):
    assert one(spark, timeops.add_month(lit("2024-01-31 10:00:00", "timestamp_ntz")))[0] == dt.datetime(2024, 2, 29, 10)


def test_calendar_and_islands(spark):
    days = timeops.calendar(spark, "2024-02-27", "2024-03-02")
    assert days.count() == 5
    kept = days.filter("day <> '2024-02-29'")
    out = timeops.islands(kept.unionAll(kept), [], "day").orderBy("island_start").collect()
    assert [(str(r[0]), r[2]) for r in out] == [("2024-02-27", 2), ("2024-03-01", 2)]
    assert timeops.fill_gaps(kept.withColumn("n", F.lit(1)), "day", {"n": 0}).agg(F.sum("n"), F.count("n")).first()[:] == (4, 5)


def test_json_nulls_and_merge(spark):
    doc = nested.json_object(a=lit(None), b=lit("1"))
    row = one(spark, doc, nested.has_key(doc, "a"), nested.has_key(doc, "c"), nested.null_kind(doc, "a"), nested.null_kind(doc, "c"), nested.null_kind(lit(None), "a"),
              nested.merge(lit('{"a":"1","b":"2"}'), lit('{"b":null,"c":"3"}')), nested.set_field(lit('{"a":"1"}'), "a", lit("9")), nested.drop_field(lit('{"a":"1","b":"2"}'), "a"))
    assert json.loads(row["c0"]) == {"a": None, "b": "1"}
    assert list(row)[1:6] == [True, False, "json_null", "absent", "sql_null"]
    assert json.loads(row["c6"]) == {"a": "1", "b": None, "c": "3"}
    kinds = lit('{"n":1,"b":true,"o":{"z":[1,2],"q":"é\\"x"},"j":null}')
    row2 = one(spark, nested.set_field(kinds, ["o", "z"], lit(5, "int")), nested.drop_field(kinds, ["o", "z"]), nested.merge(kinds, lit('{"n":{"deep":2.5}}')))
    assert json.loads(row2["c0"]) == {"n": 1, "b": True, "o": {"z": 5, "q": 'é"x'}, "j": None}
    assert json.loads(row2["c1"]) == {"n": 1, "b": True, "o": {"q": 'é"x'}, "j": None}
    assert json.loads(row2["c2"]) == {"n": {"deep": 2.5}, "b": True, "o": {"z": [1, 2], "q": 'é"x'}, "j": None}
    assert json.loads(row["c7"]) == {"a": "9"} and json.loads(row["c8"]) == {"b": "2"}


@pytest.mark.parametrize("doc,valid", [
    ('{"event_type":"x","occurred_at":"t","data":{"a":1}}', True), ('{"event_type":"","occurred_at":"t","data":{}}', False),
    ('{"event_type":"x","data":{}}', False), ('{"event_type":"x","occurred_at":"t","data":[1]}', False), ('{"event_type":"x","occurred_at":null,"data":{}}', True), ("broken", False)])
def test_event_validation(spark, doc, valid):
    assert one(spark, nested.valid_event(lit(doc)))[0] is valid


def test_matrix_counts_from_one(spark):
    assert one(spark, nested.matrix_get(F.expr("array(array(1,2,3), array(4,5,6))"), 2, 1))[0] == 4


def test_sql_functions(spark):
    udfs.create_sql_functions(spark)
    row = spark.sql("SELECT order_label('new', 42), gross_price(199.99, 20), relative_change(50, 75), relative_change(0, 10)").first()
    assert list(row) == ["N-0000000042", Decimal("239.99"), Decimal("50.00"), None]
