"""Stored tables: which files change, what a reader sees of a change that fails, and marts refreshed by directory."""

import datetime
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabularium.plans import loads as L
from tabularium.plans import marts as M
from tabularium.session import scratch_path
from tabularium.sources import storage
from tabularium.sources.stored import RECORDS, Conflict, StoredTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark):
    """1000 rows, keys in ranges over several files."""
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("v"), F.lit("a").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a file per range, however small
    try:
        made = StoredTable.create(df, scratch_path(spark, "stored"), ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(made.current().files) == 8
    return made


def holding(table, low, high):
    return set(table.files_with(table.current(), F.col("id").between(low, high)))


def test_merge_rewrites_only_files_with_changed_rows(spark, table):
    before = table.current()
    hit = holding(table, 3, 5)
    src = spark.createDataFrame([(3, 99, "b"), (4, 4, "a"), (5, 98, "b"), (5, 97, "b"), (900, 0, "a"), (5000, 1, "n"), (5000, 1, "m")],
                                "id long, v long, text string")
    report = table.merge(src, "id", ["v", "text"])
    assert rows(report) == rows(spark.createDataFrame([(3, "updated"), (4, "kept"), (5, "updated"), (900, "kept"), (5000, "inserted")], "id long, action string"))
    after = table.current()
    assert set(before.files) - set(after.files) == hit and len(hit) == 1  # the file of row 900 is untouched: it is equal
    got = {r.id: (r.v, r.text) for r in table.read().collect()}
    assert len(got) == 1001 == table.read().count()
    assert got[3] == (99, "b") and got[5] == (98, "b") and got[4] == (4, "a") and got[5000] == (1, "n") and got[900] == (0, "a")
    table.merge(src, "id", ["v", "text"])  # again: nothing changes
    assert set(table.current().files) == set(after.files)


def test_merge_with_null_keys_and_into_nothing(spark):
    empty = StoredTable.create(spark.createDataFrame([], "k int, v string"), scratch_path(spark, "stored"))
    src = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert rows(empty.read()) == [] and {r.action for r in empty.merge(src, "k", ["v"]).collect()} == {"inserted"}
    report = empty.merge(spark.createDataFrame([(None, "c"), (1, "a")], "k int, v string"), "k", ["v"])
    assert {(r.k, r.action) for r in report.collect()} == {(None, "updated"), (1, "kept")}
    assert {tuple(r) for r in empty.read().collect()} == {(1, "a"), (None, "c")}


def test_a_failed_write_leaves_the_old_version(spark, table):
    before, held = table.current(), rows(table.read())
    bad = table.read().withColumn("v", F.raise_error(F.lit("disk full")).cast("long"))
    with pytest.raises(PySparkException, match="disk full"):
        table.replace_where(F.col("id") < 10, bad)
    with pytest.raises(PySparkException, match="disk full"):
        table.append(bad)
    assert table.current() == before and rows(table.read()) == held


def test_a_torn_record_is_not_read(spark, table):
    before, held = table.current(), rows(table.read())
    files, _ = table.put(table.read().limit(5))
    with open(f"{table.path}/{RECORDS}/{before.number + 1:012d}.json", "w") as f:
        f.write('{"number": 2, "files": ["data/')  # the writer died here
    assert table.current() == before and rows(table.read()) == held
    assert table.append(table.read().limit(1)) == 1
    assert table.current().number == before.number + 2 and table.read().count() == 1001


def test_of_two_writers_one_fails(table):
    base = table.current()
    table.append(table.read().limit(1))
    files, _ = table.put(table.read().limit(3))
    with pytest.raises(Conflict):
        table.publish(base, (*base.files, *files))
    assert table.read().count() == 1001


def test_slices_keep_other_files_and_unknown_rows(spark, table):
    table.append(spark.createDataFrame([(2000, None, "u")], table.schema))
    before, hit = set(table.current().files), holding(table, 100, 110)
    src = table.read().withColumn("text", F.lit("new"))
    L.reload_stored_slice(table, src, "id", F.lit(100), F.lit(110))
    after = set(table.current().files)
    assert before - after == hit and len(after & before) == len(before) - len(hit)
    got = {r.id: r.text for r in table.read().collect()}
    assert len(got) == 1001 and {i for i, t in got.items() if t == "new"} == set(range(100, 110))
    held = rows(table.read())
    L.reload_stored_slice(table, src, "id", F.lit(100), F.lit(110))
    assert rows(table.read()) == held
    table.replace_where(F.col("v") == 7, src.limit(0))  # a row with unknown v stays
    assert 2000 in {r.id for r in table.read().collect()} and table.read().filter("v = 7").count() == 0


def test_swap_checks_before_and_goes_back(spark, table):
    first, held = table.current(), rows(table.read())
    for staged in (table.read().filter("v = 3").limit(0), table.read().filter("v IN (3, 4)")):
        with pytest.raises(ValueError, match="does not match"):
            L.swap_slice(table, staged, "v", "3")
        assert table.current() == first and rows(table.read()) == held
    assert L.swap_slice(table, table.read().filter("v = 3 AND id < 100"), "v", "3") == 10
    assert table.read().filter("v = 3").count() == 10 and table.read().count() == 910
    table.revert(first.number)
    assert rows(table.read()) == held
    # files of versions that are not kept go; what the kept ones list stays
    assert table.drop_unused(keep=1) > 0 and rows(table.read()) == held
    assert [v.note for v in table.versions()] == ["revert to 1"]
    left = [f"data/{d}/{f}" for d in os.listdir(f"{table.path}/data") for f in os.listdir(f"{table.path}/data/{d}") if f.startswith("part-")]
    assert set(left) == set(table.current().files)


def test_rows_and_mark_are_one_record(spark, monkeypatch):
    log = spark.createDataFrame([(i, datetime.datetime(2024, 1, 1 + i)) for i in range(9)], "id long, at timestamp_ntz")
    table = StoredTable.create(log.filter("id < 3"), scratch_path(spark, "log"), mark=L.mark_text(L.mark_of(log.filter("id < 3"), "at", "id")))

    def killed(*_, **__):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(table, "publish", killed)
        for _ in range(2):
            with pytest.raises(KeyboardInterrupt):
                L.load_increment(table, log, "at", "id")
    assert table.read().count() == 3 and L.stored_mark(table, "at", "id").first().last_id == 2
    assert L.load_increment(table, log, "at", "id") == 6 and L.load_increment(table, log, "at", "id") == 0
    assert rows(table.read()) == rows(log)
    mark = L.stored_mark(StoredTable(spark, table.path, table.schema), "at", "id").first()
    assert (mark.last_at, mark.last_id) == (datetime.datetime(2024, 1, 9), 8)
    first = StoredTable.create(log.limit(0), scratch_path(spark, "log"))  # no mark: the first load takes all
    assert L.load_increment(first, log, "at", "id") == 9
    assert L.append_missing(first, log, "id") == 0 and first.read().count() == 9


def test_text_partitions_keep_their_type(spark):
    path = scratch_path(spark, "codes")
    df = spark.createDataFrame([(1, "007"), (2, "7"), (3, None)], "x int, code string")
    storage.write_partitioned(df, path, ["code"])
    assert rows(storage.read_partitioned(spark, path)) == rows(df)
    assert storage.read_partitioned(spark, path).schema["code"].dataType.simpleString() == "string"
    storage.overwrite_partitions(df.filter("code = '7'").withColumn("x", F.lit(9)), path, ["code"])
    assert rows(storage.read_partitioned(spark, path)) == rows(spark.createDataFrame([(1, "007"), (9, "7"), (3, None)], df.schema))


@pytest.fixture
def marts(spark):
    """Trades of four months, with their stored bars."""
    def trade(i):
        return "S", datetime.date(2024, 1 + i % 4, 1 + i % 28), datetime.datetime(2024, 1 + i % 4, 1 + i % 28, i % 24), i, 1, i, i, i, i
    ddl = "secid string, day date, shipped_at timestamp_ntz, value long, quantity long, order_id long, item_id long, seller_id long, product_id long"
    trades = spark.createDataFrame([trade(i) for i in range(200)], ddl).withColumn("month", M.month_text())
    paths = [scratch_path(spark, p) for p in ("facts", "days", "months")]
    storage.write_partitioned(trades, paths[0], ["month"])
    M.store_bars(storage.read_partitioned(spark, paths[0]), *paths[1:])
    return trades, paths


def files_of(path):
    return {f"{os.path.basename(d)}/{f}" for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_refresh_touches_the_changed_months_only(spark, marts):
    trades, (facts, days, months) = marts
    late = trades.filter("month = '2024-02' AND day = '2024-02-06'").withColumn("value", F.col("value") + 1000)
    storage.write_partitioned(late, facts, ["month"], "append")
    before = [files_of(p) for p in (days, months)]

    plan, touched = M.refresh_bars(*[storage.read_partitioned(spark, p) for p in (facts, days)], late)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert touched == ["2024-02"] and text.count("PartitionFilters: [isnotnull(month") == 2 and text.count("(month#") >= 2

    for _ in range(2):
        assert M.refresh_stored_bars(spark, facts, days, months, late) == ["2024-02"]
        whole = M.daily_bars(storage.read_partitioned(spark, facts))
        got = storage.read_partitioned(spark, days)
        assert rows(got.select(whole.columns)) == rows(whole)
        per_month = storage.read_partitioned(spark, months)
        assert rows(per_month.select("secid", "month", "trades", "value")) == rows(
            M.monthly_bars(whole).select("secid", F.date_format("month", "yyyy-MM").alias("month"), "trades", "value"))
    for old, path in zip(before, (days, months)):
        assert {f for f in old if "2024-02" not in f} == {f for f in files_of(path) if "2024-02" not in f}
    assert M.refresh_stored_bars(spark, facts, days, months, late.limit(0)) == []


def test_a_month_without_trades_goes(spark, marts):
    trades, (facts, days, months) = marts
    gone = trades.filter("month = '2024-03'")
    storage.remove_partitions(spark, facts, "month", ["2024-03"])
    M.refresh_stored_bars(spark, facts, days, months, gone)
    for path in (days, months):
        assert {r.month for r in storage.read_partitioned(spark, path).select("month").distinct().collect()} == {"2024-01", "2024-02", "2024-04"}
