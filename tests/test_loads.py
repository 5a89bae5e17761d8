import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabularium.operators.quality import Rule
from tabularium.operators.sets import frame_diff
from tabularium.plans import loads as L
from tabularium.plans import marts as M


def same(a, b):
    return frame_diff(a, b.select(a.columns)).count() == 0


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "k int, v string, at int")


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(2, "B", 20), (3, None, 30), (4, "d", 40)], "k int, v string, at int")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_new_is_idempotent(target, source):
    once = L.insert_new(target, source, "k")
    assert sorted(r["k"] for r in once.collect()) == [1, 2, 3, 4]
    assert same(once, L.insert_new(once, source, "k"))


def test_merge(target, source):
    out = L.merge(target, source, "k", ["v", "at"], note="action")
    assert {r["k"]: (r["v"], r["action"]) for r in out.collect()} == {1: ("a", "kept"), 2: ("B", "updated"), 3: (None, "kept"), 4: ("d", "inserted")}
    once = out.drop("action")
    assert same(once, L.merge(once, source, "k", ["v", "at"]))


def test_reload_slice_is_idempotent(target):
    changed = target.withColumn("v", F.lit("new"))
    once = L.reload_slice(target, changed, "at", F.lit(20), F.lit(30))
    assert {r["k"]: r["v"] for r in once.collect()} == {1: "a", 2: "new", 3: None}
    assert same(once, L.reload_slice(once, changed, "at", F.lit(20), F.lit(30)))


def test_marks(spark):
    log = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (5, 15)], "id int, at int")
    mark = spark.createDataFrame([(20, 2)], "last_at int, last_id int")
    assert rows(L.increment(log, mark, "at", "id")) == [(3, 20)]
    assert rows(L.increment(log, mark, "at", "id", late=True)) == [(3, 20), (5, 15)]
    batch = L.increment(log, mark, "at", "id")
    assert rows(L.advance(mark, batch, "at", "id", True)) == [(20, 3)]
    assert rows(L.advance(mark, batch, "at", "id", False)) == [(20, 2)]
    assert rows(L.advance(mark, batch.limit(0), "at", "id", True)) == [(20, 2)]
    assert rows(L.advance(mark, log.filter("at = 10"), "at", "id", True)) == [(20, 2)]  # never backwards


def test_late_row_lands_once(spark):
    seen = spark.createDataFrame([(1, 10), (2, 20)], "id int, at int")
    src = spark.createDataFrame([(1, 10), (2, 20), (9, 19), (8, 5)], "id int, at int")
    once = L.increment_overlap(seen, src, "at", "id", F.lit(2))
    assert rows(once) == [(1, 10), (2, 20), (9, 19)]
    assert same(once, L.increment_overlap(once, src, "at", "id", F.lit(2)))


def test_delete_and_archive_keep_unknown(target):
    assert sorted(r["k"] for r in L.delete(target, F.col("v") == "a").collect()) == [2, 3]
    hot, cold = L.archive(target, F.col("v") == "a")
    assert hot.count() + cold.count() == 3 and cold.count() == 1


def test_update_from(spark, target):
    other = spark.createDataFrame([(1, "x")], "k int, w string")
    out = L.update_from(target, other, "k", F.col("w") == "x", {"at": F.col("at") * 2})
    assert {r["k"]: r["at"] for r in out.collect()} == {1: 20, 2: 20, 3: 30}


def test_guard_stops_the_job(target):
    assert L.require(target, F.col("at") > 0, "at").count() == 3
    with pytest.raises(PySparkException, match="too small"):
        L.require(target, F.col("at") > 10, "too small").collect()
    with pytest.raises(PySparkException, match="unknown"):
        L.require(target, F.col("v") != "q", "unknown").collect()


def test_ledger_counts_an_operation_once(spark):
    accounts = spark.createDataFrame([(1, 100), (2, 50), (3, 0)], "account_id int, balance int")
    ops = spark.createDataFrame([("t1", 1, 2, 30), ("t1", 1, 2, 30), ("t2", 2, 3, 5)], "operation_id string, from_account int, to_account int, amount int")
    out = {r["account_id"]: r["balance"] for r in L.apply_operations(accounts, ops).collect()}
    assert out == {1: 70, 2: 75, 3: 5} and sum(out.values()) == 150


def test_run_log_stops_at_a_failure(spark, target):
    def fail():
        raise ValueError("no source")
    log = L.run_log(spark, "r", [L.Stage("one", lambda: (target, target.filter("k = 1"))), L.Stage("two", fail), L.Stage("three", lambda: (target, None))]).collect()
    assert [(r["stage"], r["status"], r["rows_written"], r["rows_rejected"]) for r in log] == [("one", "SUCCESS", 3, 1), ("two", "FAILED", 0, 0)]
    assert "no source" in log[1]["error_message"]


def test_retry_gives_whole_rows_once(spark, target):
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) == 1:
            return L.require(target, F.col("at") > 10, "bad day"), None
        return target, None
    log = L.run_log(spark, "r", [L.Stage("load", flaky, retries=2, max_seconds=600), L.Stage("next", lambda: (target, None), max_seconds=0)]).collect()
    assert [(r["stage"], r["attempt"], r["status"], r["rows_written"], r["sla_status"]) for r in log] == [
        ("load", 1, "FAILED", 0, "MISSED"), ("load", 2, "SUCCESS", 3, "MET"), ("next", 1, "SUCCESS", 3, "MISSED")]


def test_layered_load_counts(spark, target):
    raw = target.unionByName(target.filter("k = 1").withColumn("at", F.lit(99)))
    layers = L.layered_load(raw, lambda d: d, [Rule("v_missing", "critical", F.col("v").isNull())], "k", [F.col("at").desc()], "b")
    n = {r["layer"]: r["rows_count"] for r in L.layer_counts(raw, layers).collect()}
    assert n == {"raw": 4, "staging": 4, "accepted": 3, "rejected": 1, "core": 2}
    assert {r["k"]: r["at"] for r in layers.core.collect()} == {1: 99, 2: 20}


def test_full_refresh_twice(target):
    a, report = L.full_refresh(target, ["k"], ["at"], ["k", "v"])
    b, _ = L.full_refresh(target, ["k"], ["at"], ["k", "v"])
    assert report.first()["equal"] and same(a, b)


def test_scd2(spark):
    ddl = "k int, city string, valid_from int, valid_to int, is_current boolean"
    dim = spark.createDataFrame([(1, "a", 0, None, True), (2, "b", 0, 5, False), (2, "c", 5, None, True), (3, None, 0, None, True)], ddl)
    src = spark.createDataFrame([(1, "z"), (2, "c"), (3, None), (4, "new")], "k int, city string")
    out = M.scd2(dim, src, "k", ["city"], F.lit(9))
    assert set(map(tuple, out.collect())) == {(1, "a", 0, 9, False), (1, "z", 9, None, True), (2, "b", 0, 5, False), (2, "c", 5, None, True), (3, None, 0, None, True), (4, "new", 9, None, True)}
    assert same(out, M.scd2(out, src, "k", ["city"], F.lit(11)))


@pytest.mark.parametrize("max_group", [1000, 0])
def test_scd2_history_folds_repeats(spark, max_group):
    log = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (1, "a", 4), (2, None, 1), (2, None, 2)], "k int, city string, at int")
    out = {tuple(r) for r in M.scd2_history(log, "k", ["city"], "at", [], max_group).collect()}
    assert out == {(1, "a", 1, 3, False), (1, "b", 3, 4, False), (1, "a", 4, None, True), (2, None, 1, None, True)}


def test_dimension_keys_are_stable(spark):
    src = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "bk string, x int")
    one = M.build_dim(src, "bk", ["x"], "sk")
    assert {r["bk"]: r["sk"] for r in one.collect()} == {"a": 1, "b": 2, "c": 3}
    assert same(one, M.build_dim(src.repartition(7), "bk", ["x"], "sk"))
    full = M.with_unknown(one, "bk", "sk", {"x": 0})
    facts = M.lookup_or_unknown(spark.createDataFrame([("a",), ("q",)], "bk string"), full, "bk", "sk")
    assert {r["bk"]: r["sk"] for r in facts.collect()} == {"a": 1, "q": -1}


def test_hashed_keys_need_no_order(spark):
    dim = M.hashed_dim(spark.range(1000).select(F.col("id").cast("string").alias("bk")), "bk", [], "sk")
    assert dim.select("sk").distinct().count() == 1000
    assert "Exchange" not in dim._jdf.queryExecution().executedPlan().toString()
    assert same(dim, M.hashed_dim(dim.select("bk").repartition(5), "bk", [], "sk"))


def test_served_version(spark):
    cat = spark.createDataFrame([("m", 1, "READY", 5, 5, 0), ("m", 2, "READY", 6, 6, 0), ("m", 3, "READY", 7, 6, 0), ("m", 4, "BUILDING", 7, 7, 0)],
                                "mart string, version long, status string, row_count long, key_count long, checksum long")
    out = {r["version"]: (r["status"], r["served"]) for r in M.latest_published(cat).collect()}
    assert out == {1: ("PUBLISHED", False), 2: ("PUBLISHED", True), 3: ("READY", False), 4: ("BUILDING", False)}


def test_inserts_and_merges_with_null_and_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    src = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "k int, v string")
    once = L.insert_new(target, src, "k")
    assert sorted(map(str, once.collect())) == sorted(map(str, L.insert_new(once, src, "k").collect()))
    assert {(r["k"], r["v"]) for r in once.collect()} == {(1, "a"), (None, "b"), (2, "z")}
    merged = L.merge(target, src, "k", ["v"])
    assert {(r["k"], r["v"]) for r in merged.collect()} == {(1, "x"), (None, "n"), (2, "z")}
    assert L.merge(merged, src, "k", ["v"]).count() == 3


def test_first_load_and_failed_load(spark):
    log = spark.createDataFrame([(1, 10), (2, 20)], "id int, at int")
    empty = L.mark_of(log.limit(0), "at", "id")
    assert L.increment(log, empty, "at", "id").count() == 2
    assert L.increment_overlap(log.limit(0), log, "at", "id", F.lit(5)).count() == 2

    def broken(rows):
        raise OSError("no space")
    with pytest.raises(OSError):
        L.advance_after(empty, log, "at", "id", broken)
    assert L.advance_after(empty, log, "at", "id", lambda rows: rows.count()).first()["last_id"] == 2


def test_append_new_writes_only_what_is_missing(spark):
    from tabularium.session import scratch_path

    path = scratch_path(spark, "target")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(path)
    src = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert L.append_new(spark, path, src, "k") == 1 and L.append_new(spark, path, src, "k") == 0
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "y")}


def test_snapshot_keeps_rows_without_a_date(spark):
    import datetime

    target = spark.createDataFrame([("a", 1, None)], "k string, orders_count long, as_of_date date")
    facts = spark.createDataFrame([("a", datetime.datetime(2024, 1, 1))], "k string, at timestamp_ntz")
    assert L.snapshot(target, facts, "k", "at", "2024-01-02").count() == 2
