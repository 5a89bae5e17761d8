import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators import quality as Q
from tabularium.operators.projection import row_count, search, split_by_key


@pytest.fixture(scope="module")
def lab(spark):
    """Versions of a few keys: exact copies, a NULL value, ties in time, a tombstone."""
    rows = [(1, "A", "x", 1, False), (2, "A", "x", 1, False), (3, "A", None, 2, False), (4, "B", "p", 1, False), (5, "B", "q", 3, False),
            (6, "B", "r", 3, False), (7, "C", "z", 1, False), (8, "C", "z", 2, True), (9, None, "n", 1, False), (10, None, "m", 2, False)]
    return spark.createDataFrame(rows, "id int, key string, value string, at int, is_deleted boolean")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_keep_rules(lab):
    last = [F.col("at").desc(), F.col("id").desc()]
    assert ids(Q.dedup_keep(lab, ["key"], F.col("id").asc())) == [1, 4, 7, 9]
    assert ids(Q.dedup_keep(lab, ["key"], *last)) == [3, 6, 8, 10]
    assert ids(Q.dedup_keep(lab, ["key"], Q.completeness("value").desc(), *last)) == [2, 6, 8, 10]


def test_tombstones_are_applied_to_the_last_version(lab):
    assert ids(Q.latest_alive(lab, ["key"], [F.col("at").desc(), F.col("id").desc()], "is_deleted")) == [3, 6, 10]


def test_duplicates(lab):
    assert {(r["key"], r["rows_count"]) for r in Q.duplicate_groups(lab, ["key"]).collect()} == {("A", 3), ("B", 3), ("C", 2), (None, 2)}
    assert {(r["key"], r["distinct_values"]) for r in Q.conflicts(lab, ["key"], "value").collect()} == {("B", 3), (None, 2)}
    m = Q.dup_metrics(lab, ["key"], "value").first()
    assert (m["total_rows"], m["unique_keys"], m["duplicate_rows"], m["conflict_keys"], m["duplicate_pct"]) == (10, 4, 6, 2, 60.0)


def test_profile(lab):
    row = {r["column_name"]: r for r in Q.profile(lab, ["key", "value"]).collect()}["value"]
    assert (row["rows_count"], row["nulls"], row["distinct_values"], row["lowest"], row["highest"], row["top_value"], row["top_rows"]) == (10, 1, 7, "m", "z", "x", 2)


def test_rules_split_and_gate(spark, lab):
    rules = [Q.Rule("key_missing", "critical", Q.not_null("key")), Q.Rule("late", "warning", Q.outside("at", 0, 2))]
    ok, bad = Q.split_valid(lab, rules, "id", "b1")
    assert ok.count() + bad.count() == lab.count()
    assert {r["reason"] for r in bad.collect()} == {"key_missing", "late"}
    report = Q.check_rules(lab, rules)
    assert {(r["rule"], r["violations"], r["status"]) for r in report.collect()} == {("key_missing", 2, "FAIL"), ("late", 2, "FAIL")}
    assert Q.gate(report).first()["publish"] is False
    assert Q.gate(report.filter("severity = 'warning'")).first()["publish"] is True
    assert Q.unique_rule(lab, ["key"], "u").first()["violations"] == 6
    ref = spark.createDataFrame([("A",), ("B",)], "key string")
    assert Q.reference_rule(lab, ref, "key", "r").first()["violations"] == 4


def test_reconcile_sees_what_differs(lab):
    rows = lab.withColumn("amount", F.col("at").cast("decimal(18,2)"))
    same = Q.reconcile(rows, rows.repartition(7), ["id"], ["amount"], ["id", "value"]).first()
    assert same["equal"] and same["missing_keys"] == same["extra_keys"] == 0
    changed = rows.withColumn("value", F.when(F.col("id") == 1, "y").otherwise(F.col("value"))).filter("id <> 4")
    diff = Q.reconcile(rows, changed, ["id"], ["amount"], ["id", "value"]).first()
    assert not diff["equal"] and diff["missing_keys"] == 1 and diff["source_rows"] - diff["target_rows"] == 1
    nothing = Q.reconcile(rows, rows.limit(0), ["id"], ["amount"], ["id"]).first()
    assert nothing["target_rows"] == 0 and nothing["missing_keys"] == 10 and not nothing["equal"]


def test_schema_contract(lab):
    got = {r["column_name"]: (r["present"], r["bad_values"]) for r in Q.check_schema(lab, T.StructType.fromDDL("id int, value int, extra string")).collect()}
    assert got == {"id": (True, 0), "value": (True, 9), "extra": (False, None)}


def test_grain_counts_null_keys(lab):
    g = Q.grain(lab, ["key"]).first()
    assert (g["rows_count"], g["unique_keys"], g["grain_is_unique"]) == (10, 4, False)


def test_missing_days(spark):
    df = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'2024-01-02', DATE'2024-01-05')) AS d")
    assert sorted(str(r["d"]) for r in Q.missing_days(df, "d").collect()) == ["2024-01-03", "2024-01-04"]


def test_search_and_allowed_names(spark, lab):
    assert search(lab, {"key": None}).count() == 10
    assert search(lab, {"key": ["A", "C"], "value": "z"}).count() == 2
    with pytest.raises(ValueError):
        row_count(spark, "secrets", {"orders": "/x"})


def test_split_is_complete_and_repeatable(spark):
    df = spark.range(5000)
    parts = split_by_key(df, ["id"], {"a": 3, "b": 1})
    again = split_by_key(df.repartition(13), ["id"], {"a": 3, "b": 1})
    assert parts.exceptAll(again).count() == 0
    n = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sum(n.values()) == 5000 and 3600 < n["a"] < 3900


def test_reconciliation_sees_moved_nulls_and_sums(spark):
    a = spark.createDataFrame([(1, "x", None, 30)], "k int, p string, q string, amount int")
    b = spark.createDataFrame([(1, None, "x", 30)], "k int, p string, q string, amount int")
    c = spark.createDataFrame([(1, "x", None, 119)], "k int, p string, q string, amount int")

    def equal(other):
        return Q.reconcile(a, other, ["k"], ["amount"], ["p", "q"]).first()["equal"]
    assert equal(a) and not equal(b) and not equal(c)


@pytest.mark.parametrize("source,target", [
    ([(1, "a", "b", 5), (2, "c", "d", 7)], [(1, "a", "b", 7), (2, "c", "d", 5)]),  # amounts exchanged between keys
    ([(1, "a", "b", 5), (2, "c", "d", 5)], [(1, "c", "d", 5), (2, "a", "b", 5)]),  # texts exchanged between keys
    ([(1, "a|b", "c", 5)], [(1, "a", "b|c", 5)]), ([(1, None, "c", 5)], [(1, "<null>", "c", 5)]), ([(1, "-", None, 5)], [(1, None, "-", 5)]),
    ([(1, "1:a", "", 5)], [(1, "1:a1:", "", 5)]), ([(1, "a", "b", 5)] * 2, [(1, "a", "b", 5), (1, "a", "c", 5)])])
def test_reconciliation_compares_per_key(spark, source, target):
    ddl = "k int, p string, q string, amount int"
    a, b = spark.createDataFrame(source, ddl), spark.createDataFrame(target, ddl)
    got = Q.reconcile(a, b, ["k"], ["amount"], ["p", "q"]).first()
    assert not got["equal"] and got["differing_keys"] > 0 and got["missing_keys"] == got["extra_keys"] == 0
    assert Q.reconcile(b, b.repartition(3), ["k"], ["amount"], ["p", "q"]).first()["equal"]


def test_profile_orders_values_by_type_in_one_pass(spark):
    df = spark.sql("""SELECT * FROM VALUES (10, 2.5D, '10', DATE'2024-02-01', true, 1.10), (9, -1e30D, '9', DATE'1999-12-31', false, 20.00), (9, NULL, NULL, NULL, NULL, NULL),
        (-9223372036854775808, double('nan'), 'x', DATE'2024-02-01', true, 3.00) AS t(i, d, s, day, b, m)""")
    got = {r["column_name"]: r for r in Q.profile(df, df.columns).collect()}
    assert [(got[c]["lowest"], got[c]["highest"]) for c in df.columns] == [
        ("-9223372036854775808", "10"), ("-1.0E30", "NaN"), ("10", "x"), ("1999-12-31", "2024-02-01"), ("false", "true"), ("1.10", "20.00")]
    assert got["i"]["top_value"] == "9" and got["day"]["top_rows"] == 2 and got["s"]["nulls"] == 1 and got["i"]["distinct_values"] == 3
    plan = Q.profile(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LocalTableScan") == 1 and plan.count("hashpartitioning") == 2
    assert Q.profile(df.limit(0), ["i"]).count() == 0
    top = {(r["column_name"], r["value"]) for r in Q.frequent_values(df, ["i", "s"], 1).collect()}
    assert top == {("i", "9"), ("s", None)}
