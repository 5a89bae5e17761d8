"""What a query holds or sends must not grow with its tables: batches of texts, broadcasts of versions, sketches."""

import datetime as dt

import pyarrow as pa
import pytest
from test_whole_texts import folded as fold

from tabularium.catalog import load_all
from tabularium.functions import udfs
from tabularium.operators import joins


def test_exact_counts_carry_no_sketches(spark, tmp_path):
    day = dt.datetime(2001, 2, 3)
    rows = [(i if i else None, i % 40, "FOP"[i % 3], 1.0, day + dt.timedelta(days=i % 50), None) for i in range(300)]
    ddl = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows + rows[:20], ddl).write.parquet(f"{tmp_path}/orders.parquet")
    got = load_all()["a6_approx_distinct"](spark, str(tmp_path))
    assert {tuple(r) for r in got.collect()} == {
        ("order_id", 299, True), ("customer_id", 40, True), ("order_status", 3, True), ("purchased_at", 50, True), ("priority", 0, True)}
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("sizes", [[600_000] * 5, [3_000_000, 0, 1, None, 10], [None, None], []])
def test_texts_are_folded_in_parts(sizes):
    texts = [None if n is None else ("é" + "ö" * n)[:n] for n in sizes]
    parts = list(udfs.folded_letters.func(iter([pa.array(texts, pa.string())])))
    assert [t for p in parts for t in p.to_pylist()] == [fold(t) for t in texts]
    assert all(len(p) < 2 or sum(map(len, filter(None, p.to_pylist()[1:]))) <= udfs.PART_CHARS for p in parts)


def test_overlapping_versions_are_not_broadcast(spark):
    dim = spark.createDataFrame([(k, 10 * i, 10 * i + 15, f"{k}:{i}") for k in range(5) for i in range(4)], "k int, lo int, hi int, v string")
    cut = joins.disjoint_versions(dim, "k", "lo", "hi", ["v"])
    assert cut.filter("k = 3").orderBy("lo").collect()[:3] == [(3, 0, 10, "3:0"), (3, 10, 15, "3:1"), (3, 15, 20, "3:1")]
    cut = joins.disjoint_versions(dim, "k", "lo", "hi", ["v"])
    assert "Broadcast" not in cut._jdf.queryExecution().executedPlan().toString()
