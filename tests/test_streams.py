import datetime as dt
import os

import pytest

from tabularium.session import scratch_path
from tabularium.streaming import streams as ST

DDL = "id string, user_name string, email string, age string, site_action string, event_date string"


@pytest.mark.parametrize("row,expected", [
    (("1", " ada  LOVE ", " A@b.co ", "36", "VIEW", "2024-01-02"), (1, "Ada Love", "a@b.co", 36, "view", dt.datetime(2024, 1, 2))),
    (("1", "a", "a@b.co", "101", "view", "2024-01-02T03:04:05"), (1, "A", "a@b.co", 0, "view", dt.datetime(2024, 1, 2, 3, 4, 5))),
    (("1", "a", "a@b.co", None, "view", "2024-01-02 03:04"), (1, "A", "a@b.co", 0, "view", dt.datetime(2024, 1, 2, 3, 4))),
    (("x", "a", "a@b.co", "1", "view", "2024-01-02"), None), (("1", " ", "a@b.co", "1", "view", "2024-01-02"), None), (("1", "a" * 100, "a@b.co", "1", "view", "2024-01-02"), None),
    (("1", "a", "a@b", "1", "view", "2024-01-02"), None), (("1", "a", "a@b.co", "1", "jump", "2024-01-02"), None), (("1", "a", "a@b.co", "1", "view", "2024"), None), ((None,) * 6, None)])
def test_clean_events(spark, row, expected):
    out = ST.clean_events(spark.createDataFrame([row], DDL)).first()
    assert bool(out["is_valid"]) is (expected is not None)
    if expected:
        assert tuple(out)[:6] == expected


def test_sink_ignores_known_ids(spark):
    src, target, checkpoint = [scratch_path(spark, n) for n in ("src", "target", "checkpoint")]
    for rows in ([(1, "a"), (2, "b"), (2, "c")], [(2, "z"), (3, "d")], []):
        df = spark.createDataFrame(rows, "id int, v string")
        df.write.mode("append").parquet(src)
        out = ST.upsert_stream(ST.source(spark, src, df.schema), target, checkpoint, "id", ["v"])
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b"), (3, "d")]
    # the whole source once more, as after a lost checkpoint
    again = ST.upsert_stream(ST.source(spark, src, df.schema), target, scratch_path(spark, "fresh"), "id", ["v"])
    assert again.count() == 3


def test_sink_reads_nothing_of_its_target(spark):
    """Files of earlier batches are made unreadable: later batches go on without them and know every key."""
    src, target, checkpoint = [scratch_path(spark, n) for n in ("src", "target", "checkpoint")]
    df = spark.createDataFrame([(i, "a") for i in range(50)], "id int, v string")
    df.write.parquet(src)
    ST.upsert_stream(ST.source(spark, src, df.schema), target, checkpoint, "id", ["v"])
    kept = {}
    for folder, _, names in os.walk(target):
        for name in names:
            if name.endswith(".parquet"):
                at = os.path.join(folder, name)
                kept[at] = open(at, "rb").read()
                open(at, "wb").write(b"not parquet")
    spark.createDataFrame([(i, "b") for i in range(45, 55)] + [(None, "n"), (None, "m")], df.schema).write.mode("append").parquet(src)
    ST.upsert_stream(ST.source(spark, src, df.schema), target, checkpoint, "id", ["v"])
    for at, data in kept.items():
        if "batch=none" not in at:
            for crc in (os.path.join(os.path.dirname(at), f".{os.path.basename(at)}.crc"),):
                assert os.path.exists(crc)
            open(at, "wb").write(data)
    got = spark.read.schema(df.schema).parquet(target).select("id", "v").collect()
    assert sorted(map(str, got)) == sorted(map(str, [*[(r) for r in df.collect()], *spark.createDataFrame(
        [(i, "b") for i in range(50, 55)] + [(None, "m")], df.schema).collect()]))


def test_a_repeated_batch_replaces_itself(spark):
    """The write of a batch succeeded and its commit was lost: the batch runs again and adds nothing."""
    src, target, checkpoint = [scratch_path(spark, n) for n in ("src", "target", "checkpoint")]
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    df.write.parquet(src)
    ST.upsert_stream(ST.source(spark, src, df.schema), target, checkpoint, "id", ["v"])
    for name in ("0", ".0.crc"):
        os.rename(f"{checkpoint}/commits/{name}", f"{checkpoint}/lost-{name}")
    out = ST.upsert_stream(ST.source(spark, src, df.schema), target, checkpoint, "id", ["v"])
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b")]


def test_drain_goes_on_where_it_ended(spark):
    src, out, checkpoint = [scratch_path(spark, n) for n in ("src", "out", "checkpoint")]
    df = spark.range(5)
    for expected in (5, 10):
        df.write.mode("append").parquet(src)
        assert ST.drain(ST.source(spark, src, df.schema), out, checkpoint).count() == expected
    assert ST.drain(ST.source(spark, src, df.schema), out, checkpoint).count() == 10
