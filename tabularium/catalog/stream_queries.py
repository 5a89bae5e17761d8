"""Streaming queries: the given events are fed as files, drained, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabularium.catalog.registry import query
from tabularium.session import scratch_path
from tabularium.streaming import streams as ST
from tabularium.tables import Tables, lng


def ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def timed(t: Tables):
    return t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


def feed(t: Tables, *drops):
    """A source directory that gets one drop of files per run."""
    path = scratch_path(t.spark, "feed")
    return path, [lambda d=d: d.write.mode("append").parquet(path) for d in drops]


def run(t: Tables, plan, *drops):
    """Drain `plan(stream)` once per drop, with one checkpoint."""
    src, puts = feed(t, *drops)
    out, checkpoint = scratch_path(t.spark, "stream-out"), scratch_path(t.spark, "stream-checkpoint")
    result = None
    for put in puts:
        put()
        result = ST.drain(plan(ST.source(t.spark, src, drops[0].schema)), out, checkpoint)
    return result


@query("st1_ingest", "", "SELECT event_id, ts, user_id, event_type FROM events")
def ingest(t: Tables):
    rows = timed(t)
    src, puts = feed(t, rows.filter("event_type <> 'signup'"), rows.filter("event_type = 'signup'"))
    out, checkpoint = scratch_path(t.spark, "ingest"), scratch_path(t.spark, "ingest-checkpoint")
    for put in [*puts, lambda: None]:  # the last run finds nothing new
        put()
        got = ST.drain(ST.source(t.spark, src, rows.schema), out, checkpoint)
    return got.select("event_id", ntz("ts"), "user_id", "event_type")


SITE = """SELECT CASE WHEN user_id % 10 = 0 THEN 'x' ELSE CAST(event_id AS VARCHAR) END AS id, CASE WHEN user_id % 10 = 1 THEN '  ' ELSE '  uSER   number' || user_id || ' ' END AS user_name, CASE WHEN user_id % 10 = 2 THEN 'nobody' ELSE ' User' || user_id || '@Mail.Example ' END AS email,
    CASE WHEN user_id % 10 = 3 THEN 'old' WHEN user_id % 10 = 4 THEN '101' ELSE CAST(user_id % 100 AS VARCHAR) END AS age, upper(event_type) AS site_action, CASE WHEN user_id % 10 = 5 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_date, user_id, event_id, ts, event_type FROM events"""


def site_events(t: Tables):
    """Text events with faults that follow from the user number."""
    u = F.col("user_id") % 10
    uid = F.col("user_id").cast("string")
    return t.events.select(
        F.when(u == 0, "x").otherwise(F.col("event_id").cast("string")).alias("id"),
        F.when(u == 1, "  ").otherwise(F.concat(F.lit("  uSER   number"), uid, F.lit(" "))).alias("user_name"),
        F.when(u == 2, "nobody").otherwise(F.concat(F.lit(" User"), uid, F.lit("@Mail.Example "))).alias("email"),
        F.when(u == 3, "old").when(u == 4, "101").otherwise((F.col("user_id") % 100).cast("string")).alias("age"),
        F.upper("event_type").alias("site_action"), F.when(u == 5, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_date"))


CLEAN = f"""s AS ({SITE}), c AS (SELECT event_id AS id, 'User Number' || user_id AS user_name, 'user' || user_id || '@mail.example' AS email, CASE WHEN user_id % 10 IN (3, 4) THEN 0 ELSE user_id % 100 END AS age,
    event_type AS site_action, date_trunc('second', ts) AS event_date, user_id % 10 NOT IN (0, 1, 2, 5) AND event_type IN ('view', 'click', 'purchase') AS is_valid FROM s)"""


@query("st2_clean_events", "", f"WITH {CLEAN} SELECT id, user_name, email, age, site_action, event_date, 0::BIGINT AS rejected FROM c WHERE is_valid UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, COUNT(*) FROM c WHERE NOT is_valid")
def clean_events(t: Tables):
    done = run(t, ST.clean_events, site_events(t))
    good = done.filter("is_valid").drop("is_valid").withColumn("age", lng("age")).withColumn("rejected", F.lit(0).cast("long"))
    return good.unionByName(done.filter("NOT is_valid").agg(F.count(F.lit(1)).alias("rejected")), allowMissingColumns=True)


@query("st3_idempotent_sink", "", f"WITH {CLEAN} SELECT id, user_name, age, site_action, event_date FROM c WHERE is_valid")
def idempotent_sink(t: Tables):
    rows = site_events(t)
    src, puts = feed(t, rows, rows)  # every event is sent twice
    target, checkpoint = scratch_path(t.spark, "sink"), scratch_path(t.spark, "sink-checkpoint")
    for put in puts:
        put()
        valid = ST.clean_events(ST.source(t.spark, src, rows.schema)).filter("is_valid").drop("is_valid", "email")
        out = ST.upsert_stream(valid, target, checkpoint, "id", ["event_date", "user_name"])
    return out.withColumn("age", lng("age"))


@query("st4_dedupe_stream", "", "SELECT event_id, ts, event_type FROM events")
def dedupe_stream(t: Tables):
    rows = timed(t).select("event_id", "ts", "event_type")
    done = run(t, lambda s: ST.dedupe_stream(s, ["event_id"], "ts", "2 hours"), rows.unionByName(rows), rows)
    return done.withColumn("ts", ntz("ts"))


@query("st5_late_rows", "", """WITH e AS (SELECT *, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end FROM events), m AS (SELECT MAX(ts) FILTER (WHERE event_type <> 'signup') - INTERVAL 1 HOUR AS first_mark, MAX(ts) - INTERVAL 1 HOUR AS last_mark FROM events)
    SELECT window_start, window_end, COUNT(*) AS events_count FROM e, m WHERE window_end <= last_mark AND (event_type <> 'signup' OR window_end > first_mark) GROUP BY 1, 2""")
def late_rows(t: Tables):
    rows = timed(t)
    # signups arrive in a second drop, long after the windows of most of them were closed
    done = run(t, lambda s: ST.window_counts(s, "ts", [], "1 hour", None, "1 hour"), rows.filter("event_type <> 'signup'"), rows.filter("event_type = 'signup'"))
    return done.withColumn("window_start", ntz("window_start")).withColumn("window_end", ntz("window_end"))


@query("st6_windows", "", """WITH m AS (SELECT MAX(ts) AS mark FROM events), h AS (SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type FROM events),
    d AS (SELECT date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS window_start, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) + INTERVAL 7 DAY AS window_end, event_type FROM events, range(7) r(k)),
    a AS (SELECT 'tumbling' AS form, * FROM h UNION ALL SELECT 'sliding', * FROM d) SELECT form, window_start, window_end, event_type, COUNT(*) AS events_count FROM a, m WHERE window_end <= mark GROUP BY 1, 2, 3, 4""")
def windows(t: Tables):
    rows = timed(t)
    hours = run(t, lambda s: ST.window_counts(s, "ts", ["event_type"], "1 hour", None, "0 seconds"), rows)
    days = run(t, lambda s: ST.window_counts(s, "ts", ["event_type"], "7 days", "1 day", "0 seconds"), rows)
    both = hours.select(F.lit("tumbling").alias("form"), "*").unionByName(days.select(F.lit("sliding").alias("form"), "*"))
    return both.withColumn("window_start", ntz("window_start")).withColumn("window_end", ntz("window_end"))


@query("st7_session_windows", "", """WITH h AS (SELECT user_id, ts, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), f AS (SELECT *, SUM(CASE WHEN p IS NULL OR ts > p + INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM h),
    g AS (SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 6 HOUR AS session_end, COUNT(*) AS events_count FROM f GROUP BY user_id, s) SELECT * FROM g WHERE session_end <= (SELECT MAX(ts) FROM events)""")
def session_windows(t: Tables):
    with ST.local_session_merge(t.spark):
        done = run(t, lambda s: ST.session_counts(s, "ts", ["user_id"], "6 hours", "0 seconds"), timed(t))
    return done.withColumn("session_start", ntz("session_start")).withColumn("session_end", ntz("session_end"))


@query("st8_stream_static_join", "cust", "SELECT e.event_id, e.event_type, c.state, c.city FROM events e JOIN cust c ON c.customer_id = e.user_id")
def stream_static_join(t: Tables):
    users = t.customers.select(F.col("customer_id").alias("user_id"), "state", "city")
    return run(t, lambda s: ST.enrich_stream(s, users, "user_id"), timed(t)).select("event_id", "event_type", "state", "city")
