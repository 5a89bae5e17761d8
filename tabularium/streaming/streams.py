"""Structured Streaming on file sources: drained with `availableNow`, offsets kept in a checkpoint.

Event times are TIMESTAMP: watermarks do not take TIMESTAMP_NTZ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions import text

# Actions a site event may have
SITE_ACTIONS = ("login", "logout", "view", "click", "purchase")
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def source(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(form)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append all that is available to a Parquet directory, stop, and return what it holds.

    A further call with the same checkpoint goes on where this one ended.
    """
    run = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    run.start(path).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain_batches(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    run = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    run.start().awaitTermination()


def clean_events(events: DataFrame) -> DataFrame:
    """Site events, all columns text, to typed rows; `is_valid` is false for a row to reject.

    Works on a batch or a stream. Names have 1 to 99 characters, an age outside 1..100 is 0.
    """
    squeezed = text.collapse_spaces(F.coalesce("user_name", F.lit("")))
    email = F.lower(F.trim(F.coalesce("email", F.lit(""))))
    age = F.trim("age").try_cast("int")
    action = F.lower(F.trim(F.coalesce("site_action", F.lit(""))))
    day = F.trim(F.coalesce("event_date", F.lit("")))
    typed = events.select(
        F.trim("id").try_cast("bigint").alias("id"), text.title_words(squeezed).alias("user_name"), email.alias("email"),
        F.coalesce(F.when(age.between(1, 100), age), F.lit(0)).alias("age"), action.alias("site_action"),
        F.when(day.rlike(ISO_TIME), day.try_cast("timestamp_ntz")).alias("event_date"), F.length(squeezed).alias("_name_length"))
    valid = (F.col("id").isNotNull() & F.col("_name_length").between(1, 99) & F.col("email").rlike(text.EMAIL_SHAPE)
             & F.col("site_action").isin(*SITE_ACTIONS) & F.col("event_date").isNotNull())
    return typed.withColumn("is_valid", valid).drop("_name_length")


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, key: str, order: Sequence[str]) -> DataFrame:
    """Append the first batch's smallest row of every key, in `order`; later rows of a key add nothing.

    The stream's keyed state, kept in its checkpoint, knows which keys were there before a batch, so a batch reads nothing
    of the target however large that is. Each batch has a directory of its own that a repeated batch replaces. A target
    that other checkpoints wrote (after a lost one, say) is met by its keys as they are at that time, which do not grow.
    One stream writes at a time. State holds one row per key; for many keys use the RocksDB state store.
    """
    spark, schema = stream.sparkSession, stream.schema
    run = "c" + hashlib.md5(checkpoint.encode()).hexdigest()[:16]
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/run={run}/batch=none")  # the target exists from the start
    others = spark.read.schema(schema).parquet(path).filter(F.col("run") != run).select(F.col(key).alias("_known"))
    has_others = others.limit(1).count() > 0

    best = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*schema.names).alias("_row")))
    timed = stream.withColumn("_moment", F.current_timestamp())  # one per batch, also when it is repeated
    seen = timed.groupBy(F.col(key).alias("_key")).agg(best.alias("_best"), F.min("_moment").alias("_first"), F.max("_moment").alias("_last"))

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.filter(F.col("_first") == F.col("_last")).select("_best._row.*")
        if has_others:
            rows = rows.join(others, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
        rows.select(schema.names).write.mode("overwrite").parquet(f"{path}/run={run}/batch={number}")

    drain_batches(seen, checkpoint, write, mode="update")
    return spark.read.schema(schema).parquet(path).select(schema.names)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key; copies are told apart while they are within the delay of each other."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def window_counts(stream: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str | None, delay: str) -> DataFrame:
    """Rows per window and key; a row later than the delay is dropped, a window is given out once it is closed."""
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    counts = stream.withWatermark(ts, delay).groupBy(span.alias("w"), *keys).agg(F.count(F.lit(1)).alias("events_count"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "events_count")


def session_counts(stream: DataFrame, ts: str, keys: Sequence[str], gap: str, delay: str) -> DataFrame:
    """Sessions per key; an event exactly one gap later belongs to the same session."""
    counts = stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("events_count"))
    return counts.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events_count")


@contextmanager
def local_session_merge(spark: SparkSession):
    """Merge sessions before the shuffle as well, so that a hot key sends few rows."""
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def enrich_stream(stream: DataFrame, static: DataFrame, key: str, how: str = "inner") -> DataFrame:
    return stream.join(static, key, how)
