"""Row placement: partitioning, order inside partitions, skew measures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Rows of a key in one partition, sorted inside each partition."""
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows per partition of the frame as it is placed."""
    return df.groupBy(F.spark_partition_id().alias("part_no")).agg(F.count(F.lit(1)).alias("rows_count"))


def hash_parts(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows per part if Spark placed `df` by `keys` in `n` parts (its own hash), empty parts included.

    Works on key counts, so nothing is moved to find out.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = counts.groupBy(F.pmod(F.hash(*keys), F.lit(n)).cast("long").alias("part_no")).agg(F.sum("_n").alias("rows_count"))
    return df.sparkSession.range(n).withColumnRenamed("id", "part_no").join(parts, "part_no", "left").na.fill({"rows_count": 0})


def skew(parts: DataFrame, rows: str = "rows_count") -> DataFrame:
    """Parts, empty parts, largest part over the average, and the coefficient of variation in percent."""
    average = F.avg(rows)
    return parts.agg(
        F.count(F.lit(1)).alias("parts"), F.count_if(F.col(rows) == 0).alias("empty_parts"),
        F.max(rows).alias("max_rows"), (F.max(rows) / F.nullif(average, F.lit(0.0))).alias("max_over_avg"),
        (F.lit(100) * F.stddev_pop(rows) / F.nullif(average, F.lit(0.0))).alias("skew_pct"))


def compare_keys(df: DataFrame, candidates: Sequence[Sequence[str]], n: int, limit: float = 1.5) -> DataFrame:
    """Per candidate key: distinct values, share of the rows that the hottest one holds, verdict for `n` parts.

    A key is skewed when its hottest value alone is more than `limit` times an even part.
    """
    def one(keys: Sequence[str]) -> DataFrame:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        total = counts.agg(F.count(F.lit(1)).alias("distinct_keys"), (F.max("_n") / F.sum("_n")).alias("hottest_share"))
        verdict = F.when(F.col("distinct_keys") < n, "too few values").when(F.col("hottest_share") * n > limit, "skewed").otherwise("even")
        return total.select(F.lit(",".join(keys)).alias("candidate"), "distinct_keys", "hottest_share", verdict.alias("verdict"))
    return reduce(lambda a, b: a.unionByName(b), [one(c) for c in candidates])
