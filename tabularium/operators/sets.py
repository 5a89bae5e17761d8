"""Set operations and frame comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_compare(a: DataFrame, b: DataFrame, a_label: str, b_label: str) -> DataFrame:
    """Distinct rows of both sides with the side they come from: both, only a, only b."""
    cols = a.columns
    sides = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    seen = sides.groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    label = F.when((F.col("_a") + F.col("_b")) == 2, "both").when(F.col("_a") == 1, a_label).otherwise(b_label)
    return seen.withColumn("set_name", label).drop("_a", "_b")


def frame_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose copies differ in number between two frames; empty when the frames are equal.

    Copies are counted on both sides in one aggregation, so a row that repeats very often
    is folded before the shuffle.
    """
    cols = a.columns
    sides = a.select(*cols, F.lit(1).alias("_n")).unionByName(b.select(*cols, F.lit(-1).alias("_n")))
    return sides.groupBy(*cols).agg(F.sum("_n").alias("copies")).filter("copies <> 0")
