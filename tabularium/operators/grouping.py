"""Grouped results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.operators import ordered

LIMITED_BEFORE_SHUFFLE = 1000  # greatest n for which Spark limits the groups of each task


def spread_salt(salts: int, *cols: str) -> Column:
    """A salt from the task a row is read in and its values.

    Copies of one row differ by task, different rows of one task by value, and a retried
    task gives every row the salt it had.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *cols), F.lit(salts)).cast("int")


def topn_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None,
                   limited: int = LIMITED_BEFORE_SHUFFLE) -> DataFrame:
    """The first `n` rows of each key.

    Spark limits each group before the shuffle as well, so a hot key sends n rows per task.
    Beyond `limited`, the greatest n for which it does so, rows are numbered across slices,
    with the same result.
    """
    name = rank or "_rank"
    if n > limited:
        rows = ordered.numbered(df, keys, order, name).filter(F.col(name) <= n)
        return rows if rank else rows.drop(name)
    rows = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= n)
    return rows if rank else rows.drop(name)


def agg_where(agg, value: Column, condition: Column) -> Column:
    """`agg(value) FILTER (WHERE condition)`."""
    return agg(F.when(condition, value))


def tuples_count(*cols: str) -> Column:
    """Distinct tuples; a tuple that holds NULL counts as well."""
    return F.countDistinct(F.struct(*cols))


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggs: Mapping[str, Column]) -> DataFrame:
    """Totals of several groupings in one pass; `<col>_total` is 1 where the column is rolled up."""
    cols = sorted({c for s in sets for c in s})
    rolled = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
    return rolled.agg(*[a.alias(n) for n, a in aggs.items()],
                      *[F.grouping(c).cast("long").alias(f"{c}_total") for c in cols])


def two_stage_agg(df: DataFrame, keys: Sequence[str], spread: Sequence[str], partial: Mapping[str, Column],
                  final: Mapping[str, Column], salts: int = 16) -> DataFrame:
    """Aggregate per (keys, salt), then per keys.

    Sums and counts need no salt in Spark, which folds rows before the shuffle; this is for
    aggregates whose partial state is large.
    """
    first = df.withColumn("_salt", spread_salt(salts, *spread)).groupBy(*keys, "_salt").agg(*[a.alias(n) for n, a in partial.items()])
    return first.groupBy(*keys).agg(*[a.alias(n) for n, a in final.items()])


def mode_by(df: DataFrame, keys: Sequence[str], value: Sequence[str]) -> DataFrame:
    """Most frequent value tuple per key; ties go to the smallest tuple."""
    counts = df.groupBy(*keys, *value).agg(F.count(F.lit(1)).alias("freq"))
    return topn_per_group(counts, keys, [F.col("freq").desc(), *[F.col(v).asc() for v in value]], 1)


def with_group_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Each row with aggregates of its group: folded first, then joined back.

    NULL keys are a group like any other. Unlike a window this does not bring a group
    together; adaptive execution splits a hot key of the join.
    """
    folded = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(*[a.alias(n) for n, a in aggs.items()])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return df.join(folded, same).drop(*[f"_g_{k}" for k in keys])


def collect_ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str,
                    chunk: int = 1000, max_group: int = ordered.MAX_GROUP_ROWS, distinct: bool = False) -> DataFrame:
    """Ordered arrays per key, cut in chunks: see `ordered.in_chunks`."""
    return ordered.in_chunks(df, keys, order, value, name, chunk, max_group, distinct)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Of several rows of a key the one that is greatest column by column."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    return df.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(
        *[F.col("_row")[c].alias(c) if c != key else F.col(key) for c in df.columns])
