"""Row-wise choices: ranges, labels, optional filters, reproducible splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def between_half_open(col: Column, low, high) -> Column:
    """`low <= col < high` on the bare column, so that files and partitions can be skipped."""
    return (col >= low) & (col < high)


def bucketize(col: Column, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first bound that is greater than the value."""
    first, *rest = bounds
    label = F.when(col < first[0], first[1])
    for bound, name in rest:
        label = label.when(col < bound, name)
    return label.otherwise(otherwise)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema`, cast from text; a value that does not fit becomes NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def search(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Equality per given key, membership for a list; an absent or None key does not filter."""
    tests = []
    for name, wanted in filters.items():
        if wanted is None:
            continue
        many = isinstance(wanted, (list, tuple, set))
        tests.append(F.col(name).isin(*wanted) if many else F.col(name) == wanted)
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def hash_share(*cols: str) -> Column:
    """A number in [0, 1) fixed by the key text: the same rows fall in the same part on every run."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def sample_by_key(df: DataFrame, cols: Sequence[str], fraction: float) -> DataFrame:
    return df.filter(hash_share(*cols) < fraction)


def split_by_key(df: DataFrame, cols: Sequence[str], weights: Mapping[str, float]) -> DataFrame:
    """Adds `part`: disjoint parts that together hold every row."""
    total = sum(weights.values())
    share, label, names = 0.0, None, list(weights)
    point = hash_share(*cols)
    for name in names[:-1]:
        share += weights[name] / total
        label = F.when(point < share, name) if label is None else label.when(point < share, name)
    return df.withColumn("part", F.lit(names[-1]) if label is None else label.otherwise(names[-1]))


def row_count(spark: SparkSession, name: str, allowed: Mapping[str, str]) -> DataFrame:
    """Rows of a table named by parameter; only the names of `allowed` (name -> path) are accepted."""
    if name not in allowed:
        raise ValueError(f"table {name} is not allowed")
    return spark.read.parquet(allowed[name]).agg(F.count(F.lit(1)).alias("rows_count")).select(
        F.lit(name).alias("table_name"), "rows_count"
    )
