"""Window results; groups that may be large go through tabularium.operators.ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.timeops import month_number
from tabularium.operators import ordered
from tabularium.operators.grouping import topn_per_group, with_group_agg


def ranks(df: DataFrame, value: str, tie: Sequence[str], descending: bool = True) -> DataFrame:
    """row_number, rank and dense_rank of `value` over the whole table."""
    side = F.col(value).desc() if descending else F.col(value).asc()
    rows = ordered.numbered(df, [], [side, *[F.col(c).asc() for c in tie]], "row_num")
    table = ordered.value_ranks(df, value, descending).select(
        F.col(value).alias("_v"), F.col("value_rank").alias("rank_no"), F.col("value_dense_rank").alias("dense_rank_no"))
    return rows.join(table, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")


def both_numbers(df: DataFrame, value: str, tie: str, up: str, down: str) -> DataFrame:
    """Row numbers by rising and by falling `value`, ties by rising `tie` in both, from one placement of the rows.

    With n equal values of which the row is number i, up + down = rows + 1 - n + 2 i - 1.
    """
    placed = ordered.sliced(df, [value], [F.col(tie).asc()])
    rows = ordered.scan_slices(_keep_place(placed, [value], ordered.row_number("_i")), [], ordered.row_number(up))
    rows = with_group_agg(rows, [value], {"_n": F.count(F.lit(1))})
    total = df.agg(F.count(F.lit(1))).scalar()
    return rows.withColumn(down, total - F.col(up) - F.col("_n") + 2 * F.col("_i")).drop("_i", "_n")


def ntile(number: Column, total: Column, tiles: int) -> Column:
    """Tile of a 1-based row number: the first `total % tiles` tiles hold one row more."""
    size = F.floor(total / F.lit(tiles))
    larger = total - size * tiles
    in_larger = larger * (size + 1)
    return F.when(number <= in_larger, F.ceil(number / (size + 1))).otherwise(
        larger + F.ceil((number - in_larger) / F.when(size > 0, size)))


def sessions(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], gap: Column,
             max_group: int = ordered.MAX_GROUP_ROWS) -> DataFrame:
    """`previous`, `new_session` (0/1) and `session_no` per key; a session ends when the gap is exceeded."""
    order = [F.col(ts).asc(), *[F.col(c).asc() for c in tie]]
    before = ordered.lag("previous", F.col(ts))
    number = ordered.running_sum("session_no", F.col("new_session"))
    starts = F.when(F.col("previous").isNull() | (F.col(ts) > F.col("previous") + gap), 1).otherwise(0)

    def in_groups(rows: DataFrame) -> DataFrame:
        marked = ordered.scan_groups(rows, keys, order, before).withColumn("new_session", starts)
        return ordered.scan_groups(marked, keys, order, number)

    def in_slices(rows: DataFrame) -> DataFrame:
        marked = _keep_place(ordered.sliced(rows, keys, order), keys, before).withColumn("new_session", starts)
        return ordered.scan_slices(marked, keys, number)

    return ordered.by_group_size(df, keys, max_group, in_groups, in_slices)


def _keep_place(placed: DataFrame, keys: Sequence[str], *scans: ordered.Scan) -> DataFrame:
    """Scan columns added to placed rows that keep their place for a further scan."""
    kept = placed.withColumn("_s0", F.col(ordered.SLICE)).withColumn("_p0", F.col(ordered.POSITION))
    return (ordered.scan_slices(kept, keys, *scans)
            .withColumnRenamed("_s0", ordered.SLICE).withColumnRenamed("_p0", ordered.POSITION))


def repeat_within(df: DataFrame, key: str, ts: str, span: Column) -> DataFrame:
    """Per key: is there a row after the first one and no later than `span` after it."""
    # only the first two moments of a key decide
    two = topn_per_group(df.select(key, ts).distinct(), [key], [F.col(ts).asc()], 2)
    return two.groupBy(key).agg(((F.max(ts) > F.min(ts)) & (F.max(ts) <= F.min(ts) + span)).alias("repeated"))


def cohort(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Each row with its month, the first month of its key and the months between."""
    rows = with_group_agg(df, [key], {"_first": F.min(ts)})
    return (rows.withColumn("order_month", F.trunc(ts, "month")).withColumn("cohort_month", F.trunc("_first", "month"))
            .withColumn("month_number", month_number(F.col("order_month"), F.col("cohort_month"))).drop("_first"))


def retention(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Share of each cohort that is active in each later month; keys count once per month."""
    active = df.groupBy(key, F.trunc(ts, "month").alias("order_month")).agg(F.lit(1).alias("_one")).drop("_one")
    months = with_group_agg(active, [key], {"cohort_month": F.min("order_month")}).groupBy(
        "cohort_month", month_number(F.col("order_month"), F.col("cohort_month")).alias("month_number")
    ).agg(F.count(F.lit(1)).alias("customers_count"))
    # the cohort is its own month zero; from here on there is one row per pair of months
    size = F.max(F.when(F.col("month_number") == 0, F.col("customers_count"))).over(Window.partitionBy("cohort_month"))
    return months.withColumn("cohort_size", size)


def abc(df: DataFrame, value: str, tie: str, a: float = 0.8, b: float = 0.95) -> DataFrame:
    """Pareto classes by cumulative share of the total."""
    rows = ordered.scan(df, [], [F.col(value).desc(), F.col(tie).asc()], ordered.running_sum("_upto", F.col(value)))
    total = df.agg(F.sum(value).cast("double")).scalar()
    share = F.col("_upto").cast("double") / F.nullif(total, F.lit(0.0))
    label = F.when(F.col("cumulative_share") <= a, "A").when(F.col("cumulative_share") <= b, "B").otherwise("C")
    return rows.withColumn("cumulative_share", share).withColumn("abc_class", label).drop("_upto")
