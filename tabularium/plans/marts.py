"""Dimensions, facts and marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabularium.operators import ordered
from tabularium.operators.grouping import topn_per_group, with_group_agg
from tabularium.operators.joins import asof_join
from tabularium.operators.quality import dedup_keep, text_checksum
from tabularium.session import written
from tabularium.sources import storage

UNKNOWN = "__UNKNOWN__"


def build_dim(df: DataFrame, key: str, attrs: Sequence[str], sk: str, *order: Column) -> DataFrame:
    """One row per business key, numbered in key order: the same keys get the same numbers on every run."""
    rows = dedup_keep(df.select(key, *attrs), [key], *order) if order else df.select(key, *attrs)
    return ordered.numbered(rows, [], [F.col(key).asc()], sk)


def hashed_dim(df: DataFrame, key: str, attrs: Sequence[str], sk: str) -> DataFrame:
    """As `build_dim` with a key that needs no order and no shuffle: a 64-bit hash of the business key."""
    return df.select(F.xxhash64(key).alias(sk), key, *attrs)


def with_unknown(dim: DataFrame, key: str, sk: str, attrs: Mapping[str, object]) -> DataFrame:
    """The dimension with a member for facts whose key is not known, numbered -1."""
    values = {key: F.lit(UNKNOWN), sk: F.lit(-1), **{a: F.lit(v) for a, v in attrs.items()}}
    one = dim.sparkSession.range(1)
    return dim.unionByName(one.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in dim.schema.fields]))


def lookup_or_unknown(fact: DataFrame, dim: DataFrame, key: str, sk: str) -> DataFrame:
    return fact.join(dim.select(key, sk), key, "left").withColumn(sk, F.coalesce(sk, F.lit(-1)))


def resolve_late(dim: DataFrame, src: DataFrame, key: str, attrs: Sequence[str], stub: str) -> DataFrame:
    """Attributes of stub members (marked by `dim[stub]`) filled from the source once it has them."""
    found = src.select(key, *[F.col(a).alias(f"_n_{a}") for a in attrs], F.lit(True).alias("_found"))
    hit = F.col(stub) & F.coalesce("_found", F.lit(False))
    joined = dim.join(found, key, "left").withColumn("_hit", hit)
    new = {a: F.when(F.col("_hit"), F.col(f"_n_{a}")).otherwise(F.col(a)) for a in attrs}
    return joined.withColumns({**new, stub: F.col(stub) & ~F.col("_hit")}).select(dim.columns)


def dim_date(days: DataFrame, day: str) -> DataFrame:
    d = F.col(day)
    parts = {"year_num": F.year(d), "quarter_num": F.quarter(d), "month_num": F.month(d), "day_num": F.dayofmonth(d)}
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("long").alias("date_sk"), d.alias("calendar_date"),
        *[c.cast("long").alias(n) for n, c in parts.items()], (F.weekday(d) >= 5).alias("is_weekend"))


def build_fact(rows: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], keep: Sequence[str]) -> DataFrame:
    """Rows with the surrogate keys of (dimension, business key, surrogate key); a missing member drops the row."""
    out = reduce(lambda f, d: f.join(d[0].select(d[1], d[2]), d[1]), dims, rows)
    return out.select(*keep, *[d[2] for d in dims])


def bridge_weights(items: DataFrame, key: str, member: str) -> DataFrame:
    """Share of each member in its key, by rows; shares of a key add up to one."""
    counts = items.groupBy(key, member).agg(F.count(F.lit(1)).alias("_n"))
    return with_group_agg(counts, [key], {"_all": F.sum("_n")}).select(
        key, member, (F.col("_n").cast("double") / F.col("_all")).alias("weight"))


# ---- slowly changing dimensions --------------------------------------------------------

def scd1(dim: DataFrame, src: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Attributes overwritten by the source; keys that only one side has stay or are added."""
    a = dim.select(F.col(key).alias("_k"), F.struct(key, *attrs).alias("_old"))
    b = src.select(F.col(key).alias("_k"), F.struct(key, *attrs).alias("_new"))
    return a.join(b, "_k", "full").select(F.coalesce("_new", "_old").alias("_r")).select("_r.*")


def scd2(dim: DataFrame, src: DataFrame, key: str, attrs: Sequence[str], at: Column) -> DataFrame:
    """Close current versions whose attributes changed and open new ones; periods are [from, to).

    dim(key, attrs, valid_from, valid_to, is_current); src has one row per key. A key the
    source lacks keeps its current version; running twice changes nothing. A change dated no
    later than the start of the current version is not applied, so that no period ends before
    it begins; `scd2_history` places such changes from a log.
    """
    ts = dim.schema["valid_from"].dataType
    past = dim.filter(~F.col("is_current"))
    now = dim.filter("is_current").select(F.col(key).alias("_k"), F.struct(*attrs).alias("_old"), F.col("valid_from").alias("_from"))
    new = src.select(F.col(key).alias("_k"), F.struct(*attrs).alias("_new"))
    both = now.join(new, "_k", "full")
    same = reduce(lambda x, y: x & y, [F.col("_old")[a].eqNullSafe(F.col("_new")[a]) for a in attrs])
    changed = F.col("_old").isNotNull() & F.col("_new").isNotNull() & ~same & F.coalesce(at > F.col("_from"), F.lit(False))
    never = F.lit(None).cast(ts)

    def version(of: str, start: Column, end: Column, current: bool) -> Column:
        return F.struct(F.col("_k").alias(key), *[F.col(of)[a].alias(a) for a in attrs], start.cast(ts).alias("valid_from"),
                        end.cast(ts).alias("valid_to"), F.lit(current).alias("is_current"))

    opened = version("_new", at, never, True)
    rows = (F.when(changed, F.array(version("_old", F.col("_from"), at, False), opened))
            .when(F.col("_old").isNull(), F.array(opened))
            .otherwise(F.array(version("_old", F.col("_from"), never, True))))
    return past.select(key, *attrs, "valid_from", "valid_to", "is_current").unionByName(both.select(F.inline(rows)))


def scd2_history(changes: DataFrame, key: str, attrs: Sequence[str], at: str, tie: Sequence[str],
                 max_group: int = ordered.MAX_GROUP_ROWS) -> DataFrame:
    """Versions from a log of changes: repeats of the same attributes are folded, then each ends where the next starts."""
    order = [F.col(at).asc(), *[F.col(c).asc() for c in tie]]
    state = F.struct(*attrs)
    before, after = ordered.lag("_before", state), ordered.lead("valid_to", F.col(at))
    starts = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)

    def in_groups(rows: DataFrame) -> DataFrame:
        return ordered.scan_groups(ordered.scan_groups(rows, [key], order, before).filter(starts), [key], order, after)

    def in_slices(rows: DataFrame) -> DataFrame:
        kept = ordered.scan_slices(ordered.sliced(rows, [key], order), [key], before).filter(starts)
        return ordered.scan_slices(ordered.sliced(kept, [key], order), [key], after)

    spans = ordered.by_group_size(changes, [key], max_group, in_groups, in_slices)
    return spans.select(key, *attrs, F.col(at).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))


def scd2_late(dim: DataFrame, seen: DataFrame, arrived: DataFrame, key: str, attrs: Sequence[str], at: str, tie: Sequence[str],
              max_group: int = ordered.MAX_GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(versions, log) after changes that may be dated before versions already there.

    `seen` is the log of all changes so far, each kept although its attributes repeat the version before: a late change
    that falls between two equal ones splits their version, and the second of them starts a version again. Only the
    histories of keys that arrived are built anew, from their part of the log; other keys keep their versions. In any
    order of arrival the result is `scd2_history` of the whole log, and rows that arrive again change nothing.
    """
    columns = list(dict.fromkeys([key, *attrs, at, *tie]))
    keys = arrived.select(F.col(key).alias("_k")).distinct()
    touched = F.col(key).eqNullSafe(F.col("_k"))
    fresh = arrived.select(*columns).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in columns])
    known = seen.join(keys, touched, "left_semi").select(*[F.col(c).alias(f"_s_{c}") for c in columns])
    log = written(seen.select(*columns).unionByName(fresh.join(known, same, "left_anti")), "change-log")
    built = scd2_history(log.join(keys, touched, "left_semi"), key, attrs, at, tie, max_group)
    return dim.join(keys, touched, "left_anti").select(built.columns).unionByName(built), log


# ---- summaries -------------------------------------------------------------------------

def customer_segments(customers: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """VIP = greatest lifetime value, loyal = more than one order, else regular; unknown without orders."""
    top = summary.agg(F.max("lifetime_value")).scalar()
    segment = (F.when(F.col("orders_count").isNull(), "unknown").when(F.col("lifetime_value") >= top, "VIP")
               .when(F.col("orders_count") > 1, "loyal").otherwise("regular"))
    return customers.select(key).join(summary, key, "left").select(
        key, F.coalesce("orders_count", F.lit(0)).alias("orders_count"),
        F.coalesce(F.col("lifetime_value").cast("double"), F.lit(0.0)).alias("lifetime_value"), segment.alias("segment"))


def normalised(rows: DataFrame, rates: DataFrame, price: str, currency: str, at: str, starts: str, base: str, tie: Sequence[str]) -> DataFrame:
    """Rows with `<price>_normalised`: the price times the rate of its currency that holds at `at`, at two digits.

    rates(currency, starts, rate): a rate holds until the next one of its currency. Prices in `base` stay; without a
    currency or a rate the result is NULL, so that no price is taken for another currency's.
    """
    valued = asof_join(rows, rates, currency, at, starts, None, ["rate"], tie, "left")
    rate = F.when(F.col(currency) == base, F.lit(1).cast("decimal(9,4)")).otherwise(F.col("rate"))
    return valued.withColumn(f"{price}_normalised", F.round(F.col(price) * rate, 2)).drop("rate")


def top_deal(trades: DataFrame) -> DataFrame:
    """The whole trade of greatest value per ticker, day and side; ties go to the earliest, then by ids."""
    order = [F.col("value").desc(), *[F.col(c).asc() for c in ("shipped_at", "order_id", "item_id", "product_id", "seller_id")]]
    return topn_per_group(trades, ["secid", "day", "side"], order, 1)


def daily_bars(trades: DataFrame) -> DataFrame:
    """Trades, quantity, value and open / high / low / close per ticker and day."""
    at = F.struct("shipped_at", "order_id", "item_id", "product_id", "seller_id", "value")
    return trades.groupBy("secid", "day").agg(
        F.count(F.lit(1)).alias("trades"), F.sum("quantity").alias("quantity"), F.sum("value").alias("value"),
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"))


def with_changes(bars: DataFrame) -> DataFrame:
    """Bars with the close of the previous active day, the change, and the rank by value within the day.

    The windows run over folded rows: a ticker has one row per day, a day one per ticker.
    """
    before = F.lag("close").over(Window.partitionBy("secid").orderBy("day"))
    rank = F.dense_rank().over(Window.partitionBy("day").orderBy(F.col("value").desc())).cast("long")
    change = F.col("close") - F.col("previous_close")
    pct = F.lit(100) * F.col("abs_change").cast("double") / F.nullif(F.col("previous_close").cast("double"), F.lit(0.0))
    return (bars.withColumn("liquidity_rank", rank).withColumn("previous_close", before)
            .withColumn("abs_change", change).withColumn("change_pct", pct))


def snapshot_quality(trades: DataFrame) -> DataFrame:
    """Per day: rows of the snapshot = active rows + rows without trades; tickers; rows to reject."""
    active = F.coalesce(F.col("quantity") > 0, F.lit(False))
    return trades.groupBy("day").agg(
        F.count(F.lit(1)).alias("snapshot_rows"), F.count_if(active).alias("active_rows"), F.count_if(~active).alias("zero_trade_rows"),
        F.countDistinct("secid").alias("instruments"), F.count_if(F.col("value").isNull() | (F.col("value") <= 0)).alias("rejected_rows"))


def reconcile_marts(trades: DataFrame, daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """One row: value and trades must be the same in the fact, the days and the months, and no group may be absent."""
    def folded(df: DataFrame, month: Column, level: str, n: Column) -> DataFrame:
        return df.groupBy("secid", month.alias("month")).agg(F.sum("value").alias("value"), n.alias("trades")).select(
            "*", F.lit(level).alias("level"))

    levels = ("fact", "daily", "monthly")
    rows = (folded(trades, F.trunc("day", "month"), "fact", F.count(F.lit(1)))
            .unionByName(folded(daily, F.trunc("day", "month"), "daily", F.sum("trades")))
            .unionByName(folded(monthly, F.col("month"), "monthly", F.sum("trades"))))
    per_group = rows.groupBy("secid", "month").agg(
        F.count(F.lit(1)).alias("_levels"), *[F.sum(F.when(F.col("level") == x, F.col(c))).alias(f"{x}_{c}") for x in levels for c in ("value", "trades")])
    one = per_group.agg(*[F.sum(f"{x}_value").cast("double").alias(f"{x}_value") for x in levels], *[F.sum(f"{x}_trades").alias(f"{x}_trades") for x in levels],
                        F.count_if(F.col("_levels") < 3).alias("missing_groups"))
    return one.withColumn("reconciled", (F.col("missing_groups") == 0) & (F.col("fact_value") == F.col("daily_value")) & (F.col("daily_value") == F.col("monthly_value"))
                          & (F.col("fact_trades") == F.col("daily_trades")) & (F.col("daily_trades") == F.col("monthly_trades")))


def monthly_bars(bars: DataFrame) -> DataFrame:
    """Months added up from days: sums and trading days, no averaged percents."""
    return bars.groupBy("secid", F.trunc("day", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("trading_days"), F.sum("trades").alias("trades"), F.sum("quantity").alias("quantity"), F.sum("value").alias("value"))


def seasonality(bars: DataFrame) -> DataFrame:
    return bars.groupBy("secid", F.month("day").cast("long").alias("month_num")).agg(
        F.count(F.lit(1)).alias("active_days"), F.sum("trades").alias("trades"), F.sum("value").alias("value"))


def store_bars(trades: DataFrame, days_path: str, months_path: str) -> None:
    """Daily and monthly bars as stored marts, one directory per month; `trades` has the month as a text, `month`."""
    days = written(daily_bars(trades).withColumn("month", month_text()), "bars")
    storage.write_partitioned(days, days_path, ["month"])
    storage.write_partitioned(stored_months(days), months_path, ["month"])


def month_text() -> Column:
    return F.date_format("day", "yyyy-MM")


def stored_months(days: DataFrame) -> DataFrame:
    return monthly_bars(days.drop("month")).withColumn("month", F.date_format("month", "yyyy-MM"))


def refresh_bars(facts: DataFrame, days: DataFrame, change: DataFrame) -> tuple[DataFrame, list[str]]:
    """Daily bars of the months that a change touches, and those months.

    Bars of touched days are built from the facts, other days of these months come from the stored mart: both reads
    are limited to the months' directories. `change` holds the rows that came, went or changed; its days are collected,
    of which there are as many as the calendar has.
    """
    touched = change.select("month", "day").distinct().collect()
    months, dates = sorted({r.month for r in touched}), sorted({r.day for r in touched})
    in_months, in_days = F.col("month").isin(months), F.col("day").isin(dates)
    fresh = daily_bars(facts.filter(in_months & in_days)).withColumn("month", month_text())
    return days.filter(in_months & ~in_days).unionByName(fresh.select(days.columns)), months


def refresh_stored_bars(spark: SparkSession, facts_path: str, days_path: str, months_path: str, change: DataFrame) -> list[str]:
    """Bring stored daily and monthly bars up to a change of the facts; returns the months whose directories were replaced.

    The cost follows from the touched months, not from the history. A month without trades loses its directory. Running
    again with the same change gives the same marts, so a run that died between the marts is run again.
    """
    facts, days = (storage.read_partitioned(spark, p) for p in (facts_path, days_path))
    fresh, months = refresh_bars(facts, days, change)
    fresh = written(fresh, "fresh-bars")  # the mart is read before its directories are replaced
    if not months:
        return []
    left = {r.month for r in fresh.select("month").distinct().collect()}  # at most the touched months
    storage.overwrite_partitions(fresh, days_path, ["month"])
    storage.overwrite_partitions(stored_months(fresh), months_path, ["month"])
    for path in (days_path, months_path):
        storage.remove_partitions(spark, path, "month", [m for m in months if m not in left])
    return months


def catalog_entry(mart: DataFrame, name: str, version: int, status: str, keys: Sequence[str], texts: Sequence[str]) -> DataFrame:
    counted = mart.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), text_checksum(*[F.col(c) for c in texts]).alias("_c"))
    return counted.agg(F.sum("_n").alias("row_count"), F.count(F.lit(1)).alias("key_count"), F.sum("_c").cast("string").alias("checksum")).select(
        F.lit(name).alias("mart"), F.lit(",".join(keys)).alias("grain"), F.lit(version).cast("long").alias("version"), F.lit(status).alias("status"), "*")


def latest_published(catalog: DataFrame) -> DataFrame:
    """READY versions with one row per key are published; per mart the newest published one is served."""
    ok = (F.col("status") == "READY") & (F.col("row_count") == F.col("key_count"))
    marked = catalog.withColumn("status", F.when(ok, "PUBLISHED").otherwise(F.col("status")))
    newest = topn_per_group(marked.filter("status = 'PUBLISHED'"), ["mart"], [F.col("version").desc()], 1)
    return marked.join(newest.select("mart", F.col("version").alias("_v")), "mart", "left").withColumn(
        "served", F.coalesce(F.col("version") == F.col("_v"), F.lit(False))).drop("_v")


def entitled(df: DataFrame, user_map: DataFrame, user: str, on: str, columns: Mapping[str, Column]) -> DataFrame:
    """Rows whose `on` value the user may see, as the given safe columns only."""
    mine = user_map.filter(F.col("user_name") == user).select(on)
    return df.join(mine, on, "left_semi").select(*[c.alias(n) for n, c in columns.items()])


def seller_ranks(items: DataFrame) -> DataFrame:
    """Sellers by revenue; equal revenue shares a rank."""
    revenue = items.groupBy("seller_id").agg(F.sum("price").alias("seller_revenue"))
    ranks = ordered.value_ranks(revenue, "seller_revenue", descending=True)
    ranks = ranks.select(F.col("seller_revenue").alias("_r"), F.col("value_dense_rank").alias("seller_rank"))
    return revenue.join(ranks, F.col("seller_revenue").eqNullSafe(F.col("_r"))).drop("_r")  # sellers without revenue rank last
