"""Profiles, duplicates, rules, rejects and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions import timeops
from tabularium.functions.text import row_text
from tabularium.operators import ordered
from tabularium.operators.grouping import topn_per_group


@dataclass(frozen=True)
class Rule:
    """`violated` is true for a bad row; NULL counts as not violated."""

    name: str
    severity: str  # critical | warning
    violated: Column


def not_null(col: str) -> Column:
    return F.col(col).isNull()


def outside(col: str, low, high) -> Column:
    return ~F.col(col).between(low, high)


def not_in(col: str, domain: Sequence) -> Column:
    return ~F.col(col).isin(*domain)


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for all columns from one scan and one shuffle.

    `value` is the text and what orders it: numbers, times and booleans by size, texts by text. A row becomes one pair
    per column, and equal pairs are folded before the shuffle.
    """
    def pair(name: str) -> Column:
        kind, value = df.schema[name].dataType, F.col(name)
        number = F.lit(None).cast("decimal(38,10)")
        if isinstance(kind, (T.IntegralType, T.DecimalType)):
            number = value.cast("decimal(38,10)")
        elif isinstance(kind, T.BooleanType):
            number = value.cast("int").cast("decimal(38,10)")
        elif isinstance(kind, T.DateType):
            number = F.unix_date(value).cast("decimal(38,10)")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            number = F.unix_micros(value.cast("timestamp")).cast("decimal(38,10)")
        real = value.cast("double") if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else F.lit(None).cast("double")
        text = value.cast("string")
        return F.struct(F.lit(name).alias("column_name"), F.when(value.isNotNull(), F.struct(
            number.alias("number"), real.alias("real"), text.alias("text"))).alias("value"))

    return df.select(F.inline(F.array(*[pair(c) for c in cols]))).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: rows, nulls, distinct values, bounds, longest text, most frequent value.

    All columns are folded to value counts in one pass; the figures come from the counts.
    """
    value, text = F.col("value"), F.col("value.text")
    top = F.min_by(text, F.when(value.isNotNull(), F.struct(-F.col("n"), value)))
    return value_counts(df, cols).groupBy("column_name").agg(
        F.sum("n").alias("rows_count"), F.coalesce(F.sum(F.when(value.isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count(value).alias("distinct_values"), F.min(value)["text"].alias("lowest"), F.max(value)["text"].alias("highest"),
        F.max(F.length(text)).cast("long").alias("longest"), top.alias("top_value"),
        F.max(F.when(value.isNotNull(), F.col("n"))).alias("top_rows"))


def frequent_values(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """The `n` most frequent values of each column, ties to the smaller one; NULL counts as a value."""
    order = [F.col("n").desc(), F.col("value").asc_nulls_first()]
    best = topn_per_group(value_counts(df, cols), ["column_name"], order, n)
    return best.select("column_name", F.col("value.text").alias("value"), F.col("n").alias("rows_count"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (NULL included) with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_count")).filter("rows_count > 1")


def conflicts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with more than one distinct non-NULL value."""
    return df.groupBy(*keys).agg(F.countDistinct(value).alias("distinct_values")).filter("distinct_values > 1")


def dup_metrics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """total_rows, unique_keys, duplicate_rows, conflict_keys, duplicate_pct in one row."""
    per_value = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_value.groupBy(*keys).agg(F.sum("_n").alias("_rows"), F.count(value).alias("_values"))
    one = per_key.agg(F.sum("_rows").alias("total_rows"), F.count(F.lit(1)).alias("unique_keys"),
                      F.count_if(F.col("_values") > 1).alias("conflict_keys"))
    surplus = F.col("total_rows") - F.col("unique_keys")
    pct = F.round(F.lit(100.0) * surplus / F.nullif(F.col("total_rows"), F.lit(0)), 2)
    return one.withColumn("duplicate_rows", surplus).withColumn("duplicate_pct", pct)


def dedup_keep(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order; the order ends in a tie-breaker."""
    return topn_per_group(df, keys, order, 1)


def completeness(*cols: str) -> Column:
    """How many of the columns are filled; use descending to prefer complete rows."""
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])


def latest_alive(df: DataFrame, keys: Sequence[str], order: Sequence[Column], deleted: str) -> DataFrame:
    """Last version per key first, then without deleted keys."""
    return dedup_keep(df, keys, *order).filter(~F.col(deleted))


def versions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], row_id: str,
             max_group: int = ordered.MAX_GROUP_ROWS) -> DataFrame:
    """Each row with `version_no` in its group and the `canonical_id` all copies map to."""
    return ordered.scan(df, keys, order, ordered.row_number("version_no"),
                        ordered.first("canonical_id", F.col(row_id)), max_group=max_group)


def checksum(*cols: Column) -> Column:
    """Order-free checksum of rows: the sum of their hashes, exact at any row count."""
    return F.sum(F.xxhash64(*cols).cast("decimal(38,0)"))


def text_hash(*cols: Column) -> Column:
    """Both 64-bit halves of md5 over the row text, added: a hash that other engines can repeat.

    No two rows share a row text: a value or NULL that moves to another column, or a field boundary that moves, changes it.
    """
    digest = F.md5(row_text(*cols))
    halves = [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    return halves[0] + halves[1]


def text_checksum(*cols: Column) -> Column:
    """Order-free checksum of rows: the sum of their text hashes, exact at any row count."""
    return F.sum(text_hash(*cols).cast("decimal(38,0)"))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], sums: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """One row: counts, sums and checksums of both sides; keys missing, extra or differing in `b`; `equal` without any.

    Both sides are folded per key in one grouping and compared there: values that two keys exchange leave every total as
    it was. The rows of a key are compared as a set with repeats, by the sum of their hashes.
    """
    cols = list(dict.fromkeys([*keys, *sums, *texts]))
    both = a.select(*cols, F.lit("source").alias("_side")).unionByName(b.select(*cols, F.lit("target").alias("_side")))
    both = both.withColumn("_hash", text_hash(*[F.col(c) for c in texts]))

    def of(side: str, value: Column) -> Column:
        return F.sum(F.when(F.col("_side") == side, value))

    sides = ("source", "target")
    per_key = both.groupBy(*keys).agg(
        *[F.count_if(F.col("_side") == s).alias(f"{s}_rows") for s in sides],
        *[of(s, F.col(c)).alias(f"{s}_{c}") for s in sides for c in sums],
        *[of(s, F.col("_hash").cast("decimal(38,0)")).alias(f"{s}_checksum") for s in sides])
    figures = ["rows", "checksum", *sums]
    alike = reduce(lambda a, b: a & b, [F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}")) for c in figures])
    both_sides = (F.col("source_rows") > 0) & (F.col("target_rows") > 0)
    one = per_key.agg(
        *[F.coalesce(F.sum(f"{s}_rows"), F.lit(0)).alias(f"{s}_rows") for s in sides],
        *[F.sum(f"{s}_{c}").cast("double").alias(f"{s}_{c}") for s in sides for c in sums],
        *[F.sum(f"{s}_checksum").cast("string").alias(f"{s}_checksum") for s in sides],
        F.count_if(F.col("target_rows") == 0).alias("missing_keys"), F.count_if(F.col("source_rows") == 0).alias("extra_keys"),
        F.count_if(both_sides & ~alike).alias("differing_keys"))
    return one.withColumn("equal", (F.col("missing_keys") == 0) & (F.col("extra_keys") == 0) & (F.col("differing_keys") == 0))


def grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_count"), F.count(F.lit(1)).alias("unique_keys"))
    return one.withColumn("grain_is_unique", F.col("rows_count") == F.col("unique_keys"))


def check_schema(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Per contract column: present, and how many values do not cast to the contract type."""
    present = [f for f in contract.fields if f.name in df.columns]
    counts = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in present]
    found = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("expected_type"),
                      F.lit(True).alias("present"), F.col(f.name).alias("bad_values")) for f in present]
    absent = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("expected_type"),
                       F.lit(False).alias("present"), F.lit(None).cast("long").alias("bad_values"))
              for f in contract.fields if f.name not in df.columns]
    one = df.agg(*(counts or [F.count(F.lit(1)).alias("_rows")]))
    return one.select(F.inline(F.array(*found, *absent)))


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations per rule, all counted in one pass."""
    one = df.agg(*[F.count_if(r.violated).alias(r.name) for r in rules])
    rows = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(r.name).alias("violations"),
                     F.when(F.col(r.name) == 0, "PASS").otherwise("FAIL").alias("status")) for r in rules]
    return one.select(F.inline(F.array(*rows)))


def unique_rule(df: DataFrame, keys: Sequence[str], name: str, severity: str = "critical") -> DataFrame:
    """Rows beyond the first of each key, in the shape of `check_rules`."""
    g = grain(df, keys)
    bad = F.col("rows_count") - F.col("unique_keys")
    return _rule_row(g, name, severity, bad)


def reference_rule(df: DataFrame, ref: DataFrame, key: str, name: str, severity: str = "critical") -> DataFrame:
    """Rows whose key is not in `ref`, in the shape of `check_rules`."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    missing = counts.join(ref.select(key).distinct(), key, "left_anti")
    return _rule_row(missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_bad")), name, severity, F.col("_bad"))


def _rule_row(one: DataFrame, name: str, severity: str, bad: Column) -> DataFrame:
    return one.select(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), bad.cast("long").alias("violations"),
                      F.when(bad == 0, "PASS").otherwise("FAIL").alias("status"))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds `reasons`: the names of the rules a row breaks."""
    flags = [F.when(F.coalesce(r.violated, F.lit(False)), F.lit(r.name)) for r in rules]
    return df.withColumn("reasons", F.array_compact(F.array(*flags)))


def split_valid(df: DataFrame, rules: Sequence[Rule], key: str, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); a rejected row keeps its key, its raw payload, the reasons and the batch."""
    marked = with_reasons(df, rules)
    accepted = marked.filter(F.size("reasons") == 0).drop("reasons")
    payload = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    rejected = marked.filter(F.size("reasons") > 0).select(
        F.lit(batch_id).alias("batch_id"), F.col(key).cast("string").alias("business_key"), payload.alias("raw_payload"),
        F.array_join("reasons", ";").alias("reason"))
    return accepted, rejected


def freshness(df: DataFrame, ts: str, now: Column) -> DataFrame:
    return df.agg(F.max(ts).alias("last_at")).withColumn("age_days", timeops.calendar_days(now, F.col("last_at")))


def missing_days(df: DataFrame, day: str) -> DataFrame:
    """Calendar days between the first and last that have no row."""
    days = df.select(day).distinct()
    return timeops.calendar_of(days, day).join(days, day, "left_anti")


def quality_mart(df: DataFrame, group: Mapping[str, Column], rules: Sequence[Rule]) -> DataFrame:
    """Per group: rows, valid rows, and violations of each rule; rows = valid + rejected."""
    any_bad = reduce(lambda a, b: a | b, [F.coalesce(r.violated, F.lit(False)) for r in rules])
    return df.groupBy(*[c.alias(n) for n, c in group.items()]).agg(
        F.count(F.lit(1)).alias("rows_count"), F.count_if(~any_bad).alias("valid_rows"), F.count_if(any_bad).alias("rejected_rows"),
        *[F.count_if(r.violated).alias(r.name) for r in rules])


def gate(report: DataFrame) -> DataFrame:
    """Publish only when no critical rule is broken."""
    return report.agg(F.bool_and((F.col("severity") != "critical") | (F.col("violations") == 0)).alias("publish"),
                      F.sum("violations").alias("violations"))
