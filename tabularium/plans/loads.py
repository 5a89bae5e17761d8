"""Batch loads: as frames (a changed table is a new frame) and into stored tables, of which only some files change.

Frames that stand for a keyed target have one row per key, so joins on the key do not multiply.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.text import row_hash
from tabularium.operators import quality as Q
from tabularium.operators.grouping import one_per_key
from tabularium.operators.projection import between_half_open
from tabularium.session import scratch_path, written
from tabularium.sources.stored import StoredTable


def land(df: DataFrame, batch_id: str, source: str, hashed: Sequence[str], load_time: bool = False) -> DataFrame:
    """Source values unchanged, with batch, source name and row hash beside them."""
    out = df.withColumn("batch_id", F.lit(batch_id)).withColumn("source_name", F.lit(source))
    out = out.withColumn("source_hash", row_hash(*[F.col(c) for c in hashed]))
    return out.withColumn("load_dttm", F.current_timestamp()) if load_time else out


def insert_new(target: DataFrame, src: DataFrame, key: str) -> DataFrame:
    """Target plus the source keys it lacks, each once; a rerun adds nothing. NULL is a key like any other."""
    return target.unionByName(missing_rows(target, src, key))


def missing_rows(target: DataFrame, src: DataFrame, key: str) -> DataFrame:
    """The rows to append: one per source key that the target lacks."""
    known = target.select(F.col(key).alias("_k")).distinct()
    new = one_per_key(src.select(target.columns), key)
    return new.join(known, F.col(key).eqNullSafe(F.col("_k")), "left_anti")


def append(spark: SparkSession, path: str, new: DataFrame) -> int:
    """Add rows to a Parquet table without touching its files; returns how many."""
    seen = Observation()
    new.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def append_new(spark: SparkSession, path: str, src: DataFrame, key: str) -> int:
    """Append the source keys a stored table lacks: of the target, only the key column is read and nothing is rewritten."""
    target = spark.read.schema(src.schema).parquet(path)
    return append(spark, path, written(missing_rows(target, src, key), "new-rows"))


def append_missing(table: StoredTable, src: DataFrame, key: str) -> int:
    """As `append_new`, published as one version: a run that dies half way adds nothing."""
    return table.append(missing_rows(table.read(), src, key), note="insert new")


def merge(target: DataFrame, src: DataFrame, key: str, compare: Sequence[str], note: str | None = None) -> DataFrame:
    """Upsert: changed keys take the source row, equal ones stay, new ones are added.

    A NULL key matches a NULL key. Of several source rows of a key one counts. With `note`, a column of
    that name says inserted, updated or kept.
    """
    cols = target.columns
    old = target.select(F.col(key).alias("_k"), F.struct(*cols).alias("_old"))
    new = one_per_key(src.select(cols), key).select(F.col(key).alias("_n"), F.struct(*cols).alias("_new"))
    both = old.join(new, F.col("_k").eqNullSafe(F.col("_n")), "full")
    changed = reduce(lambda a, b: a | b, [~F.col("_old")[c].eqNullSafe(F.col("_new")[c]) for c in compare])
    action = (F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNotNull() & changed, "updated").otherwise("kept"))
    row = F.when(F.col("_action") == "kept", F.col("_old")).otherwise(F.col("_new"))
    out = both.withColumn("_action", action).select(row.alias("_row"), "_action")
    return out.select("_row.*", *([F.col("_action").alias(note)] if note else []))


def reload_slice(target: DataFrame, src: DataFrame, col: str, low: Column, high: Column) -> DataFrame:
    """One half-open period taken from the source, all else from the target."""
    inside = between_half_open(F.col(col), low, high)
    return target.filter(~F.coalesce(inside, F.lit(False))).unionByName(src.filter(inside).select(target.columns))


def reload_stored_slice(table: StoredTable, src: DataFrame, col: str, low: Column, high: Column) -> None:
    """One half-open period of a stored table taken from the source; files without rows of the period stay."""
    inside = between_half_open(F.col(col), low, high)
    table.replace_where(inside, src.filter(inside), note="reload slice")


def swap_slice(table: StoredTable, staged: DataFrame, col: str, value: str) -> int:
    """A staged slice in place of the rows of one value; returns its rows.

    The slice is checked where it is staged: it may hold only the value asked for, and not be empty. A slice that fails
    leaves the table as it was, and `table.revert` brings an old slice back.
    """
    placed = []

    def check(rows: DataFrame) -> None:
        n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col(col).eqNullSafe(F.lit(value))).alias("foreign")).first()
        if n["foreign"] or not n["n"]:
            raise ValueError(f"staged slice does not match {col}={value}: {n['foreign']} of {n['n']} rows differ")
        placed.append(n["n"])

    table.replace_where(F.col(col) == value, staged, check, note=f"swap {col}={value}")
    return placed[0]


def full_refresh(df: DataFrame, keys: Sequence[str], sums: Sequence[str], texts: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Build the result aside and compare it with its source: (new table, reconciliation)."""
    fresh = written(df, "refresh")
    return fresh, Q.reconcile(df, fresh, keys, sums, texts)


# ---- high-water marks ----------------------------------------------------------------

def mark_of(df: DataFrame, at: str, key: str) -> DataFrame:
    """The greatest (time, id) as one row: last_at, last_id."""
    top = F.max(F.struct(F.col(at).alias("at"), F.col(key).alias("id")))
    return df.agg(top.alias("m")).select(F.col("m.at").alias("last_at"), F.col("m.id").alias("last_id"))


def increment(src: DataFrame, mark: DataFrame, at: str, key: str, late: bool = False) -> DataFrame:
    """Rows after the mark in (time, id) order; with `late`, also rows with a newer id and an older time.

    An empty mark takes every row: it is the mark of a first load.
    """
    last_at, last_id = mark.select("last_at").scalar(), mark.select("last_id").scalar()
    newer = (F.col(at) > last_at) | ((F.col(at) == last_at) & (F.col(key) > last_id))
    if late:
        newer = (F.col(at) > last_at) | (F.col(key) > last_id)
    return src.filter(F.coalesce(newer, F.lit(False)) | last_at.isNull())


def advance(mark: DataFrame, loaded: DataFrame, at: str, key: str, succeeded: bool) -> DataFrame:
    """The mark after a load: it only moves forward, and only when the load succeeded."""
    if not succeeded:
        return mark
    both = mark.unionByName(mark_of(loaded, at, key))
    return mark_of(both.filter(F.col("last_at").isNotNull()), "last_at", "last_id")


def advance_after(mark: DataFrame, loaded: DataFrame, at: str, key: str, write: Callable[[DataFrame], None]) -> DataFrame:
    """Write the rows, then move the mark. If the write fails, its error goes on and the mark stays where it was."""
    write(loaded)
    return advance(mark, loaded, at, key, succeeded=True)


def stored_mark(table: StoredTable, at: str, key: str) -> DataFrame:
    """The mark that the current version of a table was published with, as `mark_of` gives it."""
    mark = table.current().mark
    kind = {c: table.schema[c].dataType for c in (at, key)}
    return table.spark.range(1).select(F.lit(mark.get("last_at")).cast(kind[at]).alias("last_at"),
                                       F.lit(mark.get("last_id")).cast(kind[key]).alias("last_id"))


def mark_text(mark: DataFrame) -> dict[str, str | None]:
    """A mark as it is kept in a version's record."""
    return mark.select(*[F.col(c).cast("string") for c in ("last_at", "last_id")]).first().asDict()


def load_increment(table: StoredTable, src: DataFrame, at: str, key: str, late: bool = False) -> int:
    """Append the rows after the table's mark and move the mark, in one record; returns how many.

    The mark is worked out from the rows as they were written. A run that dies before the record leaves mark and rows as
    they were, so the next run loads the same rows once.
    """
    base, mark = table.current(), stored_mark(table, at, key)
    files, n = table.put(increment(src, mark, at, key, late))
    if n:
        moved = mark_text(advance(mark, table.read_files(files), at, key, succeeded=True))
        table.publish(base, (*base.files, *files), moved, "increment")
    return n


def increment_overlap(target: DataFrame, src: DataFrame, at: str, key: str, overlap: Column) -> DataFrame:
    """Re-read the tail of the source and add the keys the target lacks: a late row lands once.

    An empty target takes the whole source.
    """
    since = target.agg(F.max(at) - overlap).scalar()
    return insert_new(target, src.filter(F.coalesce(F.col(at) >= since, since.isNull())), key)


# ---- runs -----------------------------------------------------------------------------

@dataclass
class Stage:
    name: str
    build: Callable[[], tuple[DataFrame, DataFrame | None]]  # accepted, rejected
    retries: int = 0
    max_seconds: float | None = None  # the time a run may take


LOG_SCHEMA = """run_id string, stage string, attempt int, status string, started_at timestamp, finished_at timestamp, rows_read long,
    rows_written long, rows_rejected long, duration_s double, rows_per_s double, sla_status string, error_message string"""


def run_log(spark, run_id: str, stages: Sequence[Stage]) -> DataFrame:
    """Write each stage and log status, rows and time; a failed stage is tried again, then stops the run.

    Every attempt writes to a path of its own, so a retry meets no half-written rows. Rows are
    counted while the stage is written. The log has one line per attempt.
    """
    lines = []
    for stage in stages:
        for attempt in range(1, stage.retries + 2):
            lines.append(_attempt(run_id, stage, attempt))
            if lines[-1][3] == "SUCCESS":
                break
        else:
            break
    return spark.createDataFrame(lines, LOG_SCHEMA)


def _attempt(run_id: str, stage: Stage, attempt: int) -> tuple:
    begun = datetime.datetime.now()
    accepted_rows = rejected_rows = 0
    status, error = "SUCCESS", None
    try:
        accepted, rejected = stage.build()
        accepted_rows = _write_counted(accepted, stage.name)
        rejected_rows = _write_counted(rejected, stage.name + "-rejects") if rejected is not None else 0
    except Exception as e:  # noqa: BLE001 - the log records any failure
        status, error = "FAILED", str(e)
    ended = datetime.datetime.now()
    took = (ended - begun).total_seconds()
    rows = accepted_rows + rejected_rows
    sla = None if stage.max_seconds is None else "MET" if status == "SUCCESS" and took <= stage.max_seconds else "MISSED"
    return (run_id, stage.name, attempt, status, begun, ended, rows, accepted_rows, rejected_rows, took,
            rows / took if took > 0 else None, sla, error)


def _write_counted(df: DataFrame, label: str) -> int:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(scratch_path(df.sparkSession, label))
    return seen.get["n"]


def require(df: DataFrame, rule: Column, message: str) -> DataFrame:
    """Rows as they are; a row for which `rule` is not true stops the job."""
    return df.filter(F.coalesce(rule, F.lit(False)) | F.raise_error(F.lit(message)).cast("boolean"))


# ---- changes by rewriting -------------------------------------------------------------

def update(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(where, F.lit(False))
    return df.withColumns({c: F.when(hit, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()})


def update_from(df: DataFrame, other: DataFrame, key: str, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """Update with columns of a joined frame whose keys are unique."""
    return update(df.join(other, key, "left"), where, values).select(df.columns)


def delete(df: DataFrame, where: Column) -> DataFrame:
    """All rows but those for which the predicate is true; an unknown predicate keeps the row."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def archive(df: DataFrame, where: Column) -> tuple[DataFrame, DataFrame]:
    """(hot, cold): the same predicate decides both, so that together they hold every row."""
    hit = F.coalesce(where, F.lit(False))
    return df.filter(~hit), df.filter(hit)


def apply_operations(accounts: DataFrame, operations: DataFrame) -> DataFrame:
    """Balances after transfers, each operation id counted once however often it was sent.

    accounts(account_id, balance); operations(operation_id, from_account, to_account, amount).
    """
    once = Q.dedup_keep(operations, ["operation_id"], F.col("from_account").asc(), F.col("to_account").asc())
    legs = F.array(F.struct(F.col("from_account").alias("account_id"), (-F.col("amount")).alias("change")),
                   F.struct(F.col("to_account").alias("account_id"), F.col("amount").alias("change")))
    changes = once.select(F.inline(legs)).groupBy("account_id").agg(F.sum("change").alias("change"))
    return accounts.join(changes, "account_id", "left").select(
        "account_id", (F.col("balance") + F.coalesce("change", F.lit(0))).alias("balance"))


def snapshot(target: DataFrame, facts: DataFrame, key: str, at: str, as_of: str) -> DataFrame:
    """Counts per key up to the end of a date; replaces the slice of that date in the target."""
    day = F.lit(as_of).cast("date")
    return target.filter(~F.col("as_of_date").eqNullSafe(day)).unionByName(counts_until(facts, key, at, day).select(target.columns))


def store_snapshot(table: StoredTable, facts: DataFrame, key: str, at: str, as_of: str) -> None:
    """As `snapshot` into a stored table: only files of that date are replaced."""
    day = F.lit(as_of).cast("date")
    table.replace_where(F.col("as_of_date") == day, counts_until(facts, key, at, day), note=f"snapshot {as_of}")


def counts_until(facts: DataFrame, key: str, at: str, day: Column) -> DataFrame:
    counts = facts.filter(F.to_date(at) <= day).groupBy(key).agg(F.count(F.lit(1)).alias("orders_count"))
    return counts.withColumn("as_of_date", day)


# ---- layered load ---------------------------------------------------------------------

@dataclass(frozen=True)
class Layers:
    staging: DataFrame
    accepted: DataFrame
    rejected: DataFrame
    core: DataFrame


def layered_load(raw: DataFrame, stage: Callable[[DataFrame], DataFrame], rules: Sequence[Q.Rule], key: str,
                 order: Sequence[Column], batch_id: str) -> Layers:
    """raw -> staging -> accepted / rejected -> core (one row per key).

    Staging is written once: three layers read it.
    """
    staging = written(raw.transform(stage), "staging")
    accepted, rejected = Q.split_valid(staging, rules, key, batch_id)
    return Layers(staging, accepted, rejected, Q.dedup_keep(accepted, [key], *order))


def layer_counts(raw: DataFrame, layers: Layers) -> DataFrame:
    named = {"raw": raw, "staging": layers.staging, "accepted": layers.accepted, "rejected": layers.rejected, "core": layers.core}
    counts = [d.agg(F.count(F.lit(1)).alias("rows_count")).select(F.lit(n).alias("layer"), "rows_count") for n, d in named.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)
