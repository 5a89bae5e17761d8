"""Files, partitions and tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.session import scratch_path, scratch_root, written

CORRUPT = "_corrupt"
SCHEMA_FILE = "_schema.json"  # readers skip names that begin with an underscore
FILE_BYTES = 128 << 20  # size a compacted file is meant to have
BUCKET_ROWS = 5_000_000  # rows of one bucket, and of one key


# ---- reading -------------------------------------------------------------------------

def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_partitioned(spark: SparkSession, root: str, *parts: str, schema: T.StructType | None = None) -> DataFrame:
    """All of `root`, or only some of its directories with the partition columns kept.

    Without a schema the one that `write_partitioned` left in `root` counts. Where there is none Spark guesses the types
    of partition values, which turns the text 007 into 7.
    """
    schema = schema if schema is not None else stored_schema(spark, root)
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader
    return reader.parquet(*([f"{root}/{p}" for p in parts] or [root]))


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, header: bool = True, sep: str = ",",
             quote: str = '"', escape: str = '"', null: str = "\\N", encoding: str = "UTF-8") -> DataFrame:
    options = {"header": header, "sep": sep, "quote": quote, "escape": escape, "nullValue": null, "encoding": encoding}
    return spark.read.schema(schema).options(**options).csv(list(path) if not isinstance(path, str) else path)


def read_delimited(spark: SparkSession, path: str, names: Sequence[str], sep: str = "|", null: str = "\\N") -> DataFrame:
    """Unquoted text columns in which the null mark is NULL and an empty field stays empty."""
    fields = F.split("value", F.lit(f"\\Q{sep}\\E"), F.lit(-1))
    rows = spark.read.text(path).select(fields.alias("f"))
    return rows.select(*[F.nullif(F.get("f", F.lit(i)), F.lit(null)).alias(n) for i, n in enumerate(names)])


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a CSV; bad rows keep the raw line. More than `limit` bad rows fail the load.

    Parsed rows are written once: a later reader that needs few columns would otherwise not
    parse the others, and would not see that they are bad.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = spark.read.schema(full).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).csv(path)
    rows = written(parsed, "parsed")
    bad = rows.filter(F.col(CORRUPT).isNotNull())
    # a field that is empty in the line is not a cause
    fields = F.from_csv(F.col(CORRUPT), ", ".join(f"`{f.name}` string" for f in schema.fields))
    causes = [F.when(F.col(f.name).isNull() & fields[f.name].isNotNull(), F.lit(f.name)) for f in schema.fields]
    bad = bad.select(F.col(CORRUPT).alias("raw_line"), F.array_join(F.array_compact(F.array(*causes)), ";").alias("unread_fields"))
    if limit is not None and bad.limit(limit + 1).count() > limit:
        raise ValueError(f"more than {limit} rejected rows in {path}")
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def read_json(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Files of several schemas; a column that a file lacks reads as NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def reconcile_schema(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row per column of either side: same, added, removed or type_changed. Nothing is coerced."""
    old = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    new = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    rows = []
    for name in sorted(old | new):
        x, y = old.get(name), new.get(name)
        state = "added" if x is None else "removed" if y is None else "same" if x == y else "type_changed"
        rows.append((name, x, y, state))
    return a.sparkSession.createDataFrame(rows, "column_name string, old_type string, new_type string, state string")


# ---- writing -------------------------------------------------------------------------

def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", codec: str = "snappy") -> None:
    df.write.mode(mode).option("compression", codec).parquet(path)


def spread_for(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value before a partitioned write.

    Adaptive execution merges small groups and cuts a value that holds many rows into
    several tasks, so neither small files nor one giant task result.
    """
    return df.hint("rebalance", *cols)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "errorifexists") -> None:
    """Rows by partition directories, with the schema beside them: directory names do not tell a text from a number."""
    spread_for(df, cols).write.mode(mode).partitionBy(*cols).parquet(path)
    if mode != "append" or stored_schema(df.sparkSession, path) is None:
        fs, at = folder(df.sparkSession, path, SCHEMA_FILE)
        out = fs.create(at, True)
        out.write(bytearray(df.schema.json().encode()))
        out.close()


def stored_schema(spark: SparkSession, root: str) -> T.StructType | None:
    """The schema that `write_partitioned` left beside the rows."""
    fs, at = folder(spark, root, SCHEMA_FILE)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def folder(spark: SparkSession, path: str, name: str):
    """File system and path of an entry below `path`, wherever Spark can read that."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def overwrite_partitions(df: DataFrame, path: str, cols: Sequence[str]) -> None:
    """Replace only the partitions that `df` has rows for. `df` must not read from `path`."""
    spread_for(df, cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def remove_partitions(spark: SparkSession, path: str, col: str, values: Sequence[str]) -> None:
    """Directories of values that have no rows any more."""
    for value in values:
        fs, at = folder(spark, path, f"{col}={value}")
        fs.delete(at, True)


def route_default(col: Column, ranges: Mapping[str, tuple], default: str = "default") -> Column:
    """Name of the half-open range that holds the value; all else goes to the default part."""
    label = None
    for name, (low, high) in ranges.items():
        test = (col >= low) & (col < high)
        label = F.when(test, name) if label is None else label.when(test, name)
    return F.lit(default) if label is None else label.otherwise(default)


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Same rows under a new directory, in files of about `file_bytes` each: their number follows from the bytes."""
    rows = read_parquet(spark, source)
    size = file_rows(rows).agg(F.sum("file_size")).first()[0] or 0
    rows.repartition(max(1, -(-size // file_bytes))).write.parquet(target)
    return read_parquet(spark, target, rows.schema)


def export_csv(df: DataFrame, path: str) -> DataFrame:
    """Write as CSV and read back with the same types."""
    df.write.options(header=True, nullValue="\\N", quote='"', escape='"').csv(path)
    return read_csv(df.sparkSession, path, df.schema)


def avro_round_trip(df: DataFrame) -> DataFrame:
    """Through Avro; fails where the Avro data source, a package of its own, is not installed."""
    path = scratch_path(df.sparkSession, "avro")
    df.write.format("avro").save(path)
    return df.sparkSession.read.format("avro").schema(df.schema).load(path)


# ---- layout reports -------------------------------------------------------------------

def file_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Rows and size of each file a frame is read from."""
    named = df.select(*keys, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
    return named.groupBy(*keys, "file_path").agg(F.max("file_size").alias("file_size"), F.count(F.lit(1)).alias("rows_count"))


def file_profile(df: DataFrame, small_bytes: int) -> DataFrame:
    return file_rows(df).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("file_size").alias("total_bytes"), F.avg("file_size").alias("avg_bytes"),
        F.count_if(F.col("file_size") < small_bytes).alias("small_files"), F.sum("rows_count").alias("rows_count"),
        (F.max("file_size") / F.sum("file_size")).alias("largest_share"))


def partition_profile(df: DataFrame, *cols: str) -> DataFrame:
    """Per partition: rows, files, bytes."""
    return file_rows(df, *cols).groupBy(*cols).agg(
        F.sum("rows_count").alias("rows_count"), F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))


def format_report(df: DataFrame, variants: Sequence[tuple[str, str]]) -> DataFrame:
    """The same rows written in each (format, codec): files, bytes and rows read back."""
    spark, out = df.sparkSession, []
    for form, codec in variants:
        path = scratch_path(spark, f"{form}-{codec}")
        df.write.format(form).option("compression", codec).save(path)
        back = spark.read.format(form).schema(df.schema).load(path)
        out.append(file_profile(back, 1 << 20).select(F.lit(form).alias("file_format"), F.lit(codec).alias("codec"), "file_count", "total_bytes", "rows_count"))
    return reduce(lambda a, b: a.unionByName(b), out)


# ---- tables ---------------------------------------------------------------------------

def work_database(spark: SparkSession) -> str:
    """A database whose managed tables live in the shared scratch area."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tabularium_work LOCATION '{scratch_root(spark)}/tabularium/tables'")
    return "tabularium_work"


def table_name(spark: SparkSession, label: str) -> str:
    return f"{work_database(spark)}.{label}_{uuid.uuid4().hex[:12]}"


def hottest_share(df: DataFrame, key: str) -> float:
    """Share of the rows that the most frequent key holds."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("share")).first()["share"] or 0.0


def buckets_for(df: DataFrame, bucket_rows: int = BUCKET_ROWS) -> int:
    """As many buckets as hold at most about `bucket_rows` rows each."""
    return max(1, -(-df.count() // bucket_rows))


def write_bucketed(df: DataFrame, key: str, buckets: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """A table bucketed and sorted by `key`; joins of such tables on the key need no shuffle.

    A bucket holds whole keys and is read by one task, so a key with more than `bucket_rows`
    rows is refused. Without `buckets`, their number follows from the number of rows.
    """
    hottest = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if hottest > bucket_rows:
        raise ValueError(f"a key of {key} has {hottest} rows, more than the {bucket_rows} of a bucket")
    n = buckets or buckets_for(df, bucket_rows)
    name = table_name(df.sparkSession, "bucketed")
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def create_table(spark: SparkSession, label: str, df: DataFrame, partition_by: Sequence[str] = (), location: str | None = None) -> str:
    """Managed table, or external at `location`; returns its name."""
    name = table_name(spark, label)
    writer = (spread_for(df, partition_by) if partition_by else df).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(name)
    return name


def _spec(values: Mapping[str, str]) -> str:
    return ", ".join(f"{k}='{v}'" for k, v in values.items())


def add_partition(spark: SparkSession, table: str, **values: str) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_spec(values)})")


def drop_partition(spark: SparkSession, table: str, **values: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(values)})")


def truncate_partition(spark: SparkSession, table: str, **values: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table} PARTITION ({_spec(values)})")


def repair(spark: SparkSession, table: str) -> None:
    """Register partition directories that were written outside the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def serve(df: DataFrame, name: str, everywhere: bool = False) -> str:
    """A view as the stable column contract over a physical table; returns the name to query."""
    if everywhere:
        df.createOrReplaceGlobalTempView(name)
        return f"{df.sparkSession.conf.get('spark.sql.globalTempDatabase')}.{name}"
    df.createOrReplaceTempView(name)
    return name


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """A frame kept for several outputs of one job and released afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
