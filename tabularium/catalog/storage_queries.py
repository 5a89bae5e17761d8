"""Source, sink and table queries: each writes the given rows to the scratch area and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.catalog.quality_queries import checksum_sql
from tabularium.catalog.registry import query
from tabularium.operators.projection import between_half_open
from tabularium.operators.quality import text_checksum
from tabularium.plans.loads import swap_slice
from tabularium.session import scratch_path
from tabularium.sources import storage as S
from tabularium.sources.stored import StoredTable
from tabularium.tables import Tables, dbl, lng


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def monthly(t: Tables):
    return t.orders.withColumn("month", F.date_format("purchased_at", "yyyy-MM"))


def totals(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_count"), dbl(F.sum("amount")).alias("amount"))


TOTALS = "COUNT(*) AS rows_count, CAST(SUM(amount) AS DOUBLE) AS amount"


@query("io1_parquet_scan", "", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 400000")
def parquet_scan(t: Tables):
    schema = T.StructType.fromDDL("o_orderkey bigint, o_orderstatus string, o_totalprice double")
    return S.read_parquet(t.spark, t.path("orders"), schema).filter("o_totalprice > 400000").select("o_orderkey", "o_orderstatus")


@query("io2_partition_scan", "", """SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS events_count FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-20' GROUP BY 1, 2""")
def partition_scan(t: Tables):
    path = scratch_path(t.spark, "events-by-day")
    S.write_partitioned(t.events.withColumn("day", F.to_date("ts")), path, ["day"])
    low, high = F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date")
    rows = S.read_partitioned(t.spark, path).filter(between_half_open(F.col("day"), low, high))
    return rows.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("events_count"))


@query("io3_csv_dialect", "prod", """SELECT 'quoted' AS dialect, product_id, product_name || ', "' || brand || '"' AS label, nullif(category, 'SMALL') AS category FROM prod
    UNION ALL SELECT 'pipe', product_id, CASE WHEN size > 25 THEN '' ELSE product_name END, nullif(category, 'SMALL') FROM prod""")
def csv_dialect(t: Tables):
    kind = F.nullif("category", F.lit("SMALL"))
    label = F.concat("product_name", F.lit(', "'), "brand", F.lit('"'))
    quoted = t.products.select("product_id", label.alias("label"), kind.alias("category"))
    back = S.export_csv(quoted, scratch_path(t.spark, "quoted-csv"))
    pipe = scratch_path(t.spark, "pipe-text")
    name = F.when(F.col("size") > 25, "").otherwise(F.col("product_name"))
    t.products.select(F.concat_ws("|", F.col("product_id").cast("string"), name, F.coalesce(kind, F.lit("\\N"))).alias("value")).write.text(pipe)
    plain = S.read_delimited(t.spark, pipe, ["product_id", "label", "category"])
    return back.select(F.lit("quoted").alias("dialect"), "*").unionByName(
        plain.select(F.lit("pipe").alias("dialect"), F.col("product_id").cast("long").alias("product_id"), "label", "category"))


@query("io4_many_locations", "ord", "SELECT order_id, order_status FROM ord")
def many_locations(t: Tables):
    paths = [scratch_path(t.spark, "part") for _ in range(2)]
    cut = F.col("purchased_at") < ntz("1998-01-01")
    for path, half in zip(paths, (cut, ~cut)):
        t.orders.filter(half).select("order_id", "order_status").write.option("header", True).csv(path)
    return S.read_csv(t.spark, paths, "order_id bigint, order_status string")


@query("io5_rejects", "", """SELECT 'good' AS outcome, CAST(event_id AS VARCHAR) AS event_id, day, NULL AS unread_fields FROM (SELECT event_id, CAST(ts AS DATE) AS day, event_type FROM events) WHERE event_type NOT IN ('error', 'signup')
    UNION ALL SELECT 'bad', CASE event_type WHEN 'error' THEN 'n' ELSE CAST(event_id AS VARCHAR) END || ',' || CASE event_type WHEN 'signup' THEN 'someday' ELSE strftime(ts, '%Y-%m-%d') END, NULL,
    CASE event_type WHEN 'error' THEN 'event_id' ELSE 'day' END FROM events WHERE event_type IN ('error', 'signup')""")
def rejects(t: Tables):
    kind = F.col("event_type")
    lines = t.events.select(F.when(kind == "error", "n").otherwise(F.col("event_id").cast("string")).alias("event_id"),
                            F.when(kind == "signup", "someday").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"))
    path = scratch_path(t.spark, "dirty-csv")
    lines.write.option("header", True).csv(path)
    good, bad = S.read_with_rejects(t.spark, path, T.StructType.fromDDL("event_id bigint, day date"))
    none = F.lit(None)
    return good.select(F.lit("good").alias("outcome"), F.col("event_id").cast("string").alias("event_id"), "day", none.cast("string").alias("unread_fields")).unionByName(
        bad.select(F.lit("bad").alias("outcome"), F.col("raw_line").alias("event_id"), none.cast("date").alias("day"), "unread_fields"))


@query("io6_json_lines", "", "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_lines(t: Tables):
    path = scratch_path(t.spark, "json")
    props = F.from_json("props", "k bigint")
    t.events.select("event_id", "event_type", props.alias("props")).write.json(path)
    rows = S.read_json(t.spark, path, "event_id bigint, event_type string, props struct<k: bigint>")
    return rows.select("event_id", "event_type", "props.k")


@query("io8_write_modes", "ord", f"""WITH h AS (SELECT * FROM ord WHERE order_status = 'F') SELECT 'append' AS step, {TOTALS} FROM (SELECT amount FROM ord UNION ALL SELECT amount FROM h)
    UNION ALL SELECT codec, {TOTALS} FROM ord, (SELECT unnest(['snappy', 'gzip', 'zstd']) AS codec) GROUP BY codec""")
def write_modes(t: Tables):
    rows = t.orders.select("order_id", "amount", "order_status")
    grown = scratch_path(t.spark, "modes")
    S.write_parquet(rows.filter("order_status = 'O'"), grown)
    S.write_parquet(rows, grown, "overwrite")
    S.write_parquet(rows.filter("order_status = 'F'"), grown, "append")
    out = totals(S.read_parquet(t.spark, grown, rows.schema)).select(F.lit("append").alias("step"), "*")
    for codec in ("snappy", "gzip", "zstd"):
        path = scratch_path(t.spark, codec)
        S.write_parquet(rows, path, codec=codec)
        out = out.unionByName(totals(S.read_parquet(t.spark, path, rows.schema)).select(F.lit(codec).alias("step"), "*"))
    return out


@query("io9_partitioned_sink", "ord", f"SELECT year(purchased_at) AS y, month(purchased_at) AS m, {TOTALS} FROM ord GROUP BY 1, 2")
def partitioned_sink(t: Tables):
    path = scratch_path(t.spark, "by-year-month")
    S.write_partitioned(t.orders.withColumn("y", F.year("purchased_at")).withColumn("m", F.month("purchased_at")), path, ["y", "m"])
    return totals(S.read_partitioned(t.spark, path), lng("y").alias("y"), lng("m").alias("m"))


@query("io9_text_partitions", "ord", f"SELECT lpad(CAST(customer_id % 12 AS VARCHAR), 3, '0') AS code, {TOTALS} FROM ord GROUP BY 1")
def text_partitions(t: Tables):
    """Partition values that look like numbers stay texts: 007 is not 7."""
    path = scratch_path(t.spark, "by-code")
    S.write_partitioned(t.orders.withColumn("code", F.lpad((F.col("customer_id") % 12).cast("string"), 3, "0")), path, ["code"])
    return totals(S.read_partitioned(t.spark, path), "code")


@query("io10_default_partition", "ord", f"""SELECT 'before' AS step, CASE WHEN year(purchased_at) BETWEEN 1996 AND 1998 THEN 'y' || year(purchased_at) ELSE 'default' END AS part, {TOTALS} FROM ord GROUP BY 2
    UNION ALL SELECT 'after', CASE WHEN year(purchased_at) BETWEEN 1996 AND 1999 THEN 'y' || year(purchased_at) ELSE 'default' END, {TOTALS} FROM ord GROUP BY 2""")
def default_partition(t: Tables):
    def ranges(last): return {f"y{y}": (ntz(f"{y}-01-01"), ntz(f"{y + 1}-01-01")) for y in range(1996, last + 1)}
    path, split = scratch_path(t.spark, "ranges"), scratch_path(t.spark, "ranges-split")
    S.write_partitioned(t.orders.withColumn("part", S.route_default(F.col("purchased_at"), ranges(1998))), path, ["part"])
    before = S.read_partitioned(t.spark, path)
    # the default part is read, split by range, and written with the untouched parts
    moved = before.filter("part = 'default'").withColumn("part", S.route_default(F.col("purchased_at"), ranges(1999)))
    S.write_partitioned(before.filter("part <> 'default'").unionByName(moved), split, ["part"])
    after = S.read_partitioned(t.spark, split)
    return totals(before, "part").select(F.lit("before").alias("step"), "*").unionByName(
        totals(after, "part").select(F.lit("after").alias("step"), "*"))


@query("io11_dynamic_overwrite", "ord", f"""SELECT strftime(purchased_at, '%Y-%m') AS month, {TOTALS} FROM (SELECT purchased_at, CASE WHEN year(purchased_at) = 1998 THEN amount * 2 ELSE amount END AS amount FROM ord) GROUP BY 1""")
def dynamic_overwrite(t: Tables):
    path = scratch_path(t.spark, "by-month")
    S.write_partitioned(monthly(t), path, ["month"])
    changed = monthly(t).filter(between_half_open(F.col("purchased_at"), ntz("1998-01-01"), ntz("1999-01-01")))
    S.overwrite_partitions(changed.withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)")), path, ["month"])
    return totals(S.read_partitioned(t.spark, path), "month")


@query("io12_staged_swap", "ord", f"""SELECT strftime(purchased_at, '%Y-%m') AS month, {TOTALS} FROM (SELECT purchased_at, CASE WHEN strftime(purchased_at, '%Y-%m') = '2001-07' THEN amount + 1 ELSE amount END AS amount FROM ord
    WHERE NOT (strftime(purchased_at, '%Y-%m') = '2001-07' AND order_status = 'P')) GROUP BY 1""")
def staged_swap(t: Tables):
    table = StoredTable.create(monthly(t), scratch_path(t.spark, "swap"), ["month"])
    staged = monthly(t).filter("month = '2001-07' AND order_status <> 'P'").withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    swap_slice(table, staged, "month", "2001-07")
    first = table.current()
    try:
        swap_slice(table, monthly(t).filter("month >= '2001-07'"), "month", "2001-07")
    except ValueError:  # the staged rows are of other months too, so the slice stays
        pass
    swap_slice(table, monthly(t).filter("month = '2001-08'").withColumn("amount", F.col("amount") * 0), "month", "2001-08")
    table.revert(first.number)  # the way back
    return totals(table.read(), "month")


@query("io13_alter_partitions", "ord", f"""SELECT 'before' AS step, order_status, {TOTALS} FROM ord GROUP BY 2 UNION ALL SELECT 'after', order_status, {TOTALS} FROM ord WHERE order_status = 'F' GROUP BY 2""")
def alter_partitions(t: Tables):
    name = S.create_table(t.spark, "by_status", t.orders.select("order_id", "amount", "order_status"), ["order_status"])
    before = totals(t.orders, "order_status").select(F.lit("before").alias("step"), "*")
    S.add_partition(t.spark, name, order_status="X")
    S.drop_partition(t.spark, name, order_status="P")
    S.truncate_partition(t.spark, name, order_status="O")
    return before.unionByName(totals(t.spark.table(name), "order_status").select(F.lit("after").alias("step"), "*"))


@query("io14_repair", "ord", f"SELECT order_status, {TOTALS} FROM ord GROUP BY 1")
def repair(t: Tables):
    path, name = scratch_path(t.spark, "outside"), S.table_name(t.spark, "repaired")
    rows = t.orders.select("order_id", "amount", "order_status")
    S.write_partitioned(rows, path, ["order_status"])
    t.spark.sql(f"CREATE TABLE {name} (order_id BIGINT, amount DECIMAL(18,2), order_status STRING) USING parquet PARTITIONED BY (order_status) LOCATION '{path}'")
    S.repair(t.spark, name)
    return totals(t.spark.table(name), "order_status")


@query("io15_partition_profile", "ord", "SELECT strftime(purchased_at, '%Y-%m') AS month, COUNT(*) AS rows_count FROM ord GROUP BY 1")
def partition_profile(t: Tables):
    path = scratch_path(t.spark, "profiled")
    S.write_partitioned(monthly(t), path, ["month"])
    report = S.partition_profile(S.read_partitioned(t.spark, path), "month")
    return report.filter("files > 0 AND bytes > 0").select("month", "rows_count")


@query("io16_file_profile", "", "SELECT COUNT(*) AS rows_count, true AS has_files, true AS bytes_add_up, true AS share_is_a_share FROM lineitem")
def file_profile(t: Tables):
    path = scratch_path(t.spark, "files")
    t.raw("lineitem").hint("rebalance").write.parquet(path)
    found = S.file_profile(S.read_parquet(t.spark, path, t.raw("lineitem").schema), 1 << 20)
    return found.select("rows_count", (F.col("file_count") > 0).alias("has_files"),
                        (F.abs(F.col("avg_bytes") * F.col("file_count") - F.col("total_bytes")) < 1).alias("bytes_add_up"),
                        F.col("largest_share").between(1 / F.col("file_count"), F.lit(1.0)).alias("share_is_a_share"))


@query("io17_compaction", "item", f"""SELECT CAST({checksum_sql('order_id', 'item_id', 'product_id')} AS VARCHAR) AS checksum, COUNT(*) AS rows_count, true AS fewer_files FROM item""")
def compaction(t: Tables):
    many, few = scratch_path(t.spark, "many"), scratch_path(t.spark, "few")
    t.items.select("order_id", "item_id", "product_id", "price").repartition("order_id", "item_id").write.option("maxRecordsPerFile", 1000).parquet(many)
    rows = S.compact(t.spark, many, few)
    before = S.file_profile(S.read_parquet(t.spark, many, rows.schema), 1 << 20).select(F.col("file_count").alias("before"))
    after = S.file_profile(rows, 1 << 20).select(F.col("file_count").alias("after"))
    return rows.agg(text_checksum(F.col("order_id"), F.col("item_id"), F.col("product_id")).cast("string").alias("checksum"), F.count(F.lit(1)).alias("rows_count")).withColumn(
        "fewer_files", after.scalar() < before.scalar())


@query("io18_bucketed_table", "ord", f"SELECT customer_id, {TOTALS} FROM ord GROUP BY 1")
def bucketed_table(t: Tables):
    return totals(S.write_bucketed(t.orders.select("customer_id", "order_id", "amount"), "customer_id"), "customer_id")


@query("io19_tables", "ord", f"""SELECT 'managed' AS kind, order_status, {TOTALS} FROM (SELECT order_status, amount FROM ord UNION ALL SELECT order_status, amount FROM ord WHERE order_status = 'P') GROUP BY 2
    UNION ALL SELECT 'external', order_status, {TOTALS} FROM ord GROUP BY 2 UNION ALL SELECT 'ctas', order_status, {TOTALS} FROM ord WHERE order_status <> 'F' GROUP BY 2""")
def tables(t: Tables):
    spark, rows = t.spark, t.orders.select("order_id", "order_status", "amount")
    managed = S.create_table(spark, "managed", rows)
    rows.filter("order_status = 'P'").write.insertInto(managed)
    spark.sql(f"ALTER TABLE {managed} ADD COLUMNS (note STRING)")
    path = scratch_path(spark, "external")
    external = S.create_table(spark, "external", rows, location=path)
    spark.sql(f"DROP TABLE {external}")  # the files of an external table stay
    ctas = S.table_name(spark, "ctas")
    spark.sql(f"CREATE TABLE {ctas} USING parquet AS SELECT * FROM {managed} WHERE order_status = 'O' OR (order_status = 'P' AND order_id IN (SELECT order_id FROM {managed} GROUP BY order_id HAVING count(*) > 1))")
    made = spark.table(ctas).dropDuplicates(["order_id"])
    out = totals(spark.table(managed), "order_status").select(F.lit("managed").alias("kind"), "*")
    out = out.unionByName(totals(S.read_parquet(spark, path, rows.schema), "order_status").select(F.lit("external").alias("kind"), "*"))
    return out.unionByName(totals(made, "order_status").select(F.lit("ctas").alias("kind"), "*"))


@query("io20_views", "ord", "SELECT 'temp' AS scope, order_id, order_status FROM ord WHERE order_status <> 'P' UNION ALL SELECT 'global', order_id, order_status FROM ord WHERE order_status <> 'P'")
def views(t: Tables):
    contract = t.orders.filter("order_status <> 'P'").select("order_id", "order_status")
    temp, whole = S.serve(contract, "tabularium_safe_orders"), S.serve(contract, "tabularium_safe_orders", everywhere=True)
    return t.spark.sql(f"SELECT 'temp' AS scope, * FROM {temp} UNION ALL SELECT 'global', * FROM {whole}")


@query("io21_schema_merge", "ord", """SELECT order_id, CASE WHEN purchased_at < TIMESTAMP '1998-01-01' THEN NULL ELSE priority END AS priority, 'order_id:type_changed,order_status:removed,priority:added' AS schema_changes FROM ord""")
def schema_merge(t: Tables):
    old, new = scratch_path(t.spark, "old"), scratch_path(t.spark, "new")
    cut = F.col("purchased_at") < ntz("1998-01-01")
    t.orders.filter(cut).select("order_id").write.parquet(old)
    t.orders.filter(~cut).select("order_id", "priority").write.parquet(new)
    changes = S.reconcile_schema(t.orders.select("order_id", "order_status"), t.orders.select(F.col("order_id").cast("string"), "priority"))
    text = changes.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "column_name", "state"))), ",")).scalar()
    return S.read_merged(t.spark, old, new).select("order_id", "priority", text.alias("schema_changes"))


@query("io22_csv_export", "ord", f"SELECT order_status, priority, {TOTALS} FROM ord GROUP BY 1, 2")
def csv_export(t: Tables):
    return S.export_csv(totals(t.orders, "order_status", "priority"), scratch_path(t.spark, "report-csv"))


@query("io23_format_report", "", """SELECT unnest(['csv', 'csv', 'json', 'parquet', 'parquet']) AS file_format, unnest(['none', 'gzip', 'gzip', 'snappy', 'zstd']) AS codec, COUNT(*) AS rows_count, true AS has_bytes FROM orders""")
def format_report(t: Tables):
    report = S.format_report(t.orders, [("csv", "none"), ("csv", "gzip"), ("json", "gzip"), ("parquet", "snappy"), ("parquet", "zstd")])
    return report.select("file_format", "codec", "rows_count", (F.col("total_bytes") > 0).alias("has_bytes"))


@query("io24_cached_outputs", "ord", f"SELECT 'status' AS output, order_status AS key, {TOTALS} FROM ord GROUP BY 2 UNION ALL SELECT 'priority', priority, {TOTALS} FROM ord GROUP BY 2")
def cached_outputs(t: Tables):
    fine = totals(t.orders, "order_status", "priority")
    paths = {}
    with S.cached(fine) as kept:
        for key in ("order_status", "priority"):
            paths[key] = scratch_path(t.spark, key)
            kept.groupBy(key).agg(F.sum("rows_count").alias("rows_count"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount")).write.parquet(paths[key])
    a, b = [t.spark.read.parquet(p).withColumnRenamed(k, "key") for k, p in paths.items()]
    return a.select(F.lit("status").alias("output"), "*").unionByName(b.select(F.lit("priority").alias("output"), "*"))
