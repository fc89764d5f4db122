"""Files, Kafka rows and Bronze tables."""

from pyspark.sql import functions as F

from tradepath.contracts import CONTRACTS, struct
from tradepath.operators.quality import contract_checks, publish_counts, run_reports, split
from tradepath.registry import register
from tradepath.registry.silver import ts
from tradepath.sources import bronze, csv, kafka
from tradepath.sources.buckets import BucketedTable
from tradepath.sources.marks import MarkedLoad
from tradepath.sources.workspace import fresh_path

_REVIEWS = "review_id long, order_id long, review_score int, review_comment_message string"
_ORDERS = ["order_id long", "customer_id long", "order_status string",
           *[f"{c} string" for c in CONTRACTS["orders"].schema.names[3:]]]


#: Of a file that one task reads whole, as its text has line breaks.
_FILE_BYTES = 512 << 20


def _written(m, df, label, file_bytes=None):
    path = fresh_path(m.spark, label)
    csv.write_csv(df, path, file_bytes)
    return path


def _order_text(m):
    """Orders as a CSV source would give them: timestamps as text."""
    return m.orders.select(*[
        F.col(c).cast("string").alias(c) if c.startswith("order_") and c not in
        ("order_id", "order_status") else F.col(c) for c in m.orders.columns])


@register("s01_csv_scan", """
    SELECT review_id, order_id, review_score, length(review_comment_message) AS n_chars,
      md5(review_comment_message) AS digest FROM m_reviews_text""")
def _(m):
    reviews = m.reviews_with_text.drop("review_creation_date")
    path = _written(m, reviews, "reviews-csv", _FILE_BYTES)
    back = csv.read_csv(m.spark, path, _REVIEWS, multi_line=True)
    return back.select("review_id", "order_id", "review_score",
                       F.length("review_comment_message").cast("long").alias("n_chars"),
                       F.md5("review_comment_message").alias("digest"))


def _orders_csv(m):
    return csv.read_csv(m.spark, _written(m, _order_text(m), "orders-csv"), ", ".join(_ORDERS))


@register("s02_csv_row_count", "SELECT count(*) AS n_rows FROM m_orders")
def _(m):
    return csv.row_count(_orders_csv(m))


@register("s03_csv_preview", "SELECT 5 AS n, 5 AS n_different, 5 AS n_known")
def _(m):
    """Five different orders of the file."""
    rows = csv.preview(_orders_csv(m), 5).select("order_id")
    known = m.orders.select(F.col("order_id").cast(rows.schema["order_id"].dataType).alias("id"))
    return rows.join(known, F.col("order_id") == F.col("id"), "left").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("n_different"),
        F.count("id").alias("n_known"))


def _with_gaps(m):
    """Orders with missing required values: no customer on every 29th, no status on every 31st."""
    k = F.col("order_id")
    return m.orders.withColumn("customer_id", F.when(k % 29 != 0, F.col("customer_id"))) \
        .withColumn("order_status", F.when(k % 31 != 0, F.col("order_status")))


_GAPS = "(order_id % 29 = 0 OR order_id % 31 = 0)"


@register("s04_publish", f"""
    SELECT count(*) AS processed, count(*) FILTER (WHERE NOT {_GAPS}) AS published,
      count(*) FILTER (WHERE {_GAPS}) AS skipped_invalid, CAST(0 AS BIGINT) AS failed FROM m_orders""")
def _(m):
    target = fresh_path(m.spark, "published")
    return csv.publish(_with_gaps(m), CONTRACTS["orders"], lambda rows: rows.write.parquet(target))


@register("s06_kafka_projection", """
    SELECT k AS kafka_key, topic AS kafka_topic, part AS kafka_partition, off AS kafka_offset,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp, p_event_id IS NULL AS broken
    FROM m_kafka""")
def _(m):
    return kafka.project(m.kafka_rows).select(
        "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset",
        F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("kafka_timestamp"),
        (F.col("kafka_value") == "{broken").alias("broken"),
    )


EVENT_SCHEMA = struct("event_id long, user_id long, event_type string, value double")


@register("s07_json_decode", """
    SELECT k AS kafka_key, off AS kafka_offset, p_event_id AS event_id, p_user_id AS user_id,
      p_event_type AS event_type, round(p_value, 6) AS value FROM m_kafka""")
def _(m):
    return kafka.decode(kafka.project(m.kafka_rows), EVENT_SCHEMA).select(
        "kafka_key", "kafka_offset", "event_id", "user_id", "event_type", "value")


@register("s08_ingest_stamp", """
    SELECT topic AS kafka_topic, count(*) AS n_rows, 1 AS n_stamps, TRUE AS stamped FROM m_kafka
    GROUP BY 1""")
def _(m):
    rows = kafka.decode(kafka.project(m.kafka_rows), EVENT_SCHEMA)
    return rows.groupBy("kafka_topic").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("bronze_ingested_at").alias("n_stamps"),
        (F.count("bronze_ingested_at") == F.count(F.lit(1))).alias("stamped"),
    )


@register("s10_kafka_encode", """
    SELECT CAST(product_id AS VARCHAR) AS key, CAST(to_json({
      'product_id': product_id, 'product_category_name': product_category_name,
      'product_photos_qty': product_photos_qty, 'product_weight_g': product_weight_g})
      AS VARCHAR) AS value FROM m_products""")
def _(m):
    return kafka.encode(m.products, "product_id", [
        "product_id", "product_category_name", "product_photos_qty", "product_weight_g"])


@register("s11_bronze_partitioned_write", """
    SELECT CAST(year(order_purchase_timestamp) AS INTEGER) AS order_purchase_year,
      CAST(month(order_purchase_timestamp) AS INTEGER) AS order_purchase_month, count(*) AS n
    FROM m_orders GROUP BY 1, 2""")
def _(m):
    path = fresh_path(m.spark, "bronze-orders")
    bronze.write_partitioned(m.orders, "orders", path)
    return m.spark.read.parquet(path).groupBy(
        "order_purchase_year", "order_purchase_month").agg(F.count(F.lit(1)).alias("n"))


_CUT = "2000-01-01"
_DAILY = """(SELECT order_id, date_trunc('day', order_purchase_timestamp) AS t FROM m_orders)"""
_LOADED = f"""(SELECT * FROM {_DAILY} WHERE t < TIMESTAMP '{_CUT}'
      OR order_id % 10 = 0 AND t < TIMESTAMP '2000-06-01')"""


def _daily_load(m):
    """Orders by day, and those of them loaded so far: the last loaded day has others as well."""
    source = m.orders.select("order_id", F.date_trunc("day", "order_purchase_timestamp").cast(
        "timestamp_ntz").alias("t"))
    return source, source.where((F.col("t") < F.lit(_CUT)) | (
        (F.col("order_id") % 10 == 0) & (F.col("t") < F.lit("2000-06-01"))))


@register("s12_incremental_load", f"""
    SELECT order_id, {ts('t')} AS t FROM {_DAILY}
    WHERE t >= (SELECT max(t) FROM {_LOADED})
      AND order_id NOT IN (SELECT order_id FROM {_LOADED})""")
def _(m):
    return bronze.above_watermark(*_daily_load(m), "t", ["order_id"])


@register("s12_load_with_a_mark", f"""
    SELECT 'orders' AS table_name, CAST(1 AS BIGINT) AS load, count(*) AS n_rows,
      CAST(0 AS BIGINT) AS late_rows, {ts('max(t)')} AS mark FROM {_LOADED}
    UNION ALL SELECT 'orders', 2, (SELECT count(*) FROM {_DAILY}) - count(*)
        - (SELECT count(*) FROM {_DAILY} WHERE t < (SELECT max(t) FROM {_LOADED})
           AND order_id NOT IN (SELECT order_id FROM {_LOADED})),
      (SELECT count(*) FROM {_DAILY} WHERE t < (SELECT max(t) FROM {_LOADED})
           AND order_id NOT IN (SELECT order_id FROM {_LOADED})),
      {ts(f'(SELECT max(t) FROM {_DAILY})')} FROM {_LOADED}""")
def _(m):
    """Two loads; the second one's late rows are counted by the stored mark."""
    source, loaded = _daily_load(m)
    base = fresh_path(m.spark, "marked")
    load = MarkedLoad(m.spark, "orders", f"{base}/rows", f"{base}/marks", "t", ["order_id"])
    load.run(loaded)
    load.run(source)
    return load.marks().select("table_name", "load", "n_rows", "late_rows", "mark")


@register("s12_late_rows", f"""
    SELECT order_id, {ts('t')} AS t FROM {_DAILY}
    WHERE t < (SELECT max(t) FROM {_LOADED})
      AND order_id NOT IN (SELECT order_id FROM {_LOADED})""")
def _(m):
    return bronze.below_watermark(*_daily_load(m), "t", ["order_id"])


@register("s13_upsert", """
    SELECT order_id, CASE WHEN order_id % 5 = 0 THEN 'canceled' ELSE order_status END AS order_status
    FROM m_orders WHERE order_id % 3 <> 0 OR order_id % 5 = 0""")
def _(m):
    """Updates of two loads into a table in buckets."""
    rows = m.orders.select("order_id", "order_purchase_timestamp", "order_status")
    table = BucketedTable(m.spark, fresh_path(m.spark, "orders"), rows.schema, ["order_id"], 16)
    table.append(rows.where("order_id % 3 <> 0"))
    updates = rows.where("order_id % 5 = 0").withColumn("order_status", F.lit("canceled"))
    for load in ("order_id % 2 = 0", "order_id % 2 <> 0"):
        table.upsert(updates.where(load), ["order_purchase_timestamp"])
    return table.read().select("order_id", "order_status")


def contract_tables(m):
    return {
        "orders": m.orders, "customers": m.customers, "order_items": m.items,
        "order_payments": m.payments, "products": m.products, "order_reviews": m.reviews,
        "sellers": m.sellers, "geolocation": m.geolocation, "category_translation": m.translation,
    }


TABLE_VIEWS = {"orders": "m_orders", "customers": "m_customers", "order_items": "m_items",
               "order_payments": "m_payments", "products": "m_products", "order_reviews": "m_reviews",
               "sellers": "m_sellers", "geolocation": "m_geo", "category_translation": "m_translation"}


@register("s14_table_contracts", " UNION ALL ".join(f"""
    SELECT '{t}' AS table_name, '{check}' AS validation_name, 'passed' AS status,
      count(*) AS rows_checked, CAST(0 AS BIGINT) AS rows_failed FROM {v}"""
    for t, v in TABLE_VIEWS.items() for check in ("schema_validation", "null_validation")))
def _(m):
    return run_reports([
        (name, rows, contract_checks(CONTRACTS[name])) for name, rows in contract_tables(m).items()
    ]).select("table_name", "validation_name", "status", "rows_checked", "rows_failed")


@register("v13_valid_rows", f"""
    SELECT order_id, customer_id, order_status FROM m_orders WHERE NOT {_GAPS}""")
def _(m):
    valid, _bad = split(_with_gaps(m), contract_checks(CONTRACTS["orders"]))
    return valid.select("order_id", "customer_id", "order_status")


@register("v13_quarantined_rows", f"""
    SELECT order_id, 'null_validation' AS failed_checks FROM m_orders WHERE {_GAPS}""")
def _(m):
    _valid, bad = split(_with_gaps(m), contract_checks(CONTRACTS["orders"]))
    return bad.select("order_id", F.array_join("_failed_checks", ",").alias("failed_checks"))


@register("m02_publish_counters", f"""
    SELECT count(*) AS processed, count(*) FILTER (WHERE NOT {_GAPS}) AS published,
      count(*) FILTER (WHERE {_GAPS}) AS skipped_invalid, CAST(0 AS BIGINT) AS failed FROM m_orders""")
def _(m):
    return publish_counts(_with_gaps(m), contract_checks(CONTRACTS["orders"]))
