"""Streams run to the end of a file source."""

from pyspark.sql import functions as F

from tradepath.contracts import CONTRACTS
from tradepath.operators.quality import DuplicateCheck, NullCheck, SchemaCheck
from tradepath.registry import register
from tradepath.registry.sources import EVENT_SCHEMA, TABLE_VIEWS, contract_tables
from tradepath.sources import kafka
from tradepath.sources.workspace import fresh_path
from tradepath.streaming import bronze, progress, quarantine

KAFKA_SCHEMA = ("key binary, value binary, topic string, partition int, offset long, "
                "timestamp timestamp_ntz")


def _feed(m, rows, label):
    """Rows in the Kafka layout, written as files and read as a stream."""
    path = fresh_path(m.spark, label)
    rows.write.parquet(path)
    return m.spark.readStream.schema(KAFKA_SCHEMA).parquet(path)


def _run_events(m):
    base = fresh_path(m.spark, "events-stream")
    config = bronze.StreamConfig("events", EVENT_SCHEMA, f"{base}/bronze", f"{base}/checkpoint")
    log = progress.ProgressTable(m.spark, f"{base}/progress")
    query = bronze.run(_feed(m, m.kafka_rows, "events-feed"), config, once=True, log=log)
    return query, m.spark.read.parquet(config.output_path), log


@register("x01_stream_to_bronze", """
    SELECT k AS kafka_key, topic AS kafka_topic, part AS kafka_partition, off AS kafka_offset,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_timestamp, p_event_id AS event_id,
      p_user_id AS user_id, p_event_type AS event_type, round(p_value, 6) AS value,
      TRUE AS stamped FROM m_kafka""")
def _(m):
    _query, table, _log = _run_events(m)
    return table.select(
        "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset",
        F.date_format("kafka_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("kafka_timestamp"),
        "event_id", "user_id", "event_type", "value",
        F.col("bronze_ingested_at").isNotNull().alias("stamped"))


@register("s09_bronze_append_sink", """
    SELECT topic AS kafka_topic, part AS kafka_partition, count(*) AS n, min(off) AS first_offset,
      max(off) AS last_offset FROM m_kafka GROUP BY 1, 2""")
def _(m):
    _query, table, _log = _run_events(m)
    return table.groupBy("kafka_topic", "kafka_partition").agg(
        F.count(F.lit(1)).alias("n"), F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"))


@register("x03_stream_progress", """
    SELECT 'bronze_events' AS name, count(*) AS input_rows, FALSE AS active, 'stopped' AS ended
    FROM events""")
def _(m):
    query, _table, log = _run_events(m)
    seen = progress.latest(query)
    return log.read().agg(F.sum("input_rows").alias("input_rows"), F.max("ended").alias("ended")).select(
        F.lit(seen["name"]).alias("name"), "input_rows", F.lit(seen["active"]).alias("active"), "ended")


def _messages(df, table):
    """Rows as JSON messages with the columns of their contract as text."""
    contract = CONTRACTS[table]
    names = [c for c in contract.schema.names if c in df.columns]
    rows = kafka.encode(df.select(*[F.col(c).cast("string").alias(c) for c in names]), contract.key)
    return rows.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(table).alias("topic"), F.lit(0).alias("partition"),
        F.xxhash64("value").alias("offset"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"))


@register("x05_table_streams", " UNION ALL ".join(f"""
    SELECT '{t}' AS table_name, count(*) AS n, count(DISTINCT {CONTRACTS[t].key}) AS n_keys FROM {v}"""
    for t, v in TABLE_VIEWS.items()))
def _(m):
    """A stream for each of the nine contracts."""
    base = fresh_path(m.spark, "table-streams")
    out = None
    for table, rows in contract_tables(m).items():
        config = bronze.table_stream(table, base)
        bronze.run(_feed(m, _messages(rows, table), f"{table}-feed"), config, once=True)
        part = m.spark.read.parquet(config.output_path).agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n"),
            F.count_distinct(CONTRACTS[table].key).alias("n_keys"))
        out = part if out is None else out.unionByName(part)
    return out


def _checked_stream(m):
    base = fresh_path(m.spark, "checked-stream")
    rows = bronze.bronze_rows(_feed(m, m.kafka_rows, "checked-feed"), EVENT_SCHEMA)
    checks = [SchemaCheck(["event_id", "user_id"]), NullCheck(["event_id", "user_id"])]
    quarantine.start(rows, checks, f"{base}/rows", f"{base}/checkpoint", once=True).awaitTermination()
    return quarantine.read(m.spark, f"{base}/rows")


@register("x06_stream_quarantine", """
    SELECT 'valid' AS side, count(*) AS n, CAST(sum(off) AS BIGINT) AS offsets FROM m_kafka
    WHERE p_event_id IS NOT NULL UNION ALL
    SELECT 'null_validation', count(*), CAST(sum(off) AS BIGINT) FROM m_kafka
    WHERE p_event_id IS NULL""")
def _(m):
    valid, bad = _checked_stream(m)
    figures = [F.count(F.lit(1)).alias("n"), F.sum("kafka_offset").alias("offsets")]
    return valid.groupBy(F.lit("valid").alias("side")).agg(*figures).unionByName(
        bad.groupBy(F.array_join("_failed_checks", ",").alias("side")).agg(*figures))


@register("x06_stream_duplicates", """
    SELECT 'valid' AS side, count(*) AS n FROM m_kafka WHERE p_event_id IS NOT NULL
    UNION ALL SELECT 'null_validation', count(*) FILTER (WHERE off % 97 = 0)
      + count(*) FILTER (WHERE off % 970 = 0) FROM m_kafka
    UNION ALL SELECT 'duplicate_validation', count(*) FILTER (WHERE off % 10 = 0 AND off % 97 <> 0)
      + count(*) FILTER (WHERE off % 97 = 0) + count(*) FILTER (WHERE off % 970 = 0) - 1 FROM m_kafka""")
def _(m):
    """Every tenth event is sent again two batches later; broken events share the null key."""
    path = fresh_path(m.spark, "repeating-feed")
    for part in ("offset % 3 = 0", "offset % 3 <> 0", "offset % 10 = 0"):
        m.kafka_rows.where(part).coalesce(1).write.mode("append").parquet(path)
    feed = m.spark.readStream.schema(KAFKA_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    base = fresh_path(m.spark, "repeating-stream")
    checks = [NullCheck(["event_id"]), DuplicateCheck(["event_id"], full_row=False)]
    quarantine.start(
        bronze.bronze_rows(feed, EVENT_SCHEMA), checks, f"{base}/rows", f"{base}/checkpoint",
        [c.name for c in checks], once=True, at="kafka_timestamp", horizon="60 days",
    ).awaitTermination()
    valid, bad = quarantine.read(m.spark, f"{base}/rows")
    n = F.count(F.lit(1)).alias("n")
    return valid.groupBy(F.lit("valid").alias("side")).agg(n).unionByName(
        bad.select(F.explode("_failed_checks").alias("side")).groupBy("side").agg(n))
