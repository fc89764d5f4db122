"""Kafka options, the projection of Kafka rows, and JSON payloads in both directions."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

METADATA = [
    "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
]


def login_module(user: str, secret: str) -> str:
    """SASL login line with quotes and backslashes escaped."""
    def quoted(value: str) -> str:
        body = value.replace("\\", "\\\\").replace('"', '\\"')
        return f'"{body}"'

    module = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return f"{module} required username={quoted(user)} password={quoted(secret)};"


def kafka_options(bootstrap: str, topic: str, user: str = "", secret: str = "") -> dict[str, str]:
    """Options of a Kafka stream source; with a user, over SASL_SSL."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if user:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": login_module(user, secret),
        }
    return options


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def project(rows: DataFrame) -> DataFrame:
    """Key and value as text, the other Kafka columns renamed."""
    return rows.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("kafka_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def decode(rows: DataFrame, schema: StructType) -> DataFrame:
    """Payload fields as columns, with the ingestion time. Broken JSON gives null fields."""
    payload = F.from_json("kafka_value", schema, {"mode": "PERMISSIVE"})
    return rows.withColumn("_payload", payload).select(
        *METADATA,
        F.current_timestamp().alias("bronze_ingested_at"),
        *[F.col(f"_payload.`{f.name}`").alias(f.name) for f in schema.fields],
    )


def encode(df: DataFrame, key: str | None = None, columns: Sequence[str] | None = None):
    """Rows as JSON with explicit nulls, keyed by the text of a column."""
    body = F.struct(*(columns or df.columns))
    return df.select(
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )


def write_kafka(rows: DataFrame, bootstrap: str, topic: str, **options) -> None:
    rows.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option(
        "topic", topic
    ).options(**options).save()
