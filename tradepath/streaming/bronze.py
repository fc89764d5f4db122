"""Streams from Kafka-shaped rows to Bronze files."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tradepath.contracts import CONTRACTS
from tradepath.sources.kafka import decode, kafka_options, project, read_kafka
from tradepath.streaming.progress import ProgressTable

TRIGGER = "10 seconds"


@dataclass(frozen=True)
class StreamConfig:
    """Everything a Bronze stream needs; checked on creation."""

    topic: str
    schema: StructType
    output_path: str
    checkpoint_path: str
    trigger: str = TRIGGER
    fmt: str = "parquet"

    def __post_init__(self):
        needed = ("topic", "schema", "output_path", "checkpoint_path")
        missing = [n for n in needed if getattr(self, n) is None or getattr(self, n) == ""]
        if missing:
            raise ValueError(f"missing stream settings: {', '.join(missing)}")
        if not self.schema.fields:
            raise ValueError("the stream schema needs at least one field")


def bronze_rows(rows: DataFrame, schema: StructType) -> DataFrame:
    return decode(project(rows), schema)


def start(rows: DataFrame, config: StreamConfig, once: bool = False) -> StreamingQuery:
    """Append decoded rows to the Bronze path. `once` drains the source and stops."""
    trigger = {"availableNow": True} if once else {"processingTime": config.trigger}
    return (
        bronze_rows(rows, config.schema).writeStream.format(config.fmt)
        .queryName(f"bronze_{config.topic}")
        .outputMode("append")
        .option("checkpointLocation", config.checkpoint_path)
        .trigger(**trigger)
        .start(config.output_path)
    )


def run(
    rows: DataFrame, config: StreamConfig, once: bool = False, log: ProgressTable | None = None,
    every: float = 10.0,
) -> StreamingQuery:
    """Start the stream and wait for it; on any error it is stopped and the topic named. With a
    log, its progress is written while it runs, `every` so many seconds, and when it ends."""
    query, how = None, "failed"
    try:
        query = start(rows, config, once)
        if log is None:
            query.awaitTermination()
        else:
            while not query.awaitTermination(every):
                log.record(query)
        how = "stopped"
        return query
    except KeyboardInterrupt:
        raise
    except Exception as error:
        raise RuntimeError(f"Bronze stream for topic '{config.topic}' failed") from error
    finally:
        if query is not None:
            if query.isActive:
                query.stop()
            if log is not None:
                log.record(query, how)


def stream_to_bronze(
    spark: SparkSession, config: StreamConfig, bootstrap: str, user: str = "", secret: str = "",
    progress_path: str = "",
) -> StreamingQuery:
    """From a Kafka topic to Bronze files, with a table of its progress if a path is given."""
    if not bootstrap:
        raise ValueError("missing stream settings: bootstrap")
    log = ProgressTable(spark, progress_path) if progress_path else None
    rows = read_kafka(spark, kafka_options(bootstrap, config.topic, user, secret))
    return run(rows, config, log=log)


def table_stream(table: str, base: str, topic: str = "", fmt: str = "parquet") -> StreamConfig:
    """The stream of one of the nine tables, below a base path."""
    contract = CONTRACTS[table]
    return StreamConfig(
        topic=topic or contract.topic,
        schema=contract.schema,
        output_path=f"{base}/bronze/{table}",
        checkpoint_path=f"{base}/checkpoints/{table}",
        fmt=fmt,
    )
