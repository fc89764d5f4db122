"""Throughput and status of running streams as a table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

SCHEMA = """query_id string, name string, batch_id long, input_rows long,
    input_rows_per_second double, processed_rows_per_second double, ended string"""


def latest(query: StreamingQuery) -> dict:
    """Id, name, status and last rates of a query; rates are 0 before the first batch."""
    progress = query.lastProgress or {}
    rate = progress.get if isinstance(progress, dict) else lambda k, d: getattr(progress, k, d)
    return {
        "query_id": str(query.id),
        "name": query.name,
        "active": query.isActive,
        "status": query.status,
        "input_rows_per_second": float(rate("inputRowsPerSecond", 0.0)),
        "processed_rows_per_second": float(rate("processedRowsPerSecond", 0.0)),
    }


class ProgressTable:
    """Appends a row for each micro-batch of a query to a table, whenever it is asked to. It holds
    nothing but the number of the last batch written; Spark keeps the last batches until then."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.written = spark, path, -1

    def record(self, query: StreamingQuery, ended: str = "") -> None:
        rows = [
            (str(query.id), query.name, p["batchId"], p["numInputRows"],
             float(p["inputRowsPerSecond"]), float(p["processedRowsPerSecond"]), "")
            for p in query.recentProgress if p["batchId"] > self.written
        ]
        self.written = max([self.written, *(r[2] for r in rows)])
        if ended:
            rows.append((str(query.id), query.name, None, 0, 0.0, 0.0, ended))
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)
