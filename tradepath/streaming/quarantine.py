"""Checks inside a stream: valid rows and rows that fail, side by side in one table."""

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradepath.operators.quality import QUARANTINE_ON, DuplicateCheck, NullCheck, flag_rows
from tradepath.streaming.seen import SeenKeys

VALID, HELD_BACK = "valid", "quarantine"


def start(
    rows: DataFrame,
    checks: Sequence[Any],
    path: str,
    checkpoint_path: str,
    quarantine_on: Sequence[str] = QUARANTINE_ON,
    once: bool = False,
    trigger: str = "10 seconds",
    at: str | None = None,
    horizon: str = "1 day",
) -> StreamingQuery:
    """Split each micro-batch by the checks, in one write partitioned by side and batch. A batch
    replaces its own partitions when it is run again, so a retry after a failure leaves no
    second copy.

    With a time column `at`, duplicate checks hold back the rows whose key (or whole row) came before
    in the batch or, within the horizon, in an earlier one; the keys seen are kept below the
    checkpoint. Checks that judge a whole table (duplicates without a time, a share of nulls)
    cannot judge a stream batch by batch and are refused."""
    repeated = []
    for check in checks:
        duplicates = isinstance(check, DuplicateCheck)
        whole = (duplicates and at is None) or (
            isinstance(check, NullCheck) and check.threshold_percent > 0)
        if whole and check.name in quarantine_on:
            raise ValueError(f"{check.name} judges a whole table, not a micro-batch of a stream")
        if duplicates and check.name in quarantine_on:
            key = [c for c in check.key or rows.columns if c in rows.columns]
            if key:
                repeated.append((check.name, SeenKeys(
                    rows.sparkSession, f"{checkpoint_path}/seen/{len(repeated)}", key, at, horizon)))
    local = [c for c in checks if not isinstance(c, DuplicateCheck)]

    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = flag_rows(batch, local, quarantine_on)
        for name, seen in repeated:
            flagged = seen.repeats(flagged, batch_id, "_repeat").withColumn(
                "_failed_checks", F.when(F.col("_repeat"), F.array_append("_failed_checks", F.lit(name)))
                .otherwise(F.col("_failed_checks"))).drop("_repeat")
        bad = F.size("_failed_checks") > 0
        flagged.withColumns({
            "side": F.when(bad, HELD_BACK).otherwise(VALID), "batch_id": F.lit(batch_id),
        }).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "side", "batch_id").parquet(path)

    how = {"availableNow": True} if once else {"processingTime": trigger}
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**how)
        .start()
    )


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows held back with the names of the checks they fail)."""
    table = spark.read.parquet(path)
    valid = table.where(F.col("side") == VALID).drop("side", "batch_id", "_failed_checks")
    return valid, table.where(F.col("side") == HELD_BACK).drop("side", "batch_id")
