"""Figures per component over a table of runs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def component_metrics(runs: DataFrame) -> DataFrame:
    """Executions, successes, failures and duration in ms per component.

    `runs` has component_name, succeeded and duration_ms.
    """
    ms = F.col("duration_ms")
    return runs.groupBy("component_name").agg(
        F.count(F.lit(1)).alias("execution_count"),
        F.count_if("succeeded").alias("success_count"),
        F.count_if(~F.col("succeeded")).alias("failure_count"),
        F.round(F.coalesce(F.avg(ms), F.lit(0.0)), 3).alias("average_duration_ms"),
        F.round(F.coalesce(F.max(ms), F.lit(0.0)), 3).alias("maximum_duration_ms"),
        F.round(F.coalesce(F.min(ms), F.lit(0.0)), 3).alias("minimum_duration_ms"),
    )
