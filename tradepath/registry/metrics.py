"""Run metrics (M1; M2 is with the sources)."""

from pyspark.sql import functions as F

from tradepath.plans.run_log import component_metrics
from tradepath.registry import register
from tradepath.registry.silver import r


@register("m01_component_metrics", f"""
    SELECT event_type AS component_name, count(*) AS execution_count,
      count(*) FILTER (WHERE event_id % 7 <> 0) AS success_count,
      count(*) FILTER (WHERE event_id % 7 = 0) AS failure_count,
      {r('avg(value)', 3)} AS average_duration_ms, {r('max(value)', 3)} AS maximum_duration_ms,
      {r('min(value)', 3)} AS minimum_duration_ms FROM events GROUP BY 1""", digits=3)
def _(m):
    return component_metrics(m.raw("events").select(
        F.col("event_type").alias("component_name"),
        (F.col("event_id") % 7 != 0).alias("succeeded"), F.col("value").alias("duration_ms")))
