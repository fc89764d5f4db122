"""Incremental loads by a stored high-water mark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tradepath.sources.workspace import _filesystem, materialise



class MarkedLoad:
    """Loads into a table of rows at or after a mark, the latest time loaded so far.

    The mark is a row of a small table, written after the rows: a load that dies between the two is
    run again with the old mark, and rows that it had written are known by their key. The target is
    never scanned for its latest time; it is read from the mark on only, to find rows of that
    very time or of a dead load. Rows below the mark, or without a time, are late: they are counted
    with the load and returned by `late`, for the caller to load or report.
    """

    def __init__(self, spark: SparkSession, name: str, target: str, marks: str, watermark: str,
                 key: Sequence[str]):
        self.spark, self.name, self.target, self.path = spark, name, target, marks
        self.watermark, self.key = watermark, list(key)

    def _there(self, path: str) -> bool:
        filesystem, place = _filesystem(self.spark, path)
        return filesystem.exists(place)

    def marks(self) -> DataFrame:
        """One row per finished load."""
        rows = self.spark.read.parquet(self.path)
        return rows.where(F.col("table_name") == self.name)

    def mark(self):
        """The load number and the mark of the last finished load; (0, None) before the first."""
        if not self._there(self.path):
            return 0, None
        row = self.marks().agg(F.max(F.struct("load", "mark")).alias("m")).first()["m"]
        return (row["load"], row["mark"]) if row else (0, None)

    def _value(self, rows: DataFrame, mark):
        """The mark as a literal of its column; times without a zone go by their text."""
        kind = rows.schema[self.watermark].dataType
        return F.lit(str(mark) if isinstance(kind, TimestampNTZType) else mark).cast(kind)

    def _above(self, rows: DataFrame, mark) -> DataFrame:
        if mark is None:
            return rows
        return rows.where(F.col(self.watermark) >= self._value(rows, mark))

    def new(self, source: DataFrame) -> DataFrame:
        """Source rows at or after the mark whose key the target lacks from there on; the latest
        of several with one key is the caller's matter."""
        _, mark = self.mark()
        rows = self._above(source, mark)
        if self._there(self.target):
            known = self._above(self.spark.read.schema(source.schema).parquet(self.target), mark)
            rows = rows.join(known.select(*self.key), self.key, "left_anti")
        return rows

    def late(self, source: DataFrame) -> DataFrame:
        """Source rows below the mark, or without a time, whose key the target lacks."""
        _, mark = self.mark()
        if mark is None:
            return source.limit(0)
        reached = F.col(self.watermark) >= self._value(source, mark)
        below = source.where(~F.coalesce(reached, F.lit(False)))
        if self._there(self.target):
            known = self.spark.read.schema(source.schema).parquet(self.target)
            below = below.join(known.select(*self.key), self.key, "left_anti")
        return below

    def run(self, source: DataFrame) -> DataFrame:
        """Append the new rows, then commit the mark; returns the rows of this load."""
        load, mark = self.mark()
        late = self.late(source).count()
        rows = materialise(self.new(source), "load")
        rows.write.mode("append").parquet(self.target)
        self._commit(load + 1, mark, rows, late)
        return rows

    def _commit(self, load: int, mark, rows: DataFrame, late: int) -> None:
        """The mark covers what a dead load had written: the latest time from the old mark on."""
        written = self._above(self.spark.read.schema(rows.schema).parquet(self.target), mark)
        latest = written.agg(F.max(self.watermark).alias("mark"))
        count = rows.count()
        latest.select(
            F.lit(self.name).alias("table_name"), F.lit(load).cast("long").alias("load"),
            F.lit(count).cast("long").alias("n_rows"), F.lit(late).cast("long").alias("late_rows"),
            F.col("mark") if mark is None
            else F.coalesce("mark", self._value(rows, mark)).alias("mark"),
            F.current_timestamp().alias("loaded_at"),
        ).coalesce(1).write.mode("append").parquet(self.path)
