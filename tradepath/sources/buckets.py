"""A table in buckets of its key, of which a load reads and writes only those that it touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tradepath.sources.bronze import upsert
from tradepath.sources.workspace import _filesystem, materialise

BUCKET = "_bucket"


class BucketedTable:
    """Rows in folders by a hash of their key, so that a key's rows lie in one folder.

    `buckets` is fixed when the table is laid out; a bucket should hold about as much as a few tasks
    read (the driver holds one number for each touched bucket, no more). A bucket with a hot key is
    written as several files. Null keys are keys like others.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str],
                 buckets: int = 256):
        if BUCKET in schema.names:
            raise ValueError(f"{BUCKET} is the folders' column")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.buckets = list(key), buckets

    def _bucket(self) -> Column:
        marked = [x for c in self.key for x in (F.col(c).isNull(), F.col(c))]
        return F.pmod(F.xxhash64(*marked), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, mode: str) -> None:
        rows.select(*self.schema.names, self._bucket().alias(BUCKET)).hint(
            "rebalance", BUCKET).write.mode(mode).option(
            "partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of these rows."""
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or some of its buckets; the other folders are not read."""
        filesystem, place = _filesystem(self.spark, self.path)
        if not filesystem.exists(place):
            return self.spark.createDataFrame([], self.schema)
        whole = StructType([*self.schema.fields, StructField(BUCKET, IntegerType())])
        rows = self.spark.read.schema(whole).parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(list(buckets)))
        return rows.drop(BUCKET)

    def near(self, rows: DataFrame) -> DataFrame:
        """The table's rows in the buckets of these rows."""
        return self.read(self.touched(rows))

    def append(self, rows: DataFrame) -> None:
        self._write(rows, "append")

    def replace(self, rows: DataFrame) -> None:
        """Put these rows in place of all that their buckets hold. They are written aside first:
        they may come from the buckets themselves."""
        self._write(materialise(rows.select(*self.schema.names), "buckets"), "overwrite")

    def upsert(self, updates: DataFrame, order: Sequence[str]) -> list[int]:
        """The latest row per key, of those here and the updates (an update wins a tie). Only
        the touched buckets are read and written; returns them."""
        updates = updates.select(*self.schema.names)
        touched = self.touched(updates)
        if touched:
            self.replace(upsert(self.read(touched), updates, self.key, order))
        return touched
