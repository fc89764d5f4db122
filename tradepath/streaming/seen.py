"""Keys that a stream has seen, so that a repeated row is known batches later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.sources.workspace import _filesystem, materialise, remove


class SeenKeys:
    """State of one stream below a path that lives as long as its checkpoint.

    A row repeats if its key came earlier in its batch or, within the horizon, in an earlier batch;
    the first row of a key by time is not a repeat. Nulls are values like others; a row without a
    time counts as of the latest time in its batch.

    Each batch adds the keys it holds with their latest time; every COMPACT-th batch writes all live
    keys instead, and what lies before that is removed when a later batch runs. Keys older than the
    watermark, the latest time seen less the horizon, are left out there, so the state holds the keys
    of one horizon and of COMPACT batches. A batch that is run again reads earlier
    batches only and replaces what it wrote, so it gives the same rows.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], at: str, horizon: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.at = list(key), at
        self.horizon = F.expr(f"INTERVAL {horizon}")

    def _folders(self) -> dict[tuple[int, str], str]:
        filesystem, place = _filesystem(self.spark, self.path)
        if not filesystem.exists(place):
            return {}
        out = {}
        for f in filesystem.listStatus(place):
            kind, _, number = f.getPath().getName().partition("=")
            if number.isdigit():
                out[int(number), kind] = f"{self.path}/{kind}={number}"
        return out

    def _live(self, schema: T.StructType, batch_id: int) -> DataFrame:
        """The latest time of each key before a batch."""
        folders = {k: p for k, p in self._folders().items() if k[0] < batch_id}
        base = max((n for n, kind in folders if kind == "all"), default=-1)
        for (n, kind), path in folders.items():
            if n < base or (n == base and kind == "new"):
                remove(self.spark, path)
        live = [p for (n, kind), p in folders.items() if n > base or (n, kind) == (base, "all")]
        if not live:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*live).groupBy(*self.key).agg(
            F.max("_last").alias("_last"))

    def repeats(self, batch: DataFrame, batch_id: int, name: str = "_repeat") -> DataFrame:
        """The batch and a column that says whether a row repeats; the state is written."""
        kind = batch.schema[self.at].dataType
        rows = materialise(batch.withColumn("_row", F.monotonically_increasing_id()), "batch")
        latest = rows.agg(F.max(self.at).alias("t")).first()["t"]
        if latest is None:
            at = F.current_timestamp().cast(kind)
        else:
            text = str(latest) if isinstance(kind, T.TimestampNTZType) else latest
            at = F.coalesce(self.at, F.lit(text).cast(kind))
        schema = T.StructType([*(batch.schema[k] for k in self.key), T.StructField("_last", kind)])
        live = self._live(schema, batch_id)
        seen = live.select(*[F.col(k).alias(f"_k_{k}") for k in self.key],
                           F.col("_last").alias("_before"))
        same = F.lit(True)
        for k in self.key:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        keys = rows.groupBy(*self.key).agg(
            F.min(F.struct(at.alias("t"), "_row")).alias("_first"), F.max(at).alias("_last")
        ).join(seen, same, "left").drop(*[f"_k_{k}" for k in self.key])
        known = F.coalesce(F.col("_before") >= F.col("_first.t") - self.horizon, F.lit(False))
        # one row per key of the batch; it is read twice
        keys = materialise(keys.withColumn("_known", known), "keys")
        self._write(keys, live, schema, batch_id)
        first = keys.where("NOT _known").select(
            F.col("_first._row").alias("_one"), F.lit(False).alias(name))
        return rows.join(first, F.col("_row") == F.col("_one"), "left").select(
            *batch.columns, F.coalesce(name, F.lit(True)).alias(name))

    def _write(self, keys: DataFrame, live: DataFrame, schema: T.StructType, batch_id: int) -> None:
        new = keys.select(*self.key, F.greatest("_last", "_before").alias("_last"))
        if (batch_id + 1) % self.COMPACT:
            new.write.mode("overwrite").parquet(f"{self.path}/new={batch_id}")
            return
        whole = new.unionByName(live).groupBy(*self.key).agg(F.max("_last").alias("_last"))
        least = whole.agg(F.max("_last") - self.horizon).scalar()
        whole.where(F.col("_last") >= least).write.mode("overwrite").parquet(
            f"{self.path}/all={batch_id}")
