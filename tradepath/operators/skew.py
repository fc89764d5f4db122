"""Left joins that deal out only the keys that hold much of the right side.

Adaptive execution splits a skewed partition of the left side of a left join, never one of the right
side. So keys that alone would make a partition which it calls skewed are found first, by a
frequency sketch over the key column (one row per task, no shuffle), and dealt over salts: a right
row goes to one salt, the left rows of such a key are repeated for each. All other keys
join as ever, each table is read once by the join, and which keys are dealt never changes the result.
"""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Items that the sketch holds, and hot keys at most; a key beyond them has under a thousandth of the
#: rows.
TRACKED = 10_000
MOST = 1_000
#: How much larger rows are in a shuffle than in compressed files, at most.
INFLATION = 8
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes(spark: SparkSession, setting: str, default: int) -> int:
    text = str(spark.conf.get(f"spark.sql.adaptive.{setting}")).strip().lower()
    found = re.fullmatch(r"(\d+)\s*([bkmgt]?)(?:i?b)?", text)
    return int(found[1]) * _UNITS[found[2]] if found else default


def _width(df: DataFrame) -> int:
    """About how many bytes a row takes in a shuffle."""
    def size(kind):
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return 24
        if isinstance(kind, T.DecimalType) and kind.precision > 18:
            return 24
        return 8

    return 16 + sum(size(f.dataType) for f in df.schema)


def hot_keys(df: DataFrame, key: str) -> list[tuple]:
    """(key, salts) of the keys that alone make a skewed partition, by Spark's own settings."""
    spark = df.sparkSession
    least = _bytes(spark, "skewJoin.skewedPartitionThresholdInBytes", 256 << 20)
    plan = df._jdf.queryExecution().optimizedPlan()
    if int(str(plan.stats().sizeInBytes())) * INFLATION < least:
        return []  # not even the whole table would make such a partition
    found = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {MOST}, {TRACKED})").alias("top"),
        F.count(F.lit(1)).alias("n")).first()
    factor = float(spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor"))
    common = found["n"] / int(spark.conf.get("spark.sql.shuffle.partitions")) * factor
    part = max(1, _bytes(spark, "advisoryPartitionSizeInBytes", 64 << 20))
    width = _width(df)
    return [(r["item"], ceil(r["count"] * width / part)) for r in found["top"] or []
            if r["count"] * width >= least and r["count"] >= common]


def left_join(left: DataFrame, right: DataFrame, key: str, hot: list[tuple]) -> DataFrame:
    """left.join(right, key, "left") with the hot keys dealt over their salts."""
    if not hot:
        return left.join(right, key, "left")
    kind = right.schema[key].dataType
    # at most MOST rows
    salts = F.broadcast(left.sparkSession.createDataFrame(
        hot, T.StructType([T.StructField(key, kind), T.StructField("_salts", T.IntegerType())])))
    number = F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in right.columns]), F.col("_salts")).cast("int"))
    dealt = right.join(salts, key, "left").withColumn("_salt", number).drop("_salts").withColumn(
        "_there", F.lit(True))
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    rows = left.join(salts, key, "left").withColumn("_salt", every).join(
        dealt, [key, "_salt"], "left")
    # a hot key has rows, so a salt of it without one stands for nothing
    return rows.where("_salts IS NULL OR _there").drop("_salt", "_salts", "_there")
