"""Table profiles: nulls, duplicates, cardinality, summaries, correlation, value counts."""

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepath.operators.quantiles import distribution


def shape(df: DataFrame) -> DataFrame:
    """Row count, column count, and each column with its type."""
    schema = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
        for f in df.schema
    ])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), schema.alias("columns")
    )


def melt(df: DataFrame, columns: Sequence[str], name="column", value="value", keep=()):
    """One row per (row, column). All columns must share a type."""
    cells = ", ".join(f"'{c}', `{c}`" for c in columns)
    return df.selectExpr(*keep, f"stack({len(columns)}, {cells}) AS (`{name}`, `{value}`)")


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return melt(counts, df.columns, "column", "null_count")


def row_copies(df: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows, later copies, and rows that have a copy; nulls compare equal."""
    key = list(key or df.columns)
    copies = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_later_copies"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("n_with_copy"),
    )


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    The exact form turns columns into rows first, so that one aggregation keyed by
    (column, value) does the work; several distinct counts side by side would
    multiply every row by the number of columns in a single group.
    """
    if approximate:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return melt(counts, columns, "column", "n_distinct")
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    values = melt(text, columns).where(F.col("value").isNotNull()).distinct()
    present = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    return present


class SketchStore:
    """Distinct counts of a growing table: a HyperLogLog sketch per load and column is stored (a few
    kilobytes, from one pass without a shuffle of values), and any set of loads is counted by
    merging theirs. Loads may overlap; a load that is added again replaces itself."""

    def __init__(self, spark: SparkSession, path: str, bits: int = 14):
        self.spark, self.path, self.bits = spark, path, bits

    def add(self, df: DataFrame, columns: Sequence[str], load: str) -> None:
        sketches = df.agg(*[F.hll_sketch_agg(F.col(c).cast("string"), self.bits).alias(c)
                            for c in columns])
        melt(sketches, columns, "column", "sketch").withColumn("load", F.lit(load)).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "load").parquet(self.path)

    def cardinality(self, loads: Sequence[str] | None = None) -> DataFrame:
        """Distinct non-null values per column over some loads, or all."""
        rows = self.spark.read.schema("column string, sketch binary, load string").parquet(self.path)
        if loads is not None:
            rows = rows.where(F.col("load").isin(list(loads)))
        return rows.groupBy("column").agg(
            F.count(F.lit(1)).alias("loads"),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return distribution(
        melt(numbers, columns), "value", ["column"], {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )


def span(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation per pair, over rows where both are present, in one pass."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = list(combinations_with_replacement(columns, 2))
    row = numbers.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{p}|{q}`").alias("r"))
        for p, q in pairs
        for a, b in ({(p, q), (q, p)})
    ]
    return row.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


def value_counts(
    df: DataFrame, columns: Sequence[str], share: str | None = None, copies: str | None = None
) -> DataFrame:
    """Rows per value, nulls left out; `share` adds each value's part of the total.

    The total is a sum over the counts, whose exchange Spark reuses.
    """
    kept = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))
    weight = F.sum(copies) if copies else F.count(F.lit(1))
    counts = kept.groupBy(*columns).agg(weight.alias("n"))
    if share is None:
        return counts
    return counts.withColumn(share, F.col("n") / counts.agg(F.sum("n")).scalar())
