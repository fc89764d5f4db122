"""Joins by intent. Sides are broadcast only by Spark's own size estimate."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.operators.quantiles import medians


def left_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on differently named keys; the right key is dropped."""
    return left.join(right, F.col(left_key) == F.col(right_key), "left").drop(right_key)


def with_group_count(df: DataFrame, key: Sequence[str], name: str, column: str | None = None):
    """Every row with the number of rows, or non-null values, of its group.

    An aggregate joined back, so that a group with much of the table is counted before
    the shuffle and never sits in one window.
    """
    n = F.count(column) if column else F.count(F.lit(1))
    return df.join(df.groupBy(*key).agg(n.alias(name)), list(key))


def with_group_median(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Every row with the median of its group."""
    return df.join(medians(df, value, [key], name), key, "left")


def matching(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    return left.join(right.select(*key), list(key), "left_semi")


def missing(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    return left.join(right.select(*key), list(key), "left_anti")
