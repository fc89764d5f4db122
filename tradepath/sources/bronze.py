"""Bronze tables: partitioned append, loading above a high-water mark, and upsert."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.operators.cleaning import latest_per_key

# Partition columns per table, as SQL over the table's own columns.
PARTITIONS = {
    "orders": {
        "order_purchase_year": "year(order_purchase_timestamp)",
        "order_purchase_month": "month(order_purchase_timestamp)",
    },
    "order_items": {"shipping_limit_year": "year(shipping_limit_date)"},
    "order_reviews": {"review_creation_year": "year(review_creation_date)"},
    "geolocation": {"geolocation_state": "geolocation_state"},
    "customers": {"customer_state": "customer_state"},
    "sellers": {"seller_state": "seller_state"},
}


def write_partitioned(
    df: DataFrame, table: str, path: str, fmt: str = "parquet", mode: str = "append"
) -> None:
    """Append a table in its partition layout.

    Rows are spread by the partition columns, so that a partition gets few files; the
    rebalance splits partitions that hold much of the table over several tasks.
    """
    columns = PARTITIONS[table]
    out = df.withColumns({name: F.expr(sql) for name, sql in columns.items()})
    out.hint("rebalance", *columns).write.format(fmt).mode(mode).partitionBy(*columns).save(path)


def above_watermark(source: DataFrame, target: DataFrame, watermark: str, key: Sequence[str]):
    """Source rows at or after the target's latest time whose key the target lacks. Rows of that
    very time are looked at again, for a load may have ended between two of them."""
    mark = target.agg(F.max(watermark)).scalar()
    newer = source.where(mark.isNull() | (F.col(watermark) >= mark))
    return newer.join(target.select(*key), list(key), "left_anti")


def below_watermark(source: DataFrame, target: DataFrame, watermark: str, key: Sequence[str]):
    """Late rows: earlier than the mark, or without a time, with a key that the target lacks.
    `above_watermark` leaves them out; they are here to be loaded or reported."""
    mark = target.agg(F.max(watermark)).scalar()
    older = source.where(mark.isNotNull() & ~F.coalesce(F.col(watermark) >= mark, F.lit(False)))
    return older.join(target.select(*key), list(key), "left_anti")


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str], order: Sequence[str]):
    """Target and updates with the latest row per key; an update wins a tie."""
    both = target.withColumn("_update", F.lit(0)).unionByName(
        updates.withColumn("_update", F.lit(1))
    )
    return latest_per_key(both, list(key), [*order, "_update"]).drop("_update")
