"""Fills, deduplication and filters used on the way to Silver."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.operators.profile import melt
from tradepath.operators.quantiles import distribution, medians


def fill_with_medians(
    df: DataFrame, columns: Sequence[str], copies: str | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Nulls replaced by the column's median, all medians from one pass over `source`."""
    keep = [copies] if copies else []
    numbers = (source or df).select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    cells = melt(numbers, columns, keep=keep)
    per_column = distribution(cells, "value", ["column"], {"m": 0.5}, copies)
    found = per_column.agg(F.map_from_entries(F.collect_list(F.struct("column", "m")))).scalar()
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.try_element_at(found, F.lit(c))) for c in columns
    })


def fill_with_group_median(
    df: DataFrame, columns: Sequence[str], group: str, copies: str | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Nulls replaced by the median of the row's group; a group without values stays null.

    Medians are those of `source`, by default the frame itself.

    The medians are one row per group and come from a histogram, so a group that
    holds much of the table costs no more than its distinct values.
    """
    keep = [group, copies] if copies else [group]
    numbers = (source or df).select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    cells = melt(numbers, columns, keep=keep)
    wide = (
        distribution(cells, "value", [group, "column"], {"m": 0.5}, copies)
        .groupBy(group)
        .agg(*[F.max(F.when(F.col("column") == c, F.col("m"))).alias(f"_m_{c}") for c in columns])
    )
    return (
        df.join(wide, group, "left")
        .withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")) for c in columns})
        .drop(*[f"_m_{c}" for c in columns])
    )


def fill_from(df: DataFrame, sources: Mapping[str, str]) -> DataFrame:
    """Nulls of each column replaced by another column of the same row."""
    return df.withColumns({c: F.coalesce(F.col(c), F.col(s)) for c, s in sources.items()})


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest `order` values per key.

    An aggregate, not a row_number window: copies of a hot key are reduced before
    the shuffle and never meet in one sort. `order` must be unique within a key.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, "_best.*").select(*df.columns)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the lowest `order` values per key."""
    rest = [c for c in df.columns if c not in key and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, "_best.*").select(*df.columns)


def sample_rows(df: DataFrame, n: int, seed: int) -> DataFrame:
    """n random rows; each task keeps its n smallest draws."""
    return df.orderBy(F.rand(seed)).limit(n)


def cast_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to zone-less timestamps; text that does not parse becomes null."""
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in columns})


def inside_box(lat: str, lng: str, lat_range, lng_range):
    return F.col(lat).between(*lat_range) & F.col(lng).between(*lng_range)


def median_value(df: DataFrame, column: str):
    """The median as a value usable in any expression."""
    return medians(df, column, name="m").scalar()
