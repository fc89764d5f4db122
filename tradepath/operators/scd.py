"""Versioned dimensions: histories from change feeds, incremental merge, point-in-time joins."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradepath.sources.buckets import BucketedTable
from tradepath.sources.workspace import materialise

START, END, CURRENT = "EffectiveStartDate", "EffectiveEndDate", "IsCurrent"
BEGINNING = "1900-01-01"
UNKNOWN_KEY = -1


def _marked(columns: Sequence[str]):
    """Each column behind a mark for null, so that a null in one place is not one in another."""
    return [x for c in columns for x in (F.col(c).isNull(), F.col(c))]


def hash_key(*columns: str):
    """Surrogate key of a business key: stable across loads, and no shuffle to assign. 64 bits,
    for dimensions; the key tests check that it is unique."""
    return F.xxhash64(*_marked(columns))


def wide_key(*columns: str):
    """A key of 256 bits for facts, whose rows are too many for 64."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


# Rows of a dense_keys bucket, about, unless the caller names the number of buckets.
BUCKET_ROWS = 1_000_000


def dense_keys(
    df: DataFrame, key: Sequence[str], name: str, buckets: int | None = None
) -> DataFrame:
    """Numbers 1..n over unique keys without sorting all rows in one task.

    Keys are hashed into buckets; the bucket counts give each bucket its offset, and rows
    are numbered inside their bucket. The number of buckets follows the number of rows, so a
    bucket stays small whatever the size.
    """
    if buckets is None:
        buckets = max(8, -(-df.count() // BUCKET_ROWS))
    placed = df.withColumn("_b", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    offsets = placed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).selectExpr(
        "_b",
        """coalesce(sum(_n) OVER (ORDER BY _b ROWS BETWEEN UNBOUNDED PRECEDING
           AND 1 PRECEDING), 0L) AS _offset""",
    )
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(*key))
    return (
        placed.join(offsets, "_b")
        .withColumn(name, F.col("_offset") + inside)
        .drop("_b", "_offset")
    )


def history(
    feed: DataFrame, key: Sequence[str], attributes: Sequence[str], at: str,
    from_beginning: bool = True,
) -> DataFrame:
    """Versions of each key: a row per change of the attributes, with its validity.

    Of observations at the same instant the highest attribute values count. `from_beginning` lets
    the first version of a key reach back before its first observation.

    Observations are combined before the shuffle, to one span (first and last instant) per key and
    attribute values. Where no two spans of a key touch, each is a version. These spans are
    written in the shared folder, and only the keys whose spans touch, because values come back
    or instants repeat or have none, are taken from the feed again, day by day.
    """
    key = list(key)
    spans = feed.groupBy(*key, *attributes).agg(
        F.min(at).alias("_at"), F.max(at).alias("_until"),
        F.count_if(F.col(at).isNull()).alias("_timeless"))
    order = Window.partitionBy(*key).orderBy("_at")
    touches = (F.col("_timeless") > 0) | (F.col("_at") <= F.lag("_until").over(order))
    # the day by day join meets no null key either
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    spans = materialise(_with_validity(
        spans.where(known).withColumn("_touches", F.coalesce(touches, F.lit(False))),
        key, from_beginning, ["_touches"], attributes), "spans")
    tangled = spans.where("_touches").select(*key)
    plain = spans.drop("_touches")
    if tangled.isEmpty():
        return plain
    tangled = tangled.distinct()
    by_day = _by_day(feed.join(tangled, key, "left_semi"), key, attributes, at)
    return plain.join(tangled, key, "left_anti").unionByName(
        _with_validity(by_day, key, from_beginning, [], attributes))


def _with_validity(
    changes: DataFrame, key: Sequence[str], from_beginning: bool, also: Sequence[str],
    attributes: Sequence[str],
) -> DataFrame:
    """Rows of key, attributes and _at, each valid until the next of its key."""
    order = Window.partitionBy(*key).orderBy("_at")
    start = F.col("_at")
    if from_beginning:
        first = F.lag("_at").over(order).isNull()
        start = F.when(first, F.lit(BEGINNING).cast(changes.schema["_at"].dataType)).otherwise(start)
    return changes.select(
        *key, *attributes, start.alias(START), F.lead("_at").over(order).alias(END), *also,
    ).withColumn(CURRENT, F.col(END).isNull())


def _by_day(
    feed: DataFrame, key: Sequence[str], attributes: Sequence[str], at: str
) -> DataFrame:
    """The observations that change a key's attributes.

    A key with very many observations is not sorted in one task: changes are found day by
    day, and the last observation of each earlier day is carried to the next one. Only the
    versions themselves, few per key, are ordered together.
    """
    seen = (
        feed.groupBy(*key, F.col(at).alias("_at"))
        .agg(F.max(F.struct(*attributes)).alias("_v"))
        .withColumn("_day", F.col("_at").cast("date"))
    )
    days = seen.groupBy(*key, "_day").agg(F.max_by("_v", "_at").alias("_last"))
    carried = days.select(
        *key, "_day",
        F.lag("_last").over(Window.partitionBy(*key).orderBy("_day")).alias("_carried"),
    )
    inside = F.lag("_v").over(Window.partitionBy(*key, "_day").orderBy("_at"))
    before = seen.withColumn("_inside", inside).join(carried, [*key, "_day"])
    changed = before.where(~F.col("_v").eqNullSafe(F.coalesce("_inside", "_carried")))
    return changed.select(*key, *[F.col(f"_v.{a}").alias(a) for a in attributes], "_at")


def merge(
    dim: DataFrame, feed: DataFrame, updates: DataFrame, key: Sequence[str],
    attributes: Sequence[str], at: str,
) -> DataFrame:
    """A dimension after new observations, any number per key and in any order of arrival.

    `feed` holds all observations so far, the updates among them (the append-only Bronze table).
    The versions of the keys that the updates touch are built anew from it, so late and repeated
    observations end up where they belong; all other keys stay as they are. The result is
    `history` over the whole feed, at the cost of the touched keys.
    """
    key = list(key)
    touched = updates.select(*key).distinct()
    rebuilt = history(feed.join(touched, key, "left_semi"), key, attributes, at)
    return dim.join(touched, key, "left_anti").unionByName(rebuilt, allowMissingColumns=True)


def merge_buckets(
    dim: BucketedTable, feed: BucketedTable, updates: DataFrame, attributes: Sequence[str], at: str,
) -> list[int]:
    """`merge` where the dimension and the feed are laid out by the same key: the updates are
    appended to the feed, and of both tables only the buckets that they touch are read and written.
    A load that died after its append may be run again: observations that the feed has already
    change nothing. Returns the touched buckets."""
    updates = materialise(updates.select(*feed.schema.names), "updates")
    feed.append(updates)
    touched = feed.touched(updates)
    if touched:
        merged = merge(dim.read(touched), feed.read(touched), updates, dim.key, attributes, at)
        dim.replace(merged)
    return touched


def as_of(
    fact: DataFrame, dim: DataFrame, on: dict[str, str], at: str, take: dict[str, str]
) -> DataFrame:
    """Columns of the version valid at the fact's time; rows without one keep nulls.

    `on` maps fact columns to dimension columns; `take` maps dimension columns to new names.
    The join is on the key, with the validity as a residual, so it shuffles by key and
    meets only the few versions of each key.
    """
    side = dim.select(
        *[F.col(d).alias(f"_k_{d}") for d in on.values()],
        F.col(START).alias("_from"), F.col(END).alias("_to"),
        *[F.col(c).alias(n) for c, n in take.items()],
    )
    match = (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    for f, d in on.items():
        match = match & (F.col(f) == F.col(f"_k_{d}"))
    return fact.join(side, match, "left").drop(
        "_from", "_to", *[f"_k_{d}" for d in on.values()]
    )
