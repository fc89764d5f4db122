"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard has REPLICAS points on a ring of 64-bit numbers; they follow from the shard's number
alone, so one more shard only adds points. A row's id is hashed onto the ring and goes to the shard
of the next point clockwise; if that shard is full, it continues to the next point of a shard that
is not. Rows come in the order of a hash of their id, size and text checksum. With slack c
a shard takes ceil((1 + c) n / shards) rows; with slack 0 the shards take n / shards rounded down or
up, so that counts differ by one at most whatever the ids are, also if one id is a third of all
rows.

Spark: the placing by turns has the same result as this: between two moments at which a shard
becomes full, a row's shard depends on its arc of the ring only. So the moments are all that has to
be found, at most one for each shard. They come from counts of rows by arc and by the leading
digits of the order (a table of fixed size), refined by further digits only where a shard fills,
until LEAF rows are left to be looked at one by one. Each row's shard then follows by itself. Texts
are read once and never shuffled.

Defined results: null text is empty; null ids share one place on the ring; rows that repeat id and
text are told apart by a row number, which of them goes where does not matter; an empty table gives
an empty result; other columns are not read by `assign` and are kept by `write_shards`.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradepath.llm.common import fresh, small_side, written
from tradepath.llm.symbols import mix

SHARDS = 8
REPLICAS = 64
SLACK = 0.0
#: rows that are looked at one by one, at most, where a shard becomes full
LEAF = 4096
_LONG = np.iinfo(np.int64)


class Ring(NamedTuple):
    points: np.ndarray  # sorted
    shards: np.ndarray  # of each point

    def owners(self, full: set[int]) -> np.ndarray:
        """The shard that takes the rows of each arc if some shards are full; -1 if all are."""
        size = len(self.points)
        twice = np.concatenate([self.shards, self.shards])
        at = np.where(np.isin(twice, sorted(full)), 2 * size, np.arange(2 * size))
        at = np.minimum.accumulate(at[::-1])[::-1][:size]
        return np.where(at < 2 * size, twice[np.minimum(at, 2 * size - 1)], -1)


class Plan(NamedTuple):
    """After the row (orders[i], rows[i]) the next phase begins; owners[i] holds in phase i."""

    orders: np.ndarray
    rows: np.ndarray
    owners: np.ndarray


def ring(shards: int = SHARDS, replicas: int = REPLICAS) -> Ring:
    numbers = (np.arange(shards, dtype=np.uint64)[:, None] << np.uint64(32)) | np.arange(
        replicas, dtype=np.uint64)[None, :]
    points = mix(mix(numbers + np.uint64(1))).astype(np.int64).ravel()
    order = np.argsort(points, kind="stable")
    return Ring(points[order], np.repeat(np.arange(shards), replicas)[order])


def capacities(n: int, shards: int, slack: float) -> np.ndarray:
    if slack:
        return np.full(shards, int(np.ceil((1 + slack) * n / shards)))
    return n // shards + (np.arange(shards) < n % shards)


def keyed(docs: DataFrame, circle: Ring, doc_id: str = "doc_id", text: str = "text",
          keep: bool = False) -> DataFrame:
    """A written table of doc_id, size, text_crc32, arc, turn (the order) and row (a number); and
    the row itself as a struct, if wanted."""
    points = circle.points

    @F.pandas_udf("int")
    def arc(place: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(points, place.to_numpy()) % len(points)).astype(np.int32))

    content = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(
        docs[doc_id].alias("doc_id"), (F.octet_length(content).cast("long") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        arc(F.xxhash64(docs[doc_id])).alias("arc"),
        *([F.struct(*(docs[c] for c in docs.columns)).alias("whole")] if keep else []))
    turn = F.xxhash64(F.lit("turn"), "doc_id", "size", "text_crc32")
    return written(rows.withColumn("turn", turn).withColumn(
        "row", F.monotonically_increasing_id()), "ring")


def _digit(level: int) -> Column:
    """The digit of a row's place in the order: eight of `turn`, then eight of `row`."""
    column, at = ("turn", level) if level < 8 else ("row", level - 8)
    digit = F.shiftrightunsigned(F.col(column), 56 - 8 * at).bitwiseAND(F.lit(255).cast("long"))
    return digit.bitwiseXOR(F.lit(128).cast("long")) if level == 0 else digit


def _inside(low: tuple[int, int], high: tuple[int, int]) -> Column:
    """Rows between two places of the order; ranges that pushed filters can use."""
    turn = F.col("turn").between(low[0], high[0])
    return turn & F.col("row").between(low[1], high[1]) if low[0] == high[0] else turn


def _span(low: tuple[int, int], high: tuple[int, int], level: int, digit: int):
    """The part of a span whose digit at this level is the given one."""
    width = 1 << (56 - 8 * (level % 8))
    if level < 8:
        start = low[0] + digit * width
        return (start, low[1]), (start + width - 1, high[1])
    start = low[1] + digit * width
    return (low[0], start), (low[0], start + width - 1)


def plan(keys: DataFrame, circle: Ring, limits: np.ndarray, leaf: int = LEAF) -> Plan:
    """When each shard becomes full, and who takes which arc from then on."""
    arcs = len(circle.points)
    full = {int(s) for s in np.flatnonzero(limits <= 0)}
    held = np.zeros(len(limits), np.int64)
    orders, rows, owners = [], [], [circle.owners(full)]

    def fill(at: tuple[int, int]) -> None:
        new = {int(s) for s in np.flatnonzero(held >= limits)} - full
        if new:
            full.update(new)
            orders.append(at[0])
            rows.append(at[1])
            owners.append(circle.owners(full))

    def one_by_one(low, high) -> None:
        part = keys.where(_inside(low, high)).select("turn", "row", "arc").toArrow()
        turn, row, arc = (part[c].to_numpy() for c in ("turn", "row", "arc"))
        for i in np.lexsort((row, turn)):
            held[owners[-1][arc[i]]] += 1
            fill((int(turn[i]), int(row[i])))

    def walk(low, high, level: int) -> None:
        """Counts of this span by digit and arc: 256 x arcs numbers at most."""
        counted = keys.where(_inside(low, high)).groupBy(
            _digit(level).alias("digit"), "arc").count().toArrow()
        table = np.zeros((256, arcs), np.int64)
        table[counted["digit"].to_numpy(), counted["arc"].to_numpy()] = counted["count"].to_numpy()
        for digit in np.flatnonzero(table.any(1)):
            begin, end = _span(low, high, level, int(digit))
            taken = owners[-1]
            wanted = np.bincount(taken[taken >= 0], table[digit][taken >= 0], len(limits)
                                 ).astype(np.int64)
            if (held + wanted <= limits).all():
                held[:] += wanted
                fill(end)
            elif table[digit].sum() <= leaf:
                one_by_one(begin, end)
            else:
                walk(begin, end, level + 1)

    walk((_LONG.min, 0), (_LONG.max, _LONG.max), 0)
    return Plan(np.array(orders, np.int64), np.array(rows, np.int64), np.stack(owners))


def _shard(found: Plan):
    @F.pandas_udf("int")
    def shard(turn: pd.Series, row: pd.Series, arc: pd.Series) -> pd.Series:
        turn, row = turn.to_numpy(), row.to_numpy()
        phase = np.zeros(len(turn), np.int64)
        for order, last in zip(found.orders, found.rows):
            phase += (turn > order) | ((turn == order) & (row > last))
        return pd.Series(found.owners[phase, arc.to_numpy()].astype(np.int32))

    return shard("turn", "row", "arc")


def _placed(docs, shards, replicas, slack, doc_id, text, leaf, keep=False) -> DataFrame:
    circle = ring(shards, replicas)
    keys = keyed(docs, circle, doc_id, text, keep)
    found = plan(keys, circle, capacities(keys.count(), shards, slack), leaf)
    return keys.withColumn("shard", _shard(found))


def assign(docs: DataFrame, shards: int = SHARDS, replicas: int = REPLICAS, slack: float = SLACK,
           doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """Rows doc_id, size, text_crc32, shard and slot, the place in the shard from 0."""
    placed = _placed(docs, shards, replicas, slack, doc_id, text, leaf).select(
        "doc_id", "size", "text_crc32", "shard", "row",
        F.shiftright("row", 33).alias("block"))  # a block: what one task wrote
    placed = placed.withColumn("place", F.row_number().over(
        Window.partitionBy("block", "shard").orderBy("row")) - 1)
    # the counts of the blocks are few; their running sums say where each block begins in a shard
    counts = placed.groupBy("block", "shard").agg(F.count("*").alias("n"))
    before = counts.select(
        F.col("block").alias("_b"), F.col("shard").alias("_s"),
        (F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("before"))
    placed = placed.join(
        small_side(before), (F.col("block") == F.col("_b")) & (F.col("shard") == F.col("_s")))
    return placed.select("doc_id", "size", "text_crc32", "shard",
                         (F.col("before") + F.col("place")).alias("slot"))


def digest(assigned: DataFrame) -> DataFrame:
    """The rows with the law that holds for them: the counts of the shards differ by one at most."""
    return assigned.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                           "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, replicas: int = REPLICAS,
                 slack: float = SLACK, doc_id: str = "doc_id", text: str = "text",
                 leaf: int = LEAF) -> None:
    """Write the rows as Parquet with all their columns, a folder for each shard."""
    folder = fresh("shard")
    placed = _placed(docs, shards, replicas, slack, doc_id, text, leaf, keep=True)
    placed.select("whole.*", F.col("shard").alias(folder)).withColumnRenamed(
        folder, "shard" if "shard" not in docs.columns else folder).write.partitionBy(
        "shard" if "shard" not in docs.columns else folder).parquet(path)
