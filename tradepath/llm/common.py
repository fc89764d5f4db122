"""Helpers that the operators of this folder share."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.sources.workspace import fresh_path, remove, shared_folder  # noqa: F401

WORD = r"[\p{L}\p{N}]+"
#: Bytes up to which a side may be broadcast; above it the join is shuffled.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; a null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def _size(column: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType) and not isinstance(
            kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType)):
        return F.greatest(F.size(column), F.lit(0)) * 16 + 24
    if isinstance(kind, T.StructType):
        parts = [_size(column[f.name], f.dataType) for f in kind.fields]
        return reduce(lambda a, b: a + b, parts, F.lit(16))
    return F.lit(16) if isinstance(kind, T.AtomicType) else F.length(F.to_json(column)) * 4


def small_side(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The frame with a broadcast hint if its bytes have been counted and are few, else as it is."""
    limit = BROADCAST_BYTES if limit is None else limit
    sizes = [_size(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]
    size = df.agg(F.sum(reduce(lambda a, b: a + b, sizes, F.lit(16)).cast("long"))).first()[0]
    return F.broadcast(df) if (size or 0) <= limit else df


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the folder that the cluster shares."""
    folder = shared_folder(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()


def written(df: DataFrame, label: str, made: list[str] | None = None) -> DataFrame:
    """Cut the lineage with a compressed table in the shared folder, for wide or many rows. Its
    path is added to `made`, for the caller to remove once nothing reads it."""
    path = fresh_path(df.sparkSession, label)
    if made is not None:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(label: str) -> str:
    """A name that no column of the caller's has."""
    return f"_{label}_{uuid.uuid4().hex[:8]}"


def row_key(doc_id: str, text: str) -> Column:
    """What a row is known by: its id and its text. Null ids come last and are kept apart by text."""
    return F.struct(F.col(doc_id).isNull().alias("no"), F.col(doc_id).alias("id"),
                    F.xxhash64(text).alias("h"))


def in_rows(docs: DataFrame, rows: DataFrame, key: str, doc_id: str, text: str, how: str
            ) -> DataFrame:
    """docs left_semi or left_anti joined with the rows that the row keys in `key` name; docs'
    columns stay."""
    of, h = fresh("id"), fresh("hash")
    rows = small_side(rows.select(F.col(f"{key}.id").alias(of), F.col(f"{key}.h").alias(h)).distinct())
    return docs.join(
        rows, docs[doc_id].eqNullSafe(rows[of]) & (F.xxhash64(docs[text]) == rows[h]), how)


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs with only the rows whose id is in ids (nulls equal nulls); docs' columns stay."""
    key = fresh("id")
    kept = small_side(ids.select(F.col(id_col).alias(key)).distinct())
    return docs.join(kept, docs[id_col].eqNullSafe(kept[key]), "left_semi")


def whole_groups(batches, keys: int):
    """Arrow tables from batches that are sorted by their first `keys` columns, each with complete
    groups only; the rows of the group that may go on wait for the next batch."""
    import pyarrow as pa

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        seen = pa.Table.from_batches([batch])
        if rest is not None:
            seen = pa.concat_tables([rest, seen])
        starts = group_starts(seen, keys)
        at = int(starts[-1])
        if at:
            yield seen.slice(0, at)
        rest = seen.slice(at)
    if rest is not None:
        yield rest


def group_starts(sorted_rows, keys: int):
    """Where the groups of a sorted Arrow table begin (keys without nulls)."""
    import numpy as np

    new = np.zeros(sorted_rows.num_rows, bool)
    new[:1] = True
    for i in range(keys):
        column = sorted_rows.column(i).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)
