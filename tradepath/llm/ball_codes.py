"""Vector codes by product quantisation with ball k-means.

Components become integers (floor of SCALE times the component); a vector is cut into PARTS equal
consecutive parts, each with a codebook of ENTRIES entries. A codebook starts as that part of the
vectors with the smallest ids; each of ROUNDS rounds gives every part to the nearest entry and puts
the rounded-down mean of its parts in place of each entry. All is integer arithmetic, so the result
does not depend on the order of rows.

Ball k-means: the parts of an entry are a ball around it. With x in the ball of entry c, another
entry e can be as near to x as c only if |c - e| <= 2 |x - c|. So the neighbours of a ball are
the entries within twice its radius; a part whose ring reaches no neighbour is in the stable core
and keeps its entry without any comparison; every other part is compared exactly with the neighbours
within its own ring only. Ties go to the lower entry. Balls come from the entries of the round
before; at first all parts are in the ball of entry 0. A task takes the balls of one Arrow batch.

Spark: each round is one pass that writes the integers with the new entries (the table of the round
before is removed) and one that sums by part and entry: within a task first, then in a shuffle of
PARTS x ENTRIES x part length rows for a task. Only codebooks, whose size is fixed, meet on the driver.

Defined results: rows whose vector is null or holds null or non-finite components are dropped, as
are those whose length is not the most frequent one that PARTS divides (ties: the shorter); the
integers end at 2 ** 22 either way; null ids are the largest; ties of ids go by the vector; with
fewer vectors than entries the codebooks are smaller; equal rows get equal results; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.llm.common import fresh_path, remove, small_side, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LIMIT = 1 << 22
_RESULT = "vec_id {}, code string, error long, label_error long, codebooks_sha256 string"


def nearest(x: np.ndarray, at: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each row of x and its squared distance, from the balls `at`; and how
    many distances to other entries that took. All numbers are integers, held exactly in
    doubles."""
    gaps = ((entries[:, None] - entries[None]) ** 2).sum(-1)
    near = np.argsort(gaps, axis=1, kind="stable")
    ranked = np.take_along_axis(gaps, near, 1)
    own = ((x - entries[at]) ** 2).sum(-1)
    best, least, compared = at.copy(), own.copy(), 0
    order = np.argsort(at, kind="stable")
    balls = np.flatnonzero(np.diff(at[order], prepend=-1))
    for begin, end in zip(balls, np.append(balls[1:], len(order))):
        ball = order[begin:end]
        c = at[ball[0]]
        neighbours = near[c][:np.searchsorted(ranked[c], 4 * own[ball].max(), "right")]
        if len(neighbours) == 1:
            continue
        ring = np.searchsorted(ranked[c][:len(neighbours)], 4 * own[ball], "right")
        width = 2
        while width < 2 * len(neighbours):  # rings of like width together
            some = np.flatnonzero((ring > width // 2) & (ring <= width))
            if len(some):
                rows, some = ball[some], ring[some]
                tried = neighbours[:width]
                far = ((x[rows, None] - entries[tried]) ** 2).sum(-1)
                far[np.arange(len(tried)) >= some[:, None]] = np.inf
                compared += int(some.sum()) - len(some)
                lowest = far.min(1)
                number = np.where(far == lowest[:, None], tried, len(entries)).min(1)
                best[rows], least[rows] = number, lowest
            width *= 2
    return best, least, compared


def _integers(column) -> np.ndarray:
    """Rows of integers, as doubles, from an Arrow column of vectors of one length or of bytes."""
    if pa.types.is_binary(column.type):
        raw = column.to_pylist()
        return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), -1).astype(float)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.clip(np.floor(SCALE * values), -LIMIT, LIMIT).reshape(len(column), -1)


def _codes(column, rows: int, parts: int) -> np.ndarray:
    if column is None:
        return np.zeros((rows, parts), np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(rows, parts).astype(np.int64)


def _assigned(batch, books: np.ndarray):
    """Integers, new entries and squared distances of a batch (vec_id, label, vector or bytes, and
    the entries of the round before if there was one)."""
    parts = len(books)
    x = _integers(batch.column(2))
    at = _codes(batch.column(3) if batch.num_columns > 3 else None, batch.num_rows, parts)
    cut = x.reshape(len(x), parts, -1)
    far = np.zeros(len(x))
    for m in range(parts):
        at[:, m], least, _ = nearest(cut[:, m], at[:, m], books[m])
        far += least
    return x, at, far


def _round(books: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, at, _ = _assigned(batch, books)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1),
                     pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary()),
                     pa.array([r.tobytes() for r in at.astype(np.uint8)], pa.binary())],
                    names=["vec_id", "label", "vector", "codes"])

    return run


def _last(books: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                _, at, far = _assigned(batch, books)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1),
                     pa.array([r.tobytes().hex() for r in at.astype(np.uint8)]),
                     pa.array(far.astype(np.int64))], names=["vec_id", "label", "code", "error"])

    return run


def _sums(parts: int, entries: int):
    def run(batches):
        total = count = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch.column(0))
            at = _codes(batch.column(1), batch.num_rows, parts)
            cut = x.reshape(len(x), parts, -1)
            if total is None:
                total = np.zeros((parts, entries, cut.shape[2]), np.int64)
                count = np.zeros((parts, entries), np.int64)
            for m in range(parts):
                count[m] += np.bincount(at[:, m], minlength=entries)
                for k in range(cut.shape[2]):
                    total[m, :, k] += np.bincount(
                        at[:, m], cut[:, m, k], entries).astype(np.int64)
        if total is not None:
            m, e, k = (a.ravel() for a in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()) for a in (m, e, k, total.ravel(), count[m, e])],
                names=["part", "entry", "place", "total", "n"])

    return run


def _means(assigned: DataFrame, books: np.ndarray) -> np.ndarray:
    found = assigned.select("vector", "codes").mapInArrow(
        _sums(*books.shape[:2]), "part long, entry long, place long, total long, n long"
    ).groupBy("part", "entry", "place").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")).where("n > 0").toArrow()
    m, e, k, total, n = (found[c].to_numpy() for c in ("part", "entry", "place", "total", "n"))
    new = books.copy()
    new[m, e, k] = total // n
    return new


def kept(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label", parts: int = PARTS) -> DataFrame:
    """Rows vec_id, label, vector that can be coded."""
    bad = F.exists(vectors[vector], lambda x: x.isNull() | F.isnan(x) | (
        F.abs(x) == float("inf")))
    rows = vectors.where(vectors[vector].isNotNull() & ~bad).select(
        vectors[vec_id].alias("vec_id"), vectors[label].alias("label"),
        vectors[vector].alias("vector"))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().where(
        (F.col("n") > 0) & (F.col("n") % parts == 0))
    common = lengths.orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (common["n"] if common else 0)) if common else rows.limit(0)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
          ) -> tuple[np.ndarray, DataFrame, str | None]:
    """Codebooks (part, entry, place), the rows with the entries of the last round, and the path
    of the table they are in."""
    spark = rows.sparkSession
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select(
        "vector").toArrow()["vector"].combine_chunks()
    books = _integers(first).reshape(len(first), parts, -1).swapaxes(0, 1).astype(np.int64)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    state, path = rows.select("vec_id", "label", "vector"), None
    for _ in range(rounds):
        before, path = path, fresh_path(spark, "codes")
        state = state.mapInArrow(_round(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, "
                                 "vector binary, codes binary")
        state.write.option("compression", "zstd").parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        if before:
            remove(spark, before)
        books = _means(state, books)
    return books, state, path


def checksum(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
           ) -> DataFrame:
    """Rows vec_id, code, error, label_error and codebooks_sha256."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's number is one byte: 1 to 256 entries")
    spark = vectors.sparkSession
    rows = kept(vectors, vec_id, vector, label, parts)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    if rows.isEmpty():
        return spark.createDataFrame([], _RESULT.format(kinds["vec_id"]))
    books, state, path = train(rows, parts, entries, rounds)
    coded = written(state.mapInArrow(
        _last(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"),
        "coded")
    if path:
        remove(spark, path)
    sums = small_side(coded.groupBy(F.col("label").alias("_label")).agg(
        F.sum("error").alias("label_error")))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error",
        F.lit(checksum(books)).alias("codebooks_sha256"))


#: The same in SQL: all distances instead of balls.
CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, m, v[m * (len(v) // {PARTS}) + 1:(m + 1) * (len(v) // {PARTS})] AS x
  FROM kept, range({PARTS}) AS t(m)),
book0 AS MATERIALIZED (SELECT m, r - 1 AS e, x AS c FROM parts WHERE r <= {ENTRIES}),
{{rounds}}
final AS (SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY m) AS code,
                 CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
          FROM at{ROUNDS} GROUP BY r),
numbers AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY m, e)) AS h
            FROM book{ROUNDS})
SELECT k.vec_id, f.code, f.error,
       CAST(sum(f.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       n.h AS codebooks_sha256
FROM kept k JOIN final f ON k.r = f.r, numbers n
"""
_AT = f"""at{{n}} AS MATERIALIZED (
  SELECT p.r, p.m, min(CAST(list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
                       AS BIGINT) * {ENTRIES} + b.e) AS best
  FROM parts p JOIN book{{n}} b ON p.m = b.m GROUP BY p.r, p.m)"""
_BOOK = f"""sums{{after}} AS (
  SELECT m, e, list(CAST(floor(total / n) AS BIGINT) ORDER BY k) AS c FROM (
    SELECT m, e, k, sum(y)::DOUBLE AS total, count(*) AS n FROM (
      SELECT p.m, a.best % {ENTRIES} AS e, unnest(p.x) AS y, unnest(range(len(p.x))) AS k
      FROM parts p JOIN at{{n}} a ON p.r = a.r AND p.m = a.m) GROUP BY m, e, k) GROUP BY m, e),
book{{after}} AS MATERIALIZED (
  SELECT b.m, b.e, coalesce(s.c, b.c) AS c
  FROM book{{n}} b LEFT JOIN sums{{after}} s ON b.m = s.m AND b.e = s.e)"""
CODES_SQL = CODES_SQL.replace("{rounds}", ",\n".join(
    [_AT.replace("{n}", str(n)) + ",\n" + _BOOK.replace("{n}", str(n)).replace("{after}", str(n + 1))
     for n in range(ROUNDS)] + [_AT.replace("{n}", str(ROUNDS)) + ","]))
