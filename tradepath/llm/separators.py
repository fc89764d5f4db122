"""Token counts by a separator scan of flat token streams.

A token file is a stream of fixed-width numbers in blocks; documents end with a separator number,
and nothing says where. Each block is searched for separators by itself, as an array; its places
and its number of tokens are all that is kept. Two prefix scans along each file stitch the blocks:
sums give each block's first place and first document, a running maximum the last separator
before it, so a document that began blocks ago gets its whole length. A file's scan has two
levels (sums of SUPER blocks, then of what is before them), so a file of any length is scanned in
pieces of SUPER rows and one row for each piece.

The documents' own stream is written as blocks of BLOCK tokens, a file for each scan partition, in
the shared folder, and removed once it has been searched. A text that spells out the separator is
ordinary text there.

Defined results: a null or empty text has 0 tokens; tokens behind a file's last separator are a
document that is not `closed`; a block without a separator and a file without tokens add none;
every row is counted, also one that repeats another, and null ids stay null; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.llm.common import cut, remove
from tradepath.llm.packing import VOCABULARY, encoder
from tradepath.sources.workspace import fresh_path

SEPARATOR = 50256
BLOCK = 1 << 16
SUPER = 1024
DTYPE = "<u2"


def write_stream(docs: DataFrame, path: str, separator: int = SEPARATOR, block: int = BLOCK,
                 dtype: str = DTYPE, vocabulary: str = VOCABULARY, doc_id: str = "doc_id",
                 text: str = "text") -> None:
    """Rows file, at, tokens (block `at` of a file), and rows file, at, id without tokens: which
    document was written as number `at`."""
    schema = T.StructType([
        T.StructField("file", T.LongType()), T.StructField("at", T.LongType()),
        T.StructField("tokens", T.BinaryType()),
        T.StructField("id", docs.schema[doc_id].dataType)])

    def run(batches):
        encode = encoder(vocabulary, True)
        file, blocks, number = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0

        def rows(at, tokens, ids):
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.int64()), pa.array(at, pa.int64()),
                 pa.array(tokens, pa.binary()), ids], names=schema.names)

        for batch in batches:
            kind, out = batch.column(0).type, []
            for value in batch.column(1):
                held.append(np.append(encode(value.as_py() or ""), separator).astype(dtype))
                size += len(held[-1])
                if size >= block:
                    flat = np.concatenate(held)
                    full = size // block
                    out += [flat[i * block:(i + 1) * block].tobytes() for i in range(full)]
                    held, size = [flat[full * block:]], size - full * block
            n = batch.num_rows
            yield rows(range(number, number + n), [None] * n, batch.column(0))
            yield rows(range(blocks, blocks + len(out)), out, pa.nulls(len(out), kind))
            number, blocks = number + n, blocks + len(out)
        if size:
            yield rows([blocks], [np.concatenate(held).tobytes()], pa.nulls(1, kind))

    docs.select(doc_id, text).mapInArrow(run, schema).write.option(
        "compression", "zstd").parquet(path)


def find_separators(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = DTYPE) -> DataFrame:
    """Rows file, at, n_tokens, places (of separators in the block) from rows file, at, tokens."""
    def run(batches):
        for batch in batches:
            ids = [np.frombuffer(v.as_py(), dtype) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([np.flatnonzero(x == separator) for x in ids], pa.list_(pa.int64()))],
                names=["file", "at", "n_tokens", "places"])

    return blocks.select("file", "at", "tokens").mapInArrow(
        run, "file long, at long, n_tokens long, places array<long>")


def _before(rows: DataFrame, columns: dict) -> DataFrame:
    """rows with, for each column, what the blocks before have in all: {name: (aggregate, value)}."""
    piece = F.floor(F.col("at") / SUPER)
    rows = rows.withColumn("_piece", piece)
    near = W.partitionBy("file", "_piece").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    far = W.partitionBy("_f").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    pieces = rows.groupBy(F.col("file").alias("_f"), F.col("_piece").alias("_p")).agg(
        *(f(value).alias(f"_{name}") for name, (f, value) in columns.items()))
    pieces = pieces.select("_f", "_p", *(
        f(f"_{name}").over(far).alias(f"_{name}") for name, (f, _) in columns.items()))
    rows = rows.select("*", *(f(value).over(near).alias(f"_near_{name}")
                              for name, (f, value) in columns.items()))
    joined = rows.join(pieces, (F.col("file") == F.col("_f")) & (F.col("_piece") == F.col("_p")))

    def both(name, f):
        a, b = F.col(f"_near_{name}"), F.col(f"_{name}")
        return F.greatest(a, b) if f is F.max else F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))

    keep = [c for c in rows.columns if not c.startswith("_")]
    return joined.select(*keep, *(both(name, f).alias(name) for name, (f, _) in columns.items()))


def document_lengths(found: DataFrame) -> DataFrame:
    """Rows file, number, start, n_tokens, closed: the documents of each file in order, from the
    separators of its blocks."""
    n = F.size("places")
    rows = _before(found, {"base": (F.sum, F.col("n_tokens")), "number": (F.sum, n)})
    last = F.when(n > 0, F.col("base") + F.element_at("places", -1))
    rows = _before(rows, {"behind": (F.max, last)})
    # where the document begins that is open at the start of the block
    begun = F.coalesce(F.col("behind") + 1, F.lit(0))
    ends = rows.select("file", "base", "number", begun.alias("begun"), "places",
                       F.posexplode("places").alias("i", "place"))
    start = F.when(F.col("i") == 0, F.col("begun")).otherwise(
        F.col("base") + F.get("places", F.col("i") - 1) + 1)
    closed = ends.select("file", (F.col("number") + F.col("i")).alias("number"),
                         start.alias("start"),
                         (F.col("base") + F.col("place") - start).alias("n_tokens"),
                         F.lit(True).alias("closed"))
    # what is behind the last separator of a file
    whole = found.groupBy("file").agg(F.sum("n_tokens").alias("all"), F.sum(n).alias("number"))
    lasts = rows.groupBy(F.col("file").alias("_f")).agg(
        F.coalesce(F.max(last) + 1, F.lit(0)).alias("start"))
    rest = whole.join(lasts, F.col("file") == F.col("_f")).where("all > start").select(
        "file", "number", "start", (F.col("all") - F.col("start")).alias("n_tokens"),
        F.lit(False).alias("closed"))
    return closed.union(rest)


def count_tokens(docs: DataFrame, separator: int = SEPARATOR, block: int = BLOCK,
                 dtype: str = DTYPE, doc_id: str = "doc_id", **options) -> DataFrame:
    """Rows doc_id, n_tokens, file, number, start for each document, by way of its token stream."""
    spark = docs.sparkSession
    path = fresh_path(spark, "tokens")
    write_stream(docs, path, separator, block, dtype, doc_id=doc_id, **options)
    stream = spark.read.schema(
        f"file long, at long, tokens binary, id {docs.schema[doc_id].dataType.simpleString()}"
    ).parquet(path)
    found = cut(find_separators(stream.where("tokens IS NOT NULL"), separator, dtype))
    ids = cut(stream.where("tokens IS NULL").select(
        F.col("file").alias("_f"), F.col("at").alias("_n"), F.col("id").alias(doc_id)))
    remove(spark, path)
    lengths = document_lengths(found)
    return ids.join(lengths, (F.col("_f") == F.col("file")) & (F.col("_n") == F.col("number"))
                    ).select(doc_id, "n_tokens", "file", "number", "start")
