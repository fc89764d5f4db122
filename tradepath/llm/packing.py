"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

A document's tokens, with an end token, are one piece, or pieces of `length` tokens of which the
first may be shorter. A full piece is a sequence of its own. The others are dealt into groups of
about `group_pieces`, and each group is packed in one task: pieces come longest first,
and each goes where the sum over gaps of the squared number of open sequences with that gap
becomes smallest; a new sequence is opened only if none that is open has room. What a group
leaves unfilled does not grow with the group, so the number of sequences follows the input. The
number of groups follows the number of pieces, which are dealt by the numbers of their rows.

Tokens come from the rank file of the vocabulary, which gives the ids of its `tokenizers` file
several times faster; a text that spells out a special token goes through that file itself, so that
the ids are those of `Tokenizer.from_file(...).encode(text, add_special_tokens=False)`.

Defined results: a null text is an empty one and gives one piece, the end token; every row is
packed, also one that repeats another; a null id is an id like any other; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.llm.common import cut

LENGTH = 1024
END = 2
GROUP_PIECES = 50_000
VOCABULARY = "byte_bpe_50k"


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY, ordinary: bool = False):
    """A function from a text to its ids as an array of little-endian unsigned 32-bit numbers; if
    ordinary, a special token that a text spells out is text like any other."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})
    plain = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    special = [] if ordinary else [t.content for t in plain.get_added_tokens_decoder().values()]

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    return encode


def _cut_pieces(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter."""
    first = n % length or length
    return [(0, min(first, n))] + [(at, length) for at in range(first, n, length)]


def pieces(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str = VOCABULARY,
           with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary)."""
    key = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField(doc_id, key), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ])

    def run(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            rows, out = [], [[] for _ in schema.names[1:]]
            for at, value in enumerate(batch.column(1)):
                ids = np.append(encode(value.as_py() or ""), np.uint32(end)).astype("<u4")
                for number, (start, size) in enumerate(_cut_pieces(len(ids), length)):
                    data = ids[start:start + size].tobytes()
                    rows.append(at)
                    # the ids themselves only if out has a column for them
                    for column, x in zip(out, (number, start, size, zlib.crc32(data), data)):
                        column.append(x)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64()))]
                + [pa.array(c, k) for c, k in zip(out, kinds)],
                names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def place(sizes: list[int], length: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each size, in the order given, by the sum-of-squares rule."""
    counts = np.zeros(length + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(length + 1)]
    bins, offsets, opened = [], [], 0
    none = np.iinfo(np.int64).max
    for s in sizes:
        gap = length
        if s < length:
            # leaving gap h for h - s changes the sum by 2 (N[h-s] - N[h]) + 2; a closed one drops out
            change = 2 * (counts[:length - s] - counts[s:length]) + 2
            change[0] = 1 - 2 * counts[s]
            change[counts[s:length] == 0] = none
            best = int(change.argmin())
            if change[best] != none:
                gap = s + best
        if gap == length:
            at, opened = opened, opened + 1
        else:
            at = open_bins[gap].pop()
            counts[gap] -= 1
        if gap > s:
            open_bins[gap - s].append(at)
            counts[gap - s] += 1
        bins.append(at)
        offsets.append(length - gap)
    return bins, offsets


def pack(cut_pieces: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces (any columns, among them `length`) with sequence_id and offset. Full pieces get
    ids from 0 on, packed ones negative ids."""
    found = cut(cut_pieces)
    short = found.where(F.col("length") < length)
    groups = max(1, round(short.count() / group_pieces))
    schema = T.StructType([*found.schema, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns(["_group"])
        by = [rows[c].to_numpy() for c in ("length", "ids_crc32", "piece") if c in rows.column_names]
        rows = rows.take(pa.array(np.lexsort([-v.astype(np.int64) for v in reversed(by)])))
        bins, offsets = place(rows["length"].to_pylist(), length)
        sequence = -1 - (key[0].as_py() * 2**32 + np.array(bins, np.int64))
        return rows.append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offsets, pa.int64()))

    # by the number of a row, so that rows that repeat each other are dealt as well
    packed = short.withColumn("_group", F.pmod(
        F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))).groupBy(
        "_group").applyInArrow(run, schema)
    full = found.where(F.col("length") >= length).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, length: int = LENGTH, with_ids: bool = False,
                   **options) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    return pack(pieces(docs, length, with_ids=with_ids, **options), length)
