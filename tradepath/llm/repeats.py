"""Suffix-array deduplication: every byte that lies in a repeated string of SPAN bytes goes.

The suffix array is sparse: of all suffixes only those at anchors are kept, one for each run of
SPAN-byte windows with the same least GRAM-byte hash. Equal windows have equal anchors at the same
place, so two equal windows always meet at an anchor, and an anchor seen once in the corpus rules
out all windows of its run. A run's region is what its windows cover, at most
SPAN + SPAN - GRAM bytes around the anchor.

1. Anchors are counted over the corpus; runs whose anchor occurs once are done.
2. Equal regions of an anchor are counted. All windows of a region that occurs twice are repeats,
   in every copy; copies are never brought together.
3. What is left are regions that occur once, under an anchor with other regions: the rims of
   repeats. For each anchor the suffixes from the anchor on are sorted, and a stack scan over the
   common prefixes of neighbours gives the interval tree. In each interval (a common right
   extension of r bytes) the occurrences are sorted by what precedes the anchor; those that share
   l bytes there with l + r >= SPAN, and differ beyond, are a maximal repeat group. All its
   occurrences are found, not neighbours only, and each is covered as far as its longest partner.
4. An anchor with more than GROUP different regions (a passage in very many contexts) is not
   brought together: its windows are counted one by one by a 128-bit hash, before and after the
   shuffle.

Regions are compared by an anchor hash and a region hash of 64 bits each; the rims byte by byte.

Defined results: a null text is an empty one; a text of fewer than SPAN bytes loses nothing; a
text that is there twice goes wholly; rows that repeat an id and a text are such copies and each
gets a result; rows that share only the id are kept apart by a hash of the text; null ids are ids
like any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.llm.common import group_starts, whole_groups, written
from tradepath.llm.symbols import mix

SPAN = 200
GRAM = 32
GROUP = 4096
#: windows that a task looks at together, and the bits of a place among them
_SLICE = 1 << 20
_PLACE_BITS = 21
_BASE = 0xD6E8FEB86659FD93


@lru_cache(maxsize=1)
def _tables():
    """Random numbers for byte values; powers of the base and of its inverse."""
    values = mix(np.arange(1, 257, dtype=np.uint64))
    inverse = pow(_BASE, -1, 1 << 64)
    n = _SLICE + 2 * SPAN
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return values, np.cumprod(up), np.cumprod(down)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all strings of GRAM bytes, by doubling."""
    values = _tables()[0]
    out, size = values[data], 1
    while size < GRAM:
        out = out[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + out[size:]
        size *= 2
    return mix(out)


def _window_least(packed: np.ndarray, width: int) -> np.ndarray:
    out, size = packed, 1
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(packed) - width + 1], out[width - size:]) if size < width else out


def find_runs(data: np.ndarray, of: np.ndarray, span: int = SPAN):
    """Runs of windows with the same anchor in texts that lie one behind the other; of: the number
    of the text of each byte. Arrays: start, windows, place of the anchor in the region, anchor
    hash, region hash."""
    if len(data) < span:
        return (np.zeros(0, np.int64),) * 5
    hashes = _gram_hashes(data)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    at = (_window_least(packed, span - GRAM + 1) & mask).astype(np.int64)
    valid = of[:len(at)] == of[span - 1:]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(at)))
    on = valid[starts]
    starts, sizes = starts[on], sizes[on]
    anchors = at[starts]
    _, up, down = _tables()
    total = np.concatenate([[np.uint64(0)], np.cumsum(
        mix(data.astype(np.uint64) + np.uint64(1000)) * up[:len(data)], dtype=np.uint64)])
    regions = (total[starts + sizes + span - 1] - total[starts]) * down[starts]
    shape = ((anchors - starts) * 4096 + sizes).astype(np.uint64)
    return (starts, sizes, anchors - starts, hashes[anchors].astype(np.int64),
            mix(regions ^ mix(shape)).astype(np.int64))


def _slices(texts: list[bytes], span: int):
    """Bytes of texts, their texts' numbers, and where each text (or part) begins in its text; each
    slice has _SLICE windows at most. A long text is cut so that each window is in one slice."""
    parts, size = [], 0
    for i, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - span + 1), _SLICE):
            part = text[begin:begin + _SLICE + span - 1]
            if len(part) < span:
                continue
            if parts and size + len(part) > _SLICE + span - 1:
                yield parts
                parts, size = [], 0
            parts.append((i, begin, part))
            size += len(part)
    if parts:
        yield parts


def _runs(span: int, schema):
    """kind 0: a run, `n` how often it occurs in its text (2 stands for more); kind 1: a span that
    repeats within its text."""
    def run(batches):
        for batch in batches:
            texts = [(v.as_py() or b"") for v in batch.column(2)]
            for parts in _slices(texts, span):
                data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
                sizes = [len(p) for _, _, p in parts]
                of = np.repeat(np.arange(len(parts)), sizes)
                starts, windows, offset, anchor, region = find_runs(data, of, span)
                part = of[starts] if len(starts) else starts
                begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                text_no = np.array([i for i, _, _ in parts])[part]
                start = starts - begins[part] + np.array([b for _, b, _ in parts])[part]
                # runs that a text has more than once: one stands for them, their spans are known
                order = np.lexsort((start, region, anchor, text_no))
                same = np.zeros(len(order), bool)
                same[1:] = ((text_no[order][1:] == text_no[order][:-1])
                            & (anchor[order][1:] == anchor[order][:-1])
                            & (region[order][1:] == region[order][:-1]))
                more = np.append(same[1:], False)[:len(order)]
                first = order[~same]
                n = 1 + more[~same].astype(np.int64)
                known = order[same | more]
                pick = np.concatenate([first, known])
                kind = np.repeat([0, 1], [len(first), len(known)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind, pa.int32()),
                     pa.array(anchor[pick]), pa.array(region[pick]),
                     batch.column(0).take(pa.array(text_no[pick], pa.int64())),
                     batch.column(1).take(pa.array(text_no[pick], pa.int64())),
                     pa.array(start[pick], pa.int64()), pa.array(windows[pick], pa.int32()),
                     pa.array(offset[pick], pa.int32()),
                     pa.array(np.concatenate([n, np.full(len(known), 2)]), pa.int32())],
                    names=schema)

    return run


def prefix_intervals(common: np.ndarray):
    """The interval tree of a sorted list from the common prefixes of neighbours, by a stack scan:
    (length, first, last) of each interval, inner ones first. Neighbours with a negative number
    have nothing to do with each other."""
    stack = []  # (length, first)
    for i in range(len(common) + 1):
        length = int(common[i]) if i < len(common) else -1
        first = i
        while stack and stack[-1][0] > length:
            inner, first = stack.pop()
            yield inner, first, i
        if length >= 0 and (not stack or stack[-1][0] < length):
            stack.append((length, first))


def _matrix(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in strings])
    width = int(size.max(initial=0))
    flat = b"".join(s.ljust(width, b"\0") for s in strings)
    return np.frombuffer(flat, np.uint8).reshape(len(strings), width), size


def _common(rows: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common prefix of the strings a and b of a matrix."""
    differ = rows[a] != rows[b]
    first = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return np.minimum(first, np.minimum(size[a], size[b]))


def maximal_repeats(anchors: np.ndarray, lefts: list[bytes], rights: list[bytes],
                    span: int = SPAN):
    """The maximal repeat groups of at least `span` bytes around anchors: (l, r, places) for the
    occurrences that share l bytes before their anchor (lefts are reversed) and r bytes from it."""
    order = sorted(range(len(rights)), key=lambda i: (anchors[i], rights[i]))
    order = np.array(order, np.int64)
    right, right_size = _matrix(rights)
    left, left_size = _matrix(lefts)
    by_left = np.empty(len(lefts), np.int64)
    by_left[sorted(range(len(lefts)), key=lefts.__getitem__)] = np.arange(len(lefts))
    common = _common(right, right_size, order[:-1], order[1:])
    common[anchors[order[1:]] != anchors[order[:-1]]] = -1
    beside = _common(left, left_size, order[:-1], order[1:])
    for r, first, last in prefix_intervals(common):
        if last - first == 1:
            if r + beside[first] >= span:
                yield int(beside[first]), r, order[first:last + 1]
            continue
        some = order[first:last + 1]
        some = some[np.argsort(by_left[some])]
        shared = _common(left, left_size, some[:-1], some[1:])
        if shared.max() + r < span:
            continue
        # the same tree on the left side; occurrences that agree further on the right make up a
        # group of an inner interval, and come again here only with others or with a longer left
        close = np.where(shared + r >= span, shared, -1)
        for l, one, two in prefix_intervals(close):
            yield l, r, some[one:two + 1]


def _rims(span: int, names: list[str]):
    """Spans of the regions that occur once, as far as a maximal repeat group covers them."""
    def run(batches):
        for rows in whole_groups(batches, 1):
            offset, region = rows["offset"].to_numpy(), rows["bytes"].to_pylist()
            lefts = [b[:o][::-1] for b, o in zip(region, offset)]
            rights = [b[o:] for b, o in zip(region, offset)]
            l_most, r_most = (np.zeros(len(region), np.int64) for _ in range(2))
            for l, r, places in maximal_repeats(rows["anchor"].to_numpy(), lefts, rights, span):
                l_most[places] = np.maximum(l_most[places], l)
                r_most[places] = np.maximum(r_most[places], r)
            some = np.flatnonzero((r_most > 0) & (rows["n"].to_numpy() == 1))
            at = rows["start"].to_numpy() + offset
            pick = pa.array(some)
            yield pa.RecordBatch.from_arrays(
                [rows["doc"].combine_chunks().take(pick), rows["h"].combine_chunks().take(pick),
                 pa.array((at - l_most)[some]), pa.array((at + r_most)[some])], names=names)

    return run


def _region_bytes(span: int, schema):
    """Bytes of the regions asked for; of those under a crowded anchor the windows' hashes."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                text = unpack.decompress(batch.column(2)[i].as_py())
                out = [[] for _ in range(6)]
                for w in batch.column(3)[i].as_py():
                    region = text[w["start"]:w["start"] + w["windows"] + span - 1]
                    rows = [(w["anchor"], w["start"], w["offset"], w["n"], region, False)]
                    if w["crowded"]:
                        rows = [(0, w["start"] + k, 0, w["n"],
                                 xxhash.xxh3_128_digest(region[k:k + span]), True)
                                for k in range(w["windows"])]
                    for row in rows:
                        for column, x in zip(out, row):
                            column.append(x)
                n = len(out[0])
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array([i] * n, pa.int64())) for c in (0, 1)]
                    + [pa.array(c, k) for c, k in zip(out, kinds)], names=schema)

    return run


def _packed(names: list[str]):
    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([pack.compress(v.as_py() or b"") for v in batch.column(2)], pa.binary())],
                names=names)

    return run


def repeated_spans(docs: DataFrame, span: int = SPAN, group: int = GROUP, doc_id: str = "doc_id",
                   text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows doc, h, start, end of repeated strings (they overlap), and rows doc, h, packed of the
    texts."""
    plain = docs.select(
        F.col(doc_id).alias("doc"), F.coalesce(text, F.lit("")).alias("t")).select(
        "doc", F.hash("t").alias("h"), F.col("t").cast("binary").alias("bytes"))
    doc = T.StructField("doc", docs.schema[doc_id].dataType)
    h, start = T.StructField("h", T.IntegerType()), T.StructField("start", T.LongType())
    run_schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("anchor", T.LongType()),
        T.StructField("region", T.LongType()), doc, h, start,
        *(T.StructField(c, T.IntegerType()) for c in ("windows", "offset", "n"))])
    runs = plain.mapInArrow(_runs(span, run_schema.names), run_schema)
    end = (F.col("start") + F.col("windows") + (span - 1)).alias("end")
    # 1. anchors that occur again
    one = F.col("kind") == 0
    again = runs.where(one).groupBy("anchor").agg(F.sum("n").alias("c")).where("c > 1")
    # written, as are the rims: adaptive execution splits the rows of a common anchor only if both
    # sides of a join come straight from a shuffle
    again = written(again.select("anchor"), "again")
    left = written(runs.join(again, "anchor", "left_semi"), "runs")
    # 2. regions that occur again
    regions = left.where(one).groupBy("anchor", "region").agg(
        F.sum("n").alias("n"),
        F.min(F.struct("doc", "h", "start", "windows", "offset")).alias("w"))
    same = left.where(one).join(
        regions.where("n > 1").select("anchor", "region"), ["anchor", "region"], "left_semi")
    spans = same.select("doc", "h", "start", end).union(
        left.where(~one).select("doc", "h", "start", end))
    # 3. regions that occur once under an anchor with others
    rims = regions.groupBy(F.col("anchor").alias("a")).agg(
        F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1")
    rims = written(rims.select("a", "kinds"), "rims")
    wanted = regions.join(rims, F.col("anchor") == F.col("a")).select(
        "w.doc", "w.h", F.struct(
            "anchor", "w.start", "w.windows", "w.offset",
            F.least("n", F.lit(2)).cast("int").alias("n"),
            (F.col("kinds") > group).alias("crowded")).alias("w"))
    wanted = wanted.groupBy("doc", "h").agg(F.collect_list("w").alias("wanted"))
    pack_schema = T.StructType([doc, h, T.StructField("packed", T.BinaryType())])
    texts = plain.mapInArrow(_packed(pack_schema.names), pack_schema)
    names = {"doc": "_doc", "h": "_h"}
    wanted = wanted.withColumnsRenamed(names)
    some = texts.join(wanted, texts["doc"].eqNullSafe(wanted["_doc"]) & (texts["h"] == wanted["_h"])
                      ).dropDuplicates(["doc", "h"]).select("doc", "h", "packed", "wanted")
    byte_schema = T.StructType([
        doc, h, T.StructField("anchor", T.LongType()), start,
        T.StructField("offset", T.IntegerType()), T.StructField("n", T.IntegerType()),
        T.StructField("bytes", T.BinaryType()), T.StructField("crowded", T.BooleanType())])
    pieces = written(some.mapInArrow(_region_bytes(span, byte_schema.names), byte_schema), "regions")
    span_schema = T.StructType([doc, h, start, T.StructField("end", T.LongType())])
    near = (
        pieces.where("NOT crowded").select("anchor", "doc", "h", "start", "offset", "n", "bytes")
        .repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(_rims(span, span_schema.names), span_schema)
    )
    # 4. single windows under crowded anchors
    windows = pieces.where("crowded")
    twice = windows.groupBy("bytes").agg(F.sum("n").alias("c")).where("c > 1").select("bytes")
    single = windows.where("n = 1").join(twice, "bytes", "left_semi").select(
        "doc", "h", "start", (F.col("start") + span).alias("end"))
    return spans.union(near).union(single), texts


def _removed(schema):
    """Texts without their spans."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = [[] for _ in range(5)]
            for packed, spans in zip(batch.column(1), batch.column(2)):
                text = unpack.decompress(packed.as_py())
                kept, at, runs = [], 0, []
                for s in sorted((s["start"], s["end"]) for s in spans.as_py() or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                for first, last in runs:
                    kept.append(text[at:first])
                    at = last
                kept.append(text[at:])
                kept = b"".join(kept)
                for column, x in zip(out, (len(text), len(text) - len(kept), len(runs),
                                           hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))][:len(schema)],
                names=schema)

    return run


def remove_repeats(docs: DataFrame, span: int = SPAN, with_bytes: bool = False,
                   doc_id: str = "doc_id", **options) -> DataFrame:
    """Rows doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (binary: a
    repeat may begin or end inside a character)."""
    spans, texts = repeated_spans(docs, span, doc_id=doc_id, **options)
    spans = spans.distinct().groupBy(F.col("doc").alias("_doc"), F.col("h").alias("_h")).agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = texts.join(
        spans, texts["doc"].eqNullSafe(spans["_doc"]) & (texts["h"] == spans["_h"]), "left")
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType),
        *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
        T.StructField("kept_sha256", T.StringType()),
        *([T.StructField("kept", T.BinaryType())] if with_bytes else [])])
    return joined.select("doc", "packed", "spans").mapInArrow(_removed(schema.names), schema)
