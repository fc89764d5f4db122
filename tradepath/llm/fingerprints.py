"""Document fingerprints: an improbable-feature digest.

Each window of WINDOW bytes has an entropy, in LEVELS steps. How often each level occurs in the
corpus ranks the levels: the rarer, the more telling. In each neighbourhood of NEIGHBOURS windows
the leftmost one of the rarest level gets a vote; windows with VOTES or more are features, apart
from those of the least levels, which are runs and tables. Windows are so short that half of a text
of a few words still holds some; the same numbers hold for all texts. Features are hashed into five bits each of
a Bloom filter of FILTER_BITS; after PER_FILTER different features the next filter of the chain
begins. Two fingerprints are compared filter by filter: the overlap beyond that of chance, by the
most that is possible; each filter of the shorter chain takes its best partner, and filters
weigh by their features. A text without a feature has the hash of its bytes as its only one.

The levels' frequencies are counted over all texts (a table of LEVELS + 1 rows). To meet the next
document, texts are dealt into ranges of ids and hashes that hold about PART_BYTES of text, or a
PARTS-th of it if that is more. Where a range begins comes from a sort of ids, hashes and sizes
alone; these rows, a bounded number, are broadcast, and each text finds its range among them by
binary search. The first text of each range is also sent to the range before it, and each task
reads its range in order, a batch at a time.

Defined results: a null text is an empty one; empty texts have one feature in common, so they are
alike; rows that repeat an id follow each other by the hash of their text (rows that repeat both lie
in one range); null ids come first; ids may be of any type that can be sorted; a corpus of one row is its own next document; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.llm.common import cut
from tradepath.llm.symbols import mix, packs

WINDOW = 8
LEVELS = 1000
LOWEST = 100
NEIGHBOURS = 8
VOTES = 1
FILTER_BITS = 2048
PER_FILTER = 160
#: overlap that counts as none: this share of the way from chance to the most that is possible
FLOOR = 0.1
PART_BYTES = 4 << 20
PARTS = 50_000
_CHUNK = 1 << 18
_TEXTS = 512
#: Rows of an Arrow batch: an executor holds several batches of each of its tasks, in Java and Python
_BATCH_ROWS = 500


@lru_cache(maxsize=1)
def _weights() -> np.ndarray:
    """c log2 c for counts in a window, as integers of 2 ** -32: sums are exact, so equal windows
    have equal levels wherever they lie."""
    c = np.arange(WINDOW + 1)
    return np.rint(c * np.log2(np.maximum(c, 1)) * 2**32).astype(np.int64)


def _occurrences(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each byte occurs in the window that begins, and that ends, with it."""
    ahead, behind = np.ones(len(data), np.uint8), np.ones(len(data), np.uint8)
    for lag in range(1, min(WINDOW, len(data))):
        same = (data[lag:] == data[:-lag]).view(np.uint8)
        ahead[:-lag] += same
        behind[lag:] += same
    return ahead, behind


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """The entropy of each window of the bytes, from 0 to LEVELS, by what each step lets in and
    out."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int16)
    out = []
    w = _weights()
    for at in range(0, n, _CHUNK):
        part = data[at:at + _CHUNK + WINDOW - 1]
        m = len(part) - WINDOW + 1
        ahead, behind = _occurrences(part)
        first = w[np.bincount(part[:WINDOW])].sum()
        gone, come = ahead[:m - 1], behind[WINDOW:]
        step = w[come] - w[come - 1] - w[gone] + w[gone - 1]
        # the byte that leaves and the one that comes, if they are equal, change nothing: then both
        # counts are the same number, for `ahead` counts it within the old window
        total = np.concatenate([[first], first + np.cumsum(step)])
        out.append(LEVELS - np.rint(total * (LEVELS / w[WINDOW])).astype(np.int16))
    return np.concatenate(out)


def levels_of(texts: list[bytes]) -> list[np.ndarray]:
    """The levels of each text. Short texts are taken together, as one string of bytes; windows
    across their ends are left out."""
    out, at = [], 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) <= _CHUNK:
            size += len(texts[to])
            to += 1
        levels = entropy_levels(np.frombuffer(b"".join(texts[at:to]), np.uint8))
        begin = 0
        for text in texts[at:to]:
            out.append(levels[begin:begin + max(0, len(text) - WINDOW + 1)])
            begin += len(text)
        at = to
    return out


def spliced(before: bytes, levels: np.ndarray, keep: int, behind: bytes,
            next_levels: np.ndarray) -> np.ndarray:
    """The levels of before[:keep] + behind, a beginning of the next text: only windows across the
    seam are new."""
    seam = before[max(0, keep - WINDOW + 1):keep] + behind[:WINDOW - 1]
    return np.concatenate([
        levels[:max(0, keep - WINDOW + 1)], entropy_levels(np.frombuffer(seam, np.uint8)),
        next_levels[:max(0, len(behind) - WINDOW + 1)]])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    out, size = values, 1
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(values) - width + 1], out[width - size:]) if size < width else out


def feature_places(levels: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Windows that the neighbourhoods vote for."""
    if not len(levels):
        return np.zeros(0, np.int64)
    width = min(NEIGHBOURS, len(levels))
    votes = np.bincount(_least((ranks[levels] << 40) | np.arange(len(levels)), width)
                        & ((1 << 40) - 1), minlength=len(levels))
    return np.flatnonzero((votes >= min(VOTES, len(levels) - width + 1)) & (levels >= LOWEST))


def _feature_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    out = np.zeros(len(places), np.uint64)
    words = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places].copy().view("<u8")
    for i in range(words.shape[1]):
        out = mix(out + words[:, i] + np.uint64(i + 1))
    return out


def fingerprint(data: bytes, levels: np.ndarray, ranks: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """The filters of a text (uint8 rows) and the number of features in each."""
    hashes = np.zeros(0, np.uint64)
    if len(levels):
        hashes = _feature_hashes(np.frombuffer(data, np.uint8), feature_places(levels, ranks))
    if not len(hashes):
        hashes = np.frombuffer(hashlib.sha256(data).digest()[:8], "<u8")
    # different ones, in the order of the text
    hashes = hashes[np.sort(np.unique(hashes, return_index=True)[1])]
    chain = np.arange(len(hashes)) // PER_FILTER
    bits = np.zeros((chain[-1] + 1, FILTER_BITS), np.uint8)
    for i in range(5):
        bits[chain, (hashes >> np.uint64(11 * i)).astype(np.int64) % FILTER_BITS] = 1
    return np.packbits(bits, axis=1), np.bincount(chain)


def to_text(filters: np.ndarray, sizes: np.ndarray) -> str:
    """features of the last filter, then the filters."""
    return f"{len(sizes)}:{sizes[-1]}:" + base64.b64encode(filters.tobytes()).decode()


def _set_bits(filters: np.ndarray) -> np.ndarray:
    return np.bitwise_count(filters.view("<u8")).sum(-1).astype(float)


def likeness(a, b) -> float:
    """0 to 1; symmetric; 1 for equal fingerprints."""
    (fa, na), (fb, nb) = a, b
    if fa.shape == fb.shape and (fa == fb).all():
        return 1.0
    if len(na) > len(nb) or (len(na) == len(nb) and (na.sum(), fa.tobytes()) > (nb.sum(), fb.tobytes())):
        (fa, na), (fb, nb) = (fb, nb), (fa, na)
    ones_a, ones_b = _set_bits(fa)[:, None], _set_bits(fb)[None, :]
    both = np.empty((len(fa), len(fb)))
    for i, row in enumerate(fa):
        both[i] = _set_bits(row & fb)
    chance, most = ones_a * ones_b / FILTER_BITS, np.minimum(ones_a, ones_b)
    least = chance + FLOOR * (most - chance)
    found = np.clip((both - least) / np.maximum(most - least, 1e-9), 0, 1).max(1)
    return float((found * na).sum() / na.sum())


def pieces(batch: pa.RecordBatch, text: int):
    """The batch in slices of at most _TEXTS rows and _CHUNK bytes of text, a longer text alone: what
    a task holds as strings and levels at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    for begin, end in packs(sizes, _CHUNK):
        for at in range(begin, end, _TEXTS):
            yield batch.slice(at, min(_TEXTS, end - at))


def level_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The rank of each level by its frequency in all texts; the rarest has rank 0, ties go to the
    higher entropy."""
    def run(batches):
        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for piece in pieces(batch, 0):
                texts = [(t or "").encode() for t in piece.column(0).to_pylist()]
                total += np.bincount(np.concatenate(levels_of(texts)), minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(LEVELS + 1)), pa.array(total)], names=["level", "n"])

    rows = docs.select(text).mapInArrow(run, "level long, n long").groupBy("level").agg(
        F.sum("n").alias("n")).collect()
    n = np.zeros(LEVELS + 1, np.int64)
    for r in rows:
        n[r["level"]] = r["n"]
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[np.lexsort((-np.arange(LEVELS + 1), n))] = np.arange(LEVELS + 1)
    return ranks


def _place(key, h) -> tuple:
    """What rows are ordered by: ids (nulls first, not-a-number last), then hashes."""
    if key is None:
        return 0, 0, h
    return (1, key, h) if key == key else (2, 0, h)


def _begins(keys: DataFrame, size: int) -> list[tuple]:
    """The first id and hash of each range of about `size` bytes of text, in order."""
    def run(batches):
        held = size  # the first row of a task begins a range
        for batch in batches:
            begin = []
            for i, n in enumerate(batch.column(2).to_pylist()):
                if held >= size:
                    begin.append(i)
                    held = 0
                held += n
            yield batch.select([0, 1]).take(pa.array(begin, pa.int64()))

    schema = T.StructType([keys.schema["id"], keys.schema["h"]])
    order = [F.col("id").asc_nulls_first(), F.col("h").asc()]
    rows = keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
    found = rows.toArrow()
    # a key that several ranges begin with, as its rows are many, begins one
    return sorted({_place(key, h) for key, h in zip(
        found["id"].to_pylist(), found["h"].to_pylist())})


def with_next(docs: DataFrame, doc_id: str, text: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows part, last, id, h, text, in order within a part (ids, nulls first); the row with
    last = 1 is a copy of the first of the next part (after the last part: of the first)."""
    plain = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    rows = plain.withColumn("h", F.xxhash64("text"))
    keys = cut(rows.select("id", "h", (F.octet_length("text").cast("long") + 1).alias("n")))
    total = keys.agg(F.sum("n")).first()[0] or 0
    shared = docs.sparkSession.sparkContext.broadcast(
        _begins(keys, max(part_bytes, -(-total // PARTS))))

    @F.arrow_udf("array<int>")
    def parts(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        begins, out = shared.value, []
        for key, h in zip(ids.to_pylist(), hashes.to_pylist()):
            place = _place(key, h)
            at = bisect_right(begins, place) - 1
            out.append([at, (at - 1) % len(begins)] if begins[at] == place else [at])
        return pa.array(out, pa.list_(pa.int32()))

    return rows.select(F.posexplode(parts("id", "h")).alias("last", "part"), "id", "h",
                       "text").select("part", "last", "id", "h", "text")


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next;
    the edited text has its last half replaced by the beginning of the next document."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_BATCH_ROWS))
    shared = docs.sparkSession.sparkContext.broadcast(level_ranks(docs, text))
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in
          ("edited_sha256", "fingerprint", "edited_fingerprint")),
        *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next"))])

    def run(batches):
        ranks, held = shared.value, None
        for whole in batches:
            kind = whole.schema.field(2).type
            for piece in pieces(whole, 4):
                out, held = step(piece, ranks, held)
                kinds = [kind, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds)], names=schema.names)

    def step(batch, ranks, held):
        out = [[] for _ in schema.names]
        values = batch.column(4).to_pylist()
        texts = [v.encode() for v in values]
        for part, last, key, value, data, levels in zip(
                *(batch.column(i).to_pylist() for i in (0, 1, 2)), values, texts, levels_of(texts)):
            mark = fingerprint(data, levels, ranks)
            if held is not None and held[0] == part:
                _, one, before, its_data, its_levels, its = held
                half = len(before) // 2
                kept, behind = before[:len(before) - half].encode(), value[:half].encode()
                edited = kept + behind
                changed = fingerprint(
                    edited, spliced(its_data, its_levels, len(kept), behind, levels), ranks)
                for column, x in zip(out, (
                        one, len(before), hashlib.sha256(edited).hexdigest(), to_text(*its),
                        to_text(*changed), likeness(its, changed), likeness(its, mark))):
                    column.append(x)
            held = None if last else (part, key, value, data, levels, mark)
        return out, held

    ordered = with_next(docs, doc_id, text, part_bytes).repartition("part").sortWithinPartitions(
        "part", "last", F.col("id").asc_nulls_first(), "h")
    return ordered.mapInArrow(run, schema)
