"""N-gram Jaccard join with Bayesian candidate pruning.

Two documents are linked if the sets of their word shingles have a Jaccard similarity of at least
`threshold`. Documents with the same set are one class and are compared once.

1. Each document gets its set, a 128-bit name of the set, and HASHES MinHash values (by task, all
   texts of a batch at once).
2. Candidates share a band of ROWS values. With 32 bands of 4 a pair at 0.8 is missed with a
   probability of 5e-8, one at 0.85 with 7e-11.
3. The pairs of a bucket are compared by their MinHash values a few at a time; a pair is dropped
   once the posterior probability (uniform prior) of reaching the threshold falls below TOLERANCE.
   Of each value the lowest byte is compared: one in 256 unequal values counts as a match, so a
   pair may stay longer, never go earlier. What is left ties classes into provisional groups.
4. The members of a group come together once, with their sets. All pairs in a group go through
   the same pruning, and the rest is verified on the sets. Verified links give each class its number
   of links and, by connected components, its group.

No pair of a group is written as a row: tasks return one row per class. Buckets and groups of
more than BLOCK classes are dealt into pairs of blocks, so no task holds more than two blocks, and
all pairs are still met. Copies never meet at all; they only weigh.

Defined results: a text with fewer words than a shingle has one shingle of all its words; a null or
empty text or one without a word has no links and is a class of its own; rows that repeat an id and
a text are copies of each other; rows that share only an id each get their own result; null ids
are left out of the choice of the least id; empty tables give an empty result; other columns are
not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.llm.common import (
    fresh,
    group_starts,
    in_rows,
    remove,
    row_key,
    small_side,
    whole_groups,
    written,
)
from tradepath.llm.components import components
from tradepath.llm.symbols import packs, word_shingles

WORDS_PER_SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 256
#: sketches and pairs handled at once in a task
_TEXTS = 256
_PAIRS = 200_000


@lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    return np.random.default_rng(20260101).integers(1, 2**63, HASHES, dtype=np.uint64) * 2 + 1


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For 0, 1, ... compared values the matches below which a pair is dropped. With a uniform
    prior, P(similarity >= t | m of n match) is the chance of at most m successes in n + 1 tries of
    probability t."""
    out = []
    for n in range(HASHES + 1):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        out.append(m)
    return out


def minhash(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The MinHash values of sets that lie one behind the other; none is empty."""
    out = np.empty((len(starts), HASHES), np.uint32)
    for i, a in enumerate(_multipliers()):
        out[:, i] = np.minimum.reduceat(((hashes * a) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    v = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    key = np.zeros(v.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = (key ^ v[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.astype(np.int64)


def surviving(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray,
              threshold: float, tolerance: float) -> np.ndarray:
    """Which pairs (left[a], right[b]) of MinHash values outlast the comparison, STEP at a time."""
    least = least_matches(threshold, tolerance)
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int32)
    for at in range(0, HASHES, STEP):
        matches = matches + (left[a[alive], at:at + STEP] == right[b[alive], at:at + STEP]).sum(1)
        on = matches >= least[at + STEP]
        alive, matches = alive[on], matches[on]
        if not len(alive):
            break
    return alive


def jaccards(sets_a: list[np.ndarray], sets_b: list[np.ndarray], a: np.ndarray,
             b: np.ndarray) -> np.ndarray:
    """Exact similarities of the pairs (sets_a[a], sets_b[b]); a is sorted."""
    if not len(a):
        return np.zeros(0)
    flat = np.concatenate(sets_a + sets_b)
    ids = np.unique(flat, return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets_a + sets_b])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    flags = np.zeros(int(ids.max()) + 1, np.int32)
    out = np.empty(len(a))
    firsts = np.flatnonzero(np.diff(a, prepend=-1))
    for first, last in zip(firsts, np.append(firsts[1:], len(a))):
        i = a[first]
        mine = ids[begins[i]:begins[i + 1]]
        flags[mine] = 1
        for at in range(first, last, 64):
            others = b[at:min(last, at + 64)] + len(sets_a)
            hits = np.concatenate([flags[ids[begins[j]:begins[j + 1]]] for j in others])
            both = np.add.reduceat(hits, np.concatenate([[0], np.cumsum(sizes[others])[:-1]]))
            out[at:at + len(others)] = both / (sizes[i] + sizes[others] - both)
        flags[mine] = 0
    return out


def _sets(column, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for at, to in packs(sizes):
        hashes, of, size = word_shingles(column.slice(at, to - at), n)
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        hashes, of = hashes[new], of[new]
        out += np.split(hashes, np.searchsorted(of, np.arange(1, size)))
    return out


def _name(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def sketches(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """Rows doc_id, node (name of the set, null without a word), values (the lowest byte of each),
    bands."""
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("node", T.BinaryType()),
        T.StructField("values", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            sets = _sets(batch.column(1), n)
            full = [i for i, s in enumerate(sets) if len(s)]
            nodes, values, bands = ([None] * len(sets) for _ in range(3))
            for at in range(0, len(full), _TEXTS):
                some = full[at:at + _TEXTS]
                sizes = [len(sets[i]) for i in some]
                found = minhash(np.concatenate([sets[i] for i in some]),
                                np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                for i, v, keys in zip(some, found, band_keys(found)):
                    nodes[i], bands[i] = _name(sets[i]), keys
                    values[i] = v.astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(values, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


LINKS_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
      FROM w WHERE len(w) > 0),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS k FROM s GROUP BY 1),
sizes AS (SELECT k, min(doc_id) AS copy_id, count(*) AS copies, min(n) AS n FROM sets GROUP BY 1),
t AS (SELECT k, s FROM s JOIN sizes ON copy_id = doc_id),
pairs AS (SELECT a.k AS a, b.k AS b FROM t a JOIN t b ON a.s = b.s AND a.k <> b.k
      JOIN sizes x ON x.k = a.k JOIN sizes y ON y.k = b.k
      GROUP BY a.k, b.k, x.n, y.n HAVING count(*) >= 0.8 * (x.n + y.n - count(*)) - 1e-9),
links AS (SELECT a AS k, sum(copies) AS n FROM pairs JOIN sizes ON k = b GROUP BY 1),
reach AS (SELECT k, k AS r FROM sizes UNION SELECT reach.k, b FROM reach JOIN pairs ON a = r),
least AS (SELECT reach.k, min(copy_id) AS class_id FROM reach JOIN sizes ON sizes.k = r GROUP BY 1)
SELECT w.doc_id, coalesce(class_id, w.doc_id) AS class_id,
  CAST(coalesce(links.n, 0) + coalesce(copies, 1) - 1 AS BIGINT) AS n_links,
  coalesce(copy_id, w.doc_id) AS copy_id
FROM w LEFT JOIN sets USING (doc_id) LEFT JOIN sizes ON sizes.k = sets.k
LEFT JOIN links ON links.k = sets.k LEFT JOIN least ON least.k = sets.k"""


def _dealt(members: DataFrame, key: str) -> DataFrame:
    """Members (key, node, _n: the size of the key) in pairs of blocks: rows key, i, j, side, node. A
    row meets all rows of its key in exactly one pair of blocks, on side 0 or 1 (2 within a
    block)."""
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = members.where("_n > 1").select(
        key, "node", own.alias("_own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other"))
    side = F.when(F.col("_own") == F.col("_other"), 2).otherwise(
        F.when(F.col("_own") < F.col("_other"), 0).otherwise(1))
    return dealt.select(key, F.least("_own", "_other").alias("i"),
                        F.greatest("_own", "_other").alias("j"), side.alias("side"), "node")


def _together(dealt: DataFrame, key: str, wide: DataFrame) -> DataFrame:
    """The dealt rows with the columns of their nodes, each pair of blocks in one task. What is wide
    joins last and is shuffled once."""
    rows = dealt.join(wide, "node").select(
        key, "i", "j", "side", "node", *[c for c in wide.columns if c != "node"])
    return rows.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "side", "node")


def _pairs(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a group: all if it is one block, else across the two."""
    if side[0] == 2:
        return np.triu_indices(len(side), 1)
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1)
    return np.repeat(first, len(second)), np.tile(second, len(first))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place that each of n places is tied to."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _values(column) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), np.uint8).reshape(-1, HASHES)


def _provisional(threshold: float, tolerance: float):
    """Ties between classes of a bucket that outlast the pruning, as stars."""
    def run(batches):
        for rows in whole_groups(batches, 3):
            starts = group_starts(rows, 3)
            side, node = rows["side"].to_numpy(), rows["node"].to_pylist()
            values = _values(rows["values"])
            out_a, out_b = [], []
            todo_a, todo_b, size = [], [], 0

            def prune():
                a, b = np.concatenate(todo_a), np.concatenate(todo_b)
                for at in range(0, len(a), _PAIRS):
                    x, y = a[at:at + _PAIRS], b[at:at + _PAIRS]
                    on = surviving(values, values, x, y, threshold, tolerance)
                    out_a.append(x[on])
                    out_b.append(y[on])
                todo_a.clear()
                todo_b.clear()

            for first, last in zip(starts, np.append(starts[1:], rows.num_rows)):
                a, b = _pairs(side[first:last])
                todo_a.append(a + first)
                todo_b.append(b + first)
                size += len(a)
                if size > _PAIRS:
                    prune()
                    size = 0
            if todo_a:
                prune()
            root = _roots(rows.num_rows, np.concatenate(out_a), np.concatenate(out_b))
            tied = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([node[i] for i in tied], pa.binary()),
                 pa.array([node[i] for i in root[tied]], pa.binary())], names=["a", "b"])

    return run


def _verified(threshold: float, tolerance: float):
    """For each class of a group with a verified link: node, links, and a class it is tied to."""
    def run(batches):
        for rows in whole_groups(batches, 3):
            starts = group_starts(rows, 3)
            for first, last in zip(starts, np.append(starts[1:], rows.num_rows)):
                group = rows.slice(int(first), int(last - first))
                side, copies = group["side"].to_numpy(), group["copies"].to_numpy()
                node, values = group["node"].to_pylist(), _values(group["values"])
                sets = [np.frombuffer(s.as_py(), np.uint64) for s in group["shingles"]]
                all_a, all_b = _pairs(side)
                links, ties = np.zeros(len(node), np.int64), []
                for at in range(0, len(all_a), _PAIRS):
                    a, b = all_a[at:at + _PAIRS], all_b[at:at + _PAIRS]
                    on = surviving(values, values, a, b, threshold, tolerance)
                    a, b = a[on], b[on]
                    linked = jaccards(sets, sets, a, b) >= threshold - 1e-12
                    a, b = a[linked], b[linked]
                    links += np.bincount(a, copies[b], len(node)).astype(np.int64)
                    links += np.bincount(b, copies[a], len(node)).astype(np.int64)
                    ties.append((a, b))
                root = _roots(len(node), *map(np.concatenate, zip(*ties))) if ties else []
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node[i] for i in some], pa.binary()), pa.array(links[some]),
                     pa.array([node[root[i]] for i in some], pa.binary())],
                    names=["node", "links", "tie"])

    return run


def _with_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """Rows node, shingles of the classes wanted (node, least), from the text of the least id. Texts
    are shuffled only if the ids are too many to be broadcast."""
    docs = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    wanted = small_side(wanted)
    some = docs.join(wanted, docs["_id"].eqNullSafe(F.col("least"))).select("node", "_text")

    def run(batches):
        for batch in batches:
            node = batch.column(0).to_pylist()
            sets = _sets(batch.column(1), n)
            # an id may stand for several texts
            right = [i for i, s in enumerate(sets) if len(s) and _name(s) == node[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node[i] for i in right], pa.binary()),
                 pa.array([sets[i].tobytes() for i in right], pa.binary())],
                names=["node", "shingles"])

    return some.mapInArrow(run, "node binary, shingles binary").groupBy("node").agg(
        F.first("shingles").alias("shingles"))


def near_duplicates(docs: DataFrame, n: int = WORDS_PER_SHINGLE, threshold: float = THRESHOLD,
                    tolerance: float = TOLERANCE, doc_id: str = "doc_id",
                    text: str = "text", made: list[str] | None = None) -> DataFrame:
    """Rows doc_id, class_id (the least id of the group that links tie together), n_links (other
    documents at or above the threshold, copies among them), copy_id (least id with the same
    shingles). The result reads tables in the shared folder; their paths are added to `made`."""
    made = [] if made is None else made
    early: list[str] = []
    found = written(sketches(docs, doc_id, text, n), "sketches", made)
    classes = written(found.where("node IS NOT NULL").groupBy("node").agg(
        F.min(doc_id).alias("least"), F.count("*").alias("copies"),
        F.first("values").alias("values"), F.first("bands").alias("bands")), "classes", made)
    bands = classes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("_n")).where("_n > 1")
    ties = _together(_dealt(bands.join(shared, "band"), "band"), "band",
                     classes.select("node", "values")).mapInArrow(
        _provisional(threshold, tolerance), "a binary, b binary")
    groups = written(components(ties, early), "groups", made)
    for path in early:
        remove(docs.sparkSession, path)
    wanted = groups.select("node").join(classes, "node").select("node", "least", "copies", "values")
    sets = _with_sets(docs, wanted.select("node", "least"), doc_id, text, n)
    sizes = groups.groupBy("root").agg(F.count("*").alias("_n"))
    verified = written(_together(
        _dealt(groups.join(sizes, "root"), "root"), "root",
        wanted.drop("least").join(sets, "node")).mapInArrow(
        _verified(threshold, tolerance), "node binary, links long, tie binary"), "verified", made)
    roots = components(verified.select(F.col("node").alias("a"), F.col("tie").alias("b")), made)
    links = verified.groupBy(F.col("node").alias("_v")).agg(F.sum("links").alias("links"))
    named = classes.select("node", "least", "copies").join(roots, "node", "left").join(
        links, F.col("node") == F.col("_v"), "left").select(
        "node", "least", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = named.groupBy(F.col("root").alias("_r")).agg(F.min("least").alias("class_id"))
    named = named.join(least, F.col("root") == F.col("_r")).select(
        F.col("node").alias("_node"), "class_id", "n_links", F.col("least").alias("copy_id"))
    alone = F.col("_node").isNull()
    return found.select(doc_id, "node").join(named, F.col("node") == F.col("_node"), "left").select(
        doc_id, F.when(alone, F.col(doc_id)).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col(doc_id)).otherwise(F.col("copy_id")).alias("copy_id"))


def keep_one_row(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 **options) -> DataFrame:
    """docs with one row of each group of near copies, each row judged by its own text, also where
    rows share an id or have none: the row with the least id (nulls last) and, among those, the
    least hash of its text. Rows without a word stay, but of exact repeats with an id one does.
    Columns stay as they are.

    Rows are judged on their keys; the documents meet only the keys of rows that go, broadcast if
    they are few."""
    key, made = fresh("key"), []
    named = docs.select(row_key(doc_id, text).alias(key), text)
    found = near_duplicates(named, doc_id=key, text=text, made=made, **options)
    gone = F.col(key) != F.col("class_id")
    # of repeats one row stays; they have links to each other unless they have no word
    judged = found.groupBy(key).agg(
        F.max(gone).alias("gone"),
        ((F.count("*") > 1) & ((F.max("n_links") > 0) | ~F.col(f"{key}.no"))).alias("again"))
    judged = written(judged.where("gone OR again"), "judged")
    for path in made:
        remove(docs.sparkSession, path)
    kept = in_rows(docs, judged.where("gone"), key, doc_id, text, "left_anti")
    again = judged.where("again AND NOT gone")
    if again.isEmpty():
        return kept
    h = fresh("hash")
    one = in_rows(kept, again, key, doc_id, text, "left_semi").withColumn(h, F.xxhash64(text))
    return in_rows(kept, again, key, doc_id, text, "left_anti").unionByName(
        one.dropDuplicates([doc_id, h]).drop(h))
