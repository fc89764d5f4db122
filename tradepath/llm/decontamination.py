"""Benchmark decontamination: size-partitioned MinHash containment search.

A document contains a test item if it has at least `threshold` of the item's distinct shingles
(runs of `n` words). Items fall into partitions by size, a power of two each. An item's sketch is
its k smallest shingle hashes (a bottom-k MinHash), with k from the largest size u of its
partition: k = floor((1 - threshold) * u) + 1. A document that contains the item misses at most
k - 1 of its shingles, so it has a shingle of the sketch: the search loses no pair. Documents that
are too short for a partition are not looked up in it. Pairs that meet in a sketch are verified on
the shingles themselves, word for word.

Only the sketches (a few hashes per item) meet all shingles; their number is counted and they are
broadcast if small, otherwise the join is shuffled. Only documents that met a sketch are verified.

Defined results: a null or empty text has no shingle; an item with fewer than n words has none and
is never found; rows that repeat an id are one document (or item) with the union of their
shingles; a null id is an id like any other; empty tables give an empty result; other columns of
the inputs are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepath.llm.common import fresh, in_rows, keep_ids, row_key, small_side, words

WORDS_PER_SHINGLE = 5
THRESHOLD = 0.8


def _at(i: int) -> Column:
    return F.get("_words", F.col("_at") + i)


def _shingles(df: DataFrame, key: str, text: str, n: int, exact: bool) -> DataFrame:
    """A row for each place: _key, _total (places of the text), _hash, and _shingle if exact."""
    last = F.size("_words") - n
    out = df.select(F.col(key).alias("_key"), words(F.col(text)).alias("_words")).select(
        "_key", "_words", (last + 1).alias("_total"),
        F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("_at"),
    )
    parts = [_at(i) for i in range(n)]
    shingle = [F.concat_ws(" ", *parts).alias("_shingle")] if exact else []
    return out.select("_key", "_total", F.xxhash64(*parts).alias("_hash"), *shingle)


def _needed(size: Column, threshold: float) -> Column:
    """The shingles a document needs at least; the small term keeps 0.8 * 5 at 4."""
    return F.ceil(size * F.lit(threshold) - F.lit(1e-9))


def contained_items(docs: DataFrame, items: DataFrame, n: int = WORDS_PER_SHINGLE,
                    threshold: float = THRESHOLD, doc_id: str = "doc_id",
                    item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, n_shingles, n_shared, containment) of documents and the items that
    they contain."""
    known = _shingles(items, item_id, text, n, exact=True).select(
        F.col("_key").alias("_item"), "_hash", "_shingle").distinct()
    sizes = known.groupBy("_item").agg(
        F.count("*").alias("_size"), F.array_sort(F.collect_list("_hash")).alias("_hashes"))
    # the partition of sizes from low to 2 * low - 1
    low = F.pow(F.lit(2), F.floor(F.log2("_size") + F.lit(1e-9))).cast("long")
    k = (F.floor((low * 2 - 1) * F.lit(1 - threshold) + F.lit(1e-9)) + 1).cast("int")
    sketches = sizes.select("_item", _needed(low, threshold).alias("_least"),
                            F.explode(F.slice("_hashes", 1, k)).alias("_hash"))
    # candidates: documents that are long enough for the partition and have a hash of the sketch
    places = _shingles(docs, doc_id, text, n, exact=False)
    met = places.join(small_side(sketches), "_hash").where("_total >= _least")
    candidates = met.select("_key").distinct().withColumnRenamed("_key", doc_id)
    # exact containment of what is left
    some = keep_ids(docs.select(doc_id, text), candidates, doc_id)
    shared = (
        _shingles(some, doc_id, text, n, exact=True)
        .join(small_side(known), ["_hash", "_shingle"])
        .groupBy("_key", "_item", "_hash", "_shingle").agg(F.lit(1).alias("_one"))
        .groupBy("_key", "_item").agg(F.count("*").alias("n_shared"))
    )
    sizes = sizes.select(F.col("_item").alias("_of"), F.col("_size").alias("n_shingles"))
    return (
        shared.join(sizes, F.col("_item").eqNullSafe(F.col("_of")))
        .where(F.col("n_shared") >= _needed(F.col("n_shingles"), threshold))
        .select(F.col("_key").alias(doc_id), F.col("_item").alias(item_id), "n_shingles",
                "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))
    )


def drop_contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   **options) -> DataFrame:
    """docs without the rows that contain an item, each row judged by its own text, also where rows
    share an id or have none. Columns stay as they are."""
    key = fresh("key")
    named = docs.select(row_key(doc_id, text).alias(key), text)
    found = contained_items(named, items, doc_id=key, text=text, **options)
    return in_rows(docs, found, key, doc_id, text, "left_anti")


CONTAINED_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM {docs}),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w),
bw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
b AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM bw),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY 1)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
FROM s JOIN b USING (s) JOIN n USING (item_id) GROUP BY 1, 2, 3
HAVING count(*) >= ceil(n_shingles * 0.8 - 1e-9)"""
