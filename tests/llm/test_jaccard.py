import os
import re
from collections import Counter, defaultdict

import numpy as np

from tests.llm.helpers import EDGES, documents, prose
from tradepath.llm import jaccard

WORD = re.compile(r"[^\W_]+")


def shingles(text, n=5):
    w = WORD.findall((text or "").lower())
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def plain(rows, threshold=0.8):
    """Links and groups of all pairs."""
    sets = [shingles(t) for _, t in rows]
    places = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            places[x].append(i)
    root, links = list(range(len(rows))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in places[x] if j > i).items():
            if both / (len(s) + len(sets[j]) - both) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(j)] = find(i)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)].append(key)
    return sorted(((key, min(least[find(i)], default=None) if sets[i] else key, links[i])
                   for i, (key, _) in enumerate(rows)), key=str)


def found(docs, **options):
    rows = jaccard.near_duplicates(docs, **options).select("doc_id", "class_id", "n_links")
    return sorted((tuple(r) for r in rows.collect()), key=str)


def copies():
    rows = [(i, prose(1000 + i, 120)) for i in range(15)]
    words = prose(5, 150).split()
    for i in range(40):
        near = list(words)
        for k in range(i % 7):
            near[(i * 31 + k * 17) % len(near)] = f"w{i}x{k}"
        rows.append((100 + i, " ".join(near)))
    return rows


def test_edges(spark):
    rows = [r[:2] for r in EDGES]
    assert found(documents(spark, EDGES)) == plain(rows)


def test_empty_table(spark):
    assert found(documents(spark, [])) == []


def test_near_copies(spark):
    rows = copies()
    assert found(documents(spark, rows)) == plain(rows)


def test_blocks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rows = copies()
    assert found(documents(spark, rows)) == plain(rows)


def test_least_matches():
    """The bound is where the posterior, integrated, falls below the tolerance."""
    least = jaccard.least_matches(0.8, 1e-6)
    grid = (np.arange(20000) + 0.5) / 20000
    for n in (16, 64, 128):
        for m, drop in ((least[n], False), (least[n] - 1, True)):
            if m < 0:
                continue
            density = grid**m * (1 - grid)**(n - m)
            assert (density[grid >= 0.8].sum() / density.sum() < 1e-6) == drop


def test_keep_one_row_keeps_columns(spark):
    docs = documents(spark, EDGES)
    kept = jaccard.keep_one_row(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    # 6 stands for two texts, one of them listed twice; 8 is a copy of it
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(
        ["1", "2", "3", "4", "5", "6", "6", "None", "None", "10", "11", "12", "13"])


def test_working_tables_are_removed(spark):
    made = []
    df = jaccard.near_duplicates(documents(spark, copies()), made=made)
    df.count()
    before = {p for p in made if spark.read.parquet(p).count() >= 0}
    assert len(before) == len(made) >= 5
    folder = os.path.dirname(made[0])
    listed = set(os.listdir(folder))
    kept = jaccard.keep_one_row(documents(spark, copies()))
    assert {p.split("-")[0] for p in set(os.listdir(folder)) - listed} == {"judged"}
    assert kept.count() > 0


def test_a_byte_of_each_value_drops_no_pair():
    """Pairs at or above the threshold outlast the comparison as they do with whole values."""
    draw = np.random.default_rng(4)
    left = draw.integers(0, 2**32, (400, jaccard.HASHES), dtype=np.uint32)
    right = np.where(draw.random(left.shape) < draw.uniform(0.3, 1, (400, 1)), left,
                     draw.integers(0, 2**32, left.shape, dtype=np.uint32))
    at = np.arange(400)
    whole = jaccard.surviving(left, right, at, at, 0.8, 1e-6)
    short = jaccard.surviving(left.astype(np.uint8), right.astype(np.uint8), at, at, 0.8, 1e-6)
    assert set(whole) <= set(short) and len(short) < len(whole) + 20
