"""Ball k-means against all distances."""

import hashlib
import random

import numpy as np
import pytest

from tradepath.llm import ball_codes


def plain(rows, parts=16, entries=64, rounds=2):
    """vec_id, code, error, label_error, checksum by comparing each part with each entry."""
    good = [r for r in rows if r[1] is not None and all(
        x is not None and np.isfinite(x) for x in r[1])]
    lengths = [len(r[1]) for r in good if r[1] and len(r[1]) % parts == 0]
    if not lengths:
        return []
    size = min(set(lengths), key=lambda n: (-lengths.count(n), n))
    good = [r for r in good if len(r[1]) == size]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[int(np.floor(256 * np.float64(np.float32(x)))) for x in r[1]] for r in good]
    step = size // parts
    cut = [[tuple(v[m * step:(m + 1) * step]) for m in range(parts)] for v in ints]
    books = [[v[m] for v in cut[:entries]] for m in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for m in range(parts):
            held = {}
            for v in cut:
                held.setdefault(nearest(v[m], books[m])[1], []).append(v[m])
            books[m] = [tuple(sum(k) // len(held[e]) for k in zip(*held[e])) if e in held else c
                        for e, c in enumerate(books[m])]
    check = hashlib.sha256(",".join(
        str(k) for book in books for c in book for k in c).encode()).hexdigest()
    out, labels = [], {}
    for r, v in zip(good, cut):
        best = [nearest(x, books[m]) for m, x in enumerate(v)]
        error = sum(d for d, _ in best)
        labels[r[2]] = labels.get(r[2], 0) + error
        out.append((r[0], "".join(f"{e:02x}" for _, e in best), error, r[2]))
    return [(i, code, error, labels[label], check) for i, code, error, label in out]


def vectors(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "x") for r in rows],
        "vec_id long, embedding array<float>, label int, code int, _label string")


def drawn(seed, n, size=32, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(size)] for _ in range(5)]
    return [(i, [c + draw.gauss(0, spread) for c in draw.choice(centres)],
             draw.choice([None, 1, 2, 3])) for i in range(n)]


def same(spark, rows, **options):
    got = ball_codes.encode(vectors(spark, rows).repartition(3), **options).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain(rows, **options)))
    return got


@pytest.mark.parametrize("spread", [0.01, 0.3, 2.0])
def test_against_all_distances(spark, spread):
    assert len(same(spark, drawn(1, 300, spread=spread))) == 300


def test_ties_and_repeats(spark):
    """Small whole steps: many equal distances, equal parts and equal entries."""
    draw = random.Random(3)
    rows = [(i // 2, [draw.randint(-1, 1) / 256 for _ in range(32)], i % 3) for i in range(200)]
    same(spark, rows + rows[:50])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = drawn(5, 40, 16)
    rows += [(100, None, 1), (101, [], 1), (102, [0.5] * 15 + [None], 2), (103, [nan] * 16, 2),
             (104, [inf] + [0.0] * 15, None), (105, [0.0] * 15 + [-inf], 3), (106, [1.0] * 32, 1),
             (107, [1.0] * 17, 1), (None, [0.25] * 16, None), (None, [-0.25] * 16, 9),
             (3, [-1.5] * 16, 1), (2 ** 40, [0.5] * 16, 1)]
    got = same(spark, rows)
    assert {r.vec_id for r in got}.isdisjoint(range(100, 108))
    assert ball_codes.encode(vectors(spark, rows).limit(0)).collect() == []
    assert ball_codes.encode(vectors(spark, rows[40:48])).count() == 1
    assert ball_codes.encode(vectors(spark, [(1, None, 1), (2, [1.0], 2)])).collect() == []


def test_other_sizes(spark):
    same(spark, drawn(6, 80, 12), parts=4, entries=7, rounds=3)
    same(spark, drawn(7, 30, 12), parts=3, entries=1, rounds=1)
    same(spark, drawn(8, 30, 12), parts=3, entries=5, rounds=0)
    with pytest.raises(ValueError):
        ball_codes.encode(vectors(spark, []), entries=300)


def test_balls_spare_comparisons():
    draw = np.random.default_rng(2)
    entries = np.floor(draw.normal(0, 4000, (64, 4)))
    x = np.floor(np.repeat(entries, 200, 0) + draw.normal(0, 100, (12800, 4)))
    at, least, _ = ball_codes.nearest(x, np.zeros(len(x), np.int64), entries)
    far = ((x[:, None] - entries[None]) ** 2).sum(-1)
    assert (at == far.argmin(1)).all() and (least == far.min(1)).all()
    again, _, compared = ball_codes.nearest(x, at, entries)
    assert (again == at).all() and compared < len(x)  # of 63 for each part
