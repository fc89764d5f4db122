import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import EDGES, documents, prose
from tradepath.llm import fingerprints, packing, separators


def test_token_counts(spark):
    encode = packing.encoder(ordinary=True)
    rows = [*EDGES, (70, "a <|endoftext|> b"), *((100 + i, prose(i, i * 3)) for i in range(80))]
    out = separators.count_tokens(documents(spark, rows).repartition(3), block=64)
    got = sorted(((r["doc_id"], r["n_tokens"]) for r in out.collect()), key=str)
    assert got == sorted(((k, len(encode(t or ""))) for k, t, *_ in rows), key=str)


def test_empty_table(spark):
    assert separators.count_tokens(documents(spark, [])).collect() == []
    assert fingerprints.compare_with_next(documents(spark, [])).collect() == []


@pytest.mark.parametrize("super_size", [1024, 2, 3])
def test_scan_stitches_blocks(spark, monkeypatch, super_size):
    """Blocks without a separator, with many, cut anywhere, and a document without an end."""
    monkeypatch.setattr(separators, "SUPER", super_size)
    draw = np.random.default_rng(0)
    rows, want = [], []
    for file, size in enumerate([200, 7, 1, 64, 0, 333]):
        ids = draw.integers(0, 9, size) + 1
        ids[draw.random(size) < [0.02, 0.5, 1.0, 0.0, 0.0, 0.1][file]] = 0
        rows += [(file, i, ids[at:at + 8].astype("<u2").tobytes())
                 for i, at in enumerate(range(0, size, 8))]
        start, number = 0, 0
        for end in [*np.flatnonzero(ids == 0).tolist(), size]:
            if end < size or end > start:
                want.append((file, number, start, end - start, end < size))
            start, number = end + 1, number + 1
    blocks = spark.createDataFrame(rows, "file long, at long, tokens binary").repartition(5)
    out = separators.document_lengths(separators.find_separators(blocks, 0))
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


def plain_next(rows):
    rows = sorted(((k, t or "") for k, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (k, t) in enumerate(rows):
        other, half = rows[(i + 1) % len(rows)][1], len(t) // 2
        out.append((k, len(t), hashlib.sha256((t[:len(t) - half] + other[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [2000, 7, 1])
def test_next_documents(spark, part_bytes):
    rows = [r for r in EDGES if r[0] not in (6, None)] + [(None, prose(9, 80), "en", "s0")]
    rows += [(100 + 3 * i, prose(i, 10 + 7 * i)) for i in range(40)]
    docs = documents(spark, rows).repartition(4)
    out = fingerprints.compare_with_next(docs, part_bytes=part_bytes)
    got = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out.collect()), key=str)
    assert got == plain_next(rows)


def test_rows_that_repeat_an_id(spark):
    out = fingerprints.compare_with_next(documents(spark, EDGES), part_bytes=300).collect()
    assert len(out) == len(EDGES)


def entropy(window):
    p = np.bincount(window) / len(window)
    p = p[p > 0]
    return -(p * np.log2(p)).sum() / np.log2(fingerprints.WINDOW) * fingerprints.LEVELS


def test_levels_against_plain():
    texts = [prose(1, 80).encode(), b"a" * 100, b"", b"short", bytes(range(256)), prose(2, 60).encode()]
    for text, levels in zip(texts, fingerprints.levels_of(texts)):
        data = np.frombuffer(text, np.uint8)
        want = [entropy(data[i:i + fingerprints.WINDOW]) for i in range(len(data) - fingerprints.WINDOW + 1)]
        assert len(levels) == len(want) and np.abs(levels - want).max(initial=0) <= 0.5 + 1e-6
    before, behind = texts[0], texts[5]
    levels = fingerprints.levels_of([before, behind])
    for keep in (0, 10, 63, 64, 200, len(before)):
        for take in (0, 5, 63, 64, 150):
            both = fingerprints.spliced(before, levels[0], keep, behind[:take], levels[1])
            assert (both == fingerprints.levels_of([before[:keep] + behind[:take]])[0]).all()


def test_likeness(spark):
    rows = [(i, prose(i, 300)) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1])]
    out = {r["doc_id"]: r for r in fingerprints.compare_with_next(documents(spark, rows)).collect()}
    assert out[0]["fingerprint"] == out[100]["fingerprint"] and out[100]["near_next"] == 1.0
    near = [out[i]["near_edited"] for i in range(60)]
    far = [out[i]["near_next"] for i in range(59)]
    assert np.mean([a > b for a in near for b in far]) > 0.95
    assert all(0 <= x <= 1 for x in near + far)


def test_equal_texts_have_equal_fingerprints_wherever_they_lie(spark):
    text = prose(5, 400)
    rows = [(i, text if i % 7 == 3 else prose(100 + i, 50 + i)) for i in range(80)]
    out = fingerprints.compare_with_next(documents(spark, rows), part_bytes=4000)
    assert out.where(F.col("doc_id") % 7 == 3).select("fingerprint").distinct().count() == 1


def plain_places(levels, ranks):
    """Windows that are the leftmost of the rarest level in some neighbourhood."""
    n = len(levels)
    width = min(fingerprints.NEIGHBOURS, n)
    votes = [0] * n
    for start in range(n - width + 1 if n else 0):
        votes[min(range(start, start + width), key=lambda i: (ranks[levels[i]], i))] += 1
    least = min(fingerprints.VOTES, n - width + 1)
    return [i for i in range(n) if votes[i] >= least and levels[i] >= fingerprints.LOWEST]


def stirred(x):
    for by, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> by)) * times) % 2**64
    return x ^ (x >> 31)


def plain_chain(data, places):
    """Sets of bits of the filters, and how many features each has."""
    hashes = []
    for i in places:
        h = 0
        for k in range(0, fingerprints.WINDOW, 8):
            word = int.from_bytes(data[i + k:i + k + 8], "little")
            h = stirred((h + word + k // 8 + 1) % 2**64)
        if h not in hashes:
            hashes.append(h)
    hashes = hashes or [int.from_bytes(hashlib.sha256(data).digest()[:8], "little")]
    chain = [hashes[i:i + fingerprints.PER_FILTER]
             for i in range(0, len(hashes), fingerprints.PER_FILTER)]
    return [{(h >> (11 * i)) % fingerprints.FILTER_BITS for h in part for i in range(5)}
            for part in chain], [len(part) for part in chain]


def plain_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    if len(a[1]) > len(b[1]):
        a, b = b, a
    total = 0.0
    for one, n in zip(*a):
        best = 0.0
        for other in b[0]:
            chance = len(one) * len(other) / fingerprints.FILTER_BITS
            most = min(len(one), len(other))
            least = chance + fingerprints.FLOOR * (most - chance)
            best = max(best, min(1, max(0, (len(one & other) - least) / max(most - least, 1e-9))))
        total += best * n
    return total / sum(a[1])


def test_features_filters_and_likeness_against_plain():
    texts = [prose(i, 2 + 11 * i).encode() for i in range(14)]
    texts += [texts[12] + texts[3], texts[12][:300] + texts[11], b"", b"ab", b"12345678", b"a" * 90]
    all_levels = fingerprints.levels_of(texts)
    counts = Counter(x for levels in all_levels for x in levels.tolist())
    order = sorted(range(fingerprints.LEVELS + 1), key=lambda x: (counts[x], -x))
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.arange(len(order))
    marks, plain = [], []
    for data, levels in zip(texts, all_levels):
        places = fingerprints.feature_places(levels, ranks)
        assert places.tolist() == plain_places(levels.tolist(), ranks)
        filters, sizes = fingerprints.fingerprint(data, levels, ranks)
        bits = [set(np.flatnonzero(np.unpackbits(f))) for f in filters]
        marks.append((filters, sizes))
        plain.append(plain_chain(data, places))
        assert (bits, sizes.tolist()) == plain[-1]
    for a, x in zip(marks, plain):
        for b, y in zip(marks, plain):
            if len(a[1]) != len(b[1]) or a is b:
                assert fingerprints.likeness(a, b) == pytest.approx(plain_likeness(x, y))
            assert fingerprints.likeness(a, b) == fingerprints.likeness(b, a)
    assert max(len(p[1]) for p in plain) > 2


def test_short_texts(spark):
    """Half of a text of 16 to 200 bytes is told from another text."""
    rows = []
    for i in range(300):
        text = prose(i, 60).capitalize()
        rows.append((i, text[:16 + (i * 37) % 184]))
    out = fingerprints.compare_with_next(documents(spark, rows)).collect()
    edited = np.array([r["near_edited"] for r in out])
    other = np.array([r["near_next"] for r in out])
    assert edited.mean() > 0.2 and (edited > other).mean() > 0.95


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(20,3)", "double", "binary"])
def test_ids_of_any_type(spark, kind):
    days = F.date_add(F.lit("2024-01-01").cast("date"), F.col("doc_id").cast("int"))
    made = {"date": days, "timestamp": days.cast("timestamp"),
            "string": F.concat(F.lit("k"), F.lpad(F.col("doc_id").cast("string"), 5, "0")),
            "binary": F.concat(F.lit("k"), F.lpad(F.col("doc_id").cast("string"), 5, "0")).cast("binary")}
    rows = [(i, prose(i, 12)) for i in range(70)] + [(None, prose(99, 9))]
    docs = documents(spark, rows)
    typed = docs.withColumn("doc_id", made[kind] if kind in made else F.col("doc_id").cast(kind))
    out = fingerprints.compare_with_next(typed, part_bytes=150).collect()
    assert len(out) == 71 and sum(r["doc_id"] is None for r in out) == 1
    assert Counter(r["edited_sha256"] for r in out) == Counter(
        r["edited_sha256"] for r in fingerprints.compare_with_next(docs).collect())


def test_ranges_are_of_bounded_size(spark):
    """Rows of one id are split between ranges, but for rows that repeat a text as well."""
    docs = documents(spark, [(7, prose(i, 20)) for i in range(200)])
    sizes = fingerprints.with_next(docs, "doc_id", "text", 1000).where("last = 0").groupBy(
        "part").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert len(sizes) > 10 and max(r["n"] for r in sizes) < 1300


def test_texts_are_held_in_pieces_of_bounded_bytes():
    texts = [None, "", "ab" * 150_000, *["x" * 2000] * 700, *["y"] * 1200]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    found = [p.column(0).to_pylist() for p in fingerprints.pieces(batch, 0)]
    assert [t for p in found for t in p] == texts
    for piece in found:
        assert len(piece) <= 512
        assert len(piece) == 1 or sum(len(t or "") for t in piece) <= 1 << 18
