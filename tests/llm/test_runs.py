"""Runs and extensions against their definitions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tests.llm.helpers import EDGES, LONG, documents

from tradepath.llm import runs


def plain_runs(w, least=12):
    """Runs start, length, period of a list by comparing neighbours at every distance."""
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, before = len(words), list(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [before[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def drawn(draw):
    n, letters = draw.choice([0, 1, 5, 12, 30, 100, 300]), draw.choice([1, 2, 3, 5, 50])
    w = [draw.randrange(letters) for _ in range(n)]
    if n and draw.random() < 0.5:
        a = draw.randrange(n)
        p = 1 + (n - a) // draw.randint(2, 9)
        w = w[:a] + [w[a + i % p] for i in range(n - a)]
    return w


def test_runs_of_drawn_sequences():
    draw = random.Random(4)
    for _ in range(120):
        texts, least = [drawn(draw) for _ in range(draw.randint(1, 6))], draw.choice([2, 4, 12])
        got = runs.find([np.array(t, np.int64) for t in texts], least)
        assert [[tuple(map(int, r)) for r in g] for g in got] == [plain_runs(t, least) for t in texts]


def test_fibonacci_word():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert [tuple(map(int, r)) for r in runs.find([np.array(b)])[0]] == plain_runs(b)


@pytest.mark.parametrize("period,cover", [(31, runs.COVER), (7, (0, 1, 3)), (13, (0, 1, 3, 9))])
def test_extensions(period, cover):
    draw = random.Random(period)
    texts = [t for t in (drawn(draw) for _ in range(12)) if len(t) > 4]
    w = np.array([x for n, t in enumerate(texts) for x in [*t, 100 + n]], np.int64)
    of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    table = runs.Extensions(w, of, period, cover)
    table.sample(np.ones(len(texts), bool))
    pairs = [(i, j) for n in range(len(texts)) for at in [np.flatnonzero(of == n)]
             for i, j in [draw.sample(list(at), 2) for _ in range(40)]]
    i, j = np.array(pairs).T
    found, open_ = table.few(i, j)
    at = np.flatnonzero(open_)
    found[at] = table.beyond(i[at], j[at], found[at])
    for a, b, n in zip(i, j, found):
        m = 0
        while max(a, b) + m < len(w) and w[a + m] == w[b + m]:
            m += 1
        assert n == m
    assert len(at) > 20


def test_no_difference_cover():
    with pytest.raises(ValueError):
        runs.meeting(31, (0, 1, 2))


def test_query_columns(spark):
    draw = random.Random(8)
    rows = [(i, draw.choice([" ", "\t", "\n", "\x0b", "\r\n"]).join(
        f"w{x}é" if x else "a\xa0b\x1c" for x in drawn(draw))) for i in range(150)]
    rows += [(r[0], r[1]) for r in EDGES if r[1] is not LONG] + [(None, "x " * 40), (0, "y z " * 30)]
    got = runs.digest(runs.rewritten(documents(spark, rows).repartition(3))).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain_row(*r)) for r in rows)
    assert sum(r.n_runs > 0 for r in got) > 20


def test_long_text_and_packs(spark, monkeypatch):
    phrase = [f"p{i}" for i in range(700)]
    text = LONG.split() + phrase * 3 + ["end"] + LONG.split()[:500]
    found = runs.find_runs(documents(spark, [(1, " ".join(text)), (2, "b " * 50_000), (3, "c")])).collect()
    by = {r.doc_id: r for r in found}
    start = text.index("p0")
    assert (start, 2100, 700) in [tuple(r) for r in by[1].runs]
    assert [tuple(r) for r in by[2].runs] == [(0, 50_000, 1)] and by[2].collapsed == "b"
    assert by[3].runs == [] and by[3].collapsed == "c"


def test_empty_table(spark):
    docs = documents(spark, EDGES).limit(0)
    assert runs.digest(runs.rewritten(docs)).collect() == []
