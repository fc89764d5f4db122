import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import EDGES, documents, prose
from tradepath.llm import repeats


def plain(rows, span=repeats.SPAN):
    """What the operator returns, window by window; rows are in a list, as ids may repeat."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k:k + span] for _, b in texts for k in range(len(b) - span + 1))
    out = []
    for i, b in texts:
        covered = np.zeros(len(b) + 2, bool)
        for k in range(len(b) - span + 1):
            if count[b[k:k + span]] > 1:
                covered[k + 1:k + span + 1] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~covered[1:-1]])
        out.append((i, len(b), int(covered.sum()), int((np.diff(covered.astype(int)) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(docs, **options):
    rows = repeats.remove_repeats(docs, **options)
    return sorted((tuple(r) for r in rows.collect()), key=str)


def test_edges(spark):
    assert found(documents(spark, EDGES)) == plain([r[:2] for r in EDGES])


def test_empty_table(spark):
    assert found(documents(spark, [])) == []


def passages():
    """Passages in many contexts, near copies, a common line, strings of just 199 and 200 bytes."""
    base, line = prose(1, 400), prose(2, 12)
    rows = [(i, prose(100 + i, 60) + " " + base[200:700] + " " + prose(200 + i, 60)) for i in range(20)]
    words = base.split()
    for i in range(20):
        near = list(words)
        near[(i * 37) % len(near)] = f"w{i}"
        rows.append((100 + i, line + "\n" + " ".join(near)))
    edge = prose(3, 200)[:200]
    rows += [(200, "x" + edge[:199] + "y"), (201, "z" + edge[:199] + "u"), (202, "p" + edge + "q"),
             (203, "r" + edge + "s"), (204, base[:900] * 3)]
    return rows


@pytest.mark.parametrize("group", [repeats.GROUP, 1, 4])
def test_passages(spark, group):
    """Crowded anchors, which are counted window by window, give the same."""
    rows = passages()
    assert found(documents(spark, rows), group=group) == plain(rows)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    text = prose(5, 4000)
    rows = [(1, text), (2, prose(6, 100) + text[5000:9000] + prose(7, 2000)), (3, prose(8, 3000))]
    data = [t.encode() for _, t in rows]

    def runs(size):
        monkeypatch.setattr(repeats, "_SLICE", size)
        out = set()
        for parts in repeats._slices(data, repeats.SPAN):
            for i, begin, part in parts:
                out.update((i, begin + k) for k in range(len(part) - repeats.SPAN + 1))
        return out

    assert runs(1000) == runs(1 << 20)
    assert found(documents(spark, rows)) == plain(rows)


def test_kept_bytes(spark):
    rows = [(1, "a" * 150 + prose(1, 80)), (2, prose(1, 80)), (3, "short")]
    out = {r["doc_id"]: r for r in repeats.remove_repeats(documents(spark, rows),
                                                          with_bytes=True).collect()}
    for r in out.values():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    assert bytes(out[3]["kept"]) == b"short"


def test_prefix_intervals():
    words = sorted(["banana", "band", "ban", "bad", "can", "cane"])
    common = [len([1 for i in range(min(len(a), len(b))) if a[:i + 1] == b[:i + 1]])
              for a, b in zip(words, words[1:])]
    got = set(repeats.prefix_intervals(np.array(common)))
    want = set()
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            low = min(common[i:j])
            first, last = i, j
            while first and common[first - 1] >= low:
                first -= 1
            while last < len(common) and common[last] >= low:
                last += 1
            want.add((low, first, last))
    assert got == want


def test_maximal_repeats_have_all_occurrences():
    text = [b"..lefthereanchor+right side", b"##lefthereanchor+right sidX", b"lefthereanchor+riYYY",
            b"mmmmhereanchor+right side"]
    at = [t.index(b"anchor") for t in text]
    groups = {(left + right, tuple(sorted(places.tolist()))) for left, right, places in
              repeats.maximal_repeats(np.zeros(4, np.int64), [t[:a][::-1] for t, a in zip(text, at)],
                                      [t[a:] for t, a in zip(text, at)], 12)}
    assert (len(b"lefthereanchor+right sid"), (0, 1)) in groups
    assert (len(b"lefthereanchor+ri"), (0, 1, 2)) in groups
    assert (len(b"hereanchor+right side"), (0, 3)) in groups
    assert (len(b"hereanchor+right sid"), (0, 1, 3)) in groups
