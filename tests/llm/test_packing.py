import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import EDGES, documents, prose
from tradepath.llm import packing

SPELLED = (50, "before <|endoftext|> after")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check(rows, want, length):
    """Pieces cover their documents and fill sequences without gaps."""
    places, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append(r)
    for parts in places.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    for key, arrays in want.items():
        got = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in docs[key])
        expected = []
        for a in arrays:
            first = len(a) % length or length
            cuts = [0, *range(min(first, len(a)), len(a), length), len(a)] if len(a) > length else [0, len(a)]
            for i, (x, y) in enumerate(zip(cuts, cuts[1:])):
                expected.append((i, x, y - x, zlib.crc32(a[x:y].tobytes())))
        assert got == sorted(expected)
    return len(places)


@pytest.mark.parametrize("length", [1024, 7])
def test_pieces_and_places(spark, tokenizer, length):
    rows = [*EDGES[:11], SPELLED, *EDGES[12:], *((100 + i, prose(i, 20 + 9 * i)) for i in range(60))]
    want = defaultdict(list)
    for key, text, *_ in rows:
        want[key].append(ids(tokenizer, text))
    out = packing.pack_documents(documents(spark, rows), length).collect()
    n = check(out, want, length)
    total = sum(len(a) for arrays in want.values() for a in arrays)
    assert n <= 1.02 * total / length + 2


def test_ids_are_those_of_the_tokenizer(tokenizer):
    encode = packing.encoder()
    for text in (prose(1, 300), "Grüße  ñ 漢字 😀\n\n\t x's 123 ", SPELLED[1], "", "\0", "a" * 5000):
        assert (encode(text) == ids(tokenizer, text)[:-1]).all()


def test_several_groups(spark):
    docs = documents(spark, [(i, prose(i, 5 + i % 90)) for i in range(400)])
    out = packing.pack(packing.pieces(docs), group_pieces=50).collect()
    assert check(out, {}, 1024) > 0 and len(out) == 400


def test_real_sequences(spark, tokenizer):
    docs = documents(spark, [(i, prose(i, 100)) for i in range(30)])
    out = packing.pack_documents(docs, with_ids=True).collect()
    for r in out:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
    key = out[0]["doc_id"]
    assert b"".join(r["ids"] for r in out if r["doc_id"] == key) == ids(tokenizer, prose(key, 100)).tobytes()


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, [])).collect() == []


def test_rule():
    """Each size goes where the sum of squares becomes least, among open sequences with room."""
    draw = np.random.default_rng(0)
    sizes = sorted(draw.integers(1, 64, 300).tolist(), reverse=True)
    bins, offsets = packing.place(sizes, 64)
    gaps = {}
    for s, b, o in zip(sizes, bins, offsets):
        def squares(state):
            counts = np.bincount([g for g in state.values() if g > 0], minlength=65)
            return int((counts**2).sum())
        options = {x: squares({**gaps, x: g - s}) for x, g in gaps.items() if g >= s}
        if options:
            assert b in options and options[b] == min(options.values())
            assert o == 64 - gaps[b]
        else:
            assert b not in gaps and o == 0
        gaps[b] = gaps.get(b, 64) - s


def test_equal_pieces_are_dealt(spark):
    """A third of the rows repeat one id and text, with ids that doubles cannot hold among them."""
    rows = [(None, "a b")] * 300 + [(2**60 + i, f"t {i}") for i in range(600)]
    pieces = packing.pieces(documents(spark, rows)).withColumn("ids_crc32", F.lit(7).cast("long"))
    out = packing.pack(pieces, 64, group_pieces=100)
    seen = defaultdict(int)
    for r in out.collect():
        assert 0 <= r["offset"] <= 64 - r["length"]
        seen[(-1 - r["sequence_id"]) >> 32] += r["doc_id"] is None
    assert len(seen) == 9 and max(seen.values()) < 80
    assert {r["doc_id"] for r in out.collect()} == {None, *(2**60 + i for i in range(600))}
