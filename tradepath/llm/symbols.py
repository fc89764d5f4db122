"""Code points as symbols for character models."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Letters of the basic plane have symbols of their own; rarer ones share theirs with one of these.
SYMBOL_BITS = 16


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point its lower-case one if it is a letter, else 0."""
    out = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """Letters folded into symbols from 1; 0 is the separator."""
    points = letters().astype(np.int64)
    return np.where(points > 0, points % ((1 << SYMBOL_BITS) - 1) + 1, 0)


def packs(sizes: np.ndarray, limit: int = 1 << 18):
    """(begin, end) of stretches of texts of `limit` bytes or letters together, a longer text alone:
    what a task holds in arrays at a time."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield at, end
        at = end


def text_sizes(texts) -> np.ndarray:
    """The lengths of texts, which may be null."""
    return np.fromiter((len(t) if t else 0 for t in texts), np.int64)


def symbols(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts that lie one behind the other in UTF-32, with a separator before and after
    each and runs of separators as one; and the number of the text of each symbol. ends: where
    each text ends, in code points."""
    syms = folded()[np.frombuffer(data, "<u4")]
    of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    # a separator before and one behind each text
    edges = np.concatenate([ends - np.diff(ends, prepend=0), ends])
    texts = np.tile(np.arange(len(ends)), 2)
    order = np.argsort(texts, kind="stable")
    syms = np.insert(syms, edges[order], 0)
    of = np.insert(of, edges[order], texts[order])
    keep = np.ones(len(syms), bool)
    keep[1:] = (syms[1:] != 0) | (syms[:-1] != 0) | (of[1:] != of[:-1])
    return syms[keep], of[keep]


@lru_cache(maxsize=1)
def word_symbols() -> np.ndarray:
    """For each code point its lower-case one if it is a letter or a digit, else 0."""
    out = letters().astype(np.uint64)
    for c in range(0x110000):
        if not out[c] and chr(c).isnumeric():
            out[c] = c
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, stirred."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(points: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that lie one behind the other, and the number of the
    text of each. Words are runs of letters and digits in lower case."""
    syms = word_symbols()[points]
    inside = syms != 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | (of[1:] != of[:-1])
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, of.dtype)
    # a word's hash: the sum of its stirred (symbol, place) pairs; places count from its start
    number = np.cumsum(begin) - 1
    place = np.arange(len(syms)) - starts[np.maximum(number, 0)]
    stirred = mix(syms * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
    stirred[~inside] = 0
    return mix(np.add.reduceat(stirred, starts)), of[starts]


def word_shingles(texts, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """64-bit hashes of all runs of n words of an Arrow column of texts, the number of the text of
    each, and the number of texts. Words are runs of letters and digits in lower case; a text
    with fewer words has one shingle of all of them, a null text none."""
    raw = [(t.as_py() or "").encode("utf-32-le") for t in texts]
    ends = np.cumsum([len(r) // 4 for r in raw], dtype=np.int64)
    of = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))
    words, word_of = word_hashes(np.frombuffer(b"".join(raw), "<u4"), of)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), len(ends)
    count = np.bincount(word_of, minlength=len(ends))
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    # the place of each word in its text decides whether n words begin there
    left = (first + count)[word_of] - np.arange(len(words))
    whole = np.flatnonzero(left >= n)
    hashes = np.zeros(len(whole), np.uint64)
    for i in range(n):
        hashes = mix(hashes + words[whole + i] + np.uint64(i + 1))
    out, out_of = [hashes], [word_of[whole]]
    for t in np.flatnonzero((count > 0) & (count < n)):
        h = np.zeros(1, np.uint64)
        for i in range(count[t]):
            h = mix(h + words[first[t] + i:first[t] + i + 1] + np.uint64(i + 1))
        out.append(mix(h + np.uint64(count[t])))
        out_of.append(np.array([t], np.int32))
    return np.concatenate(out), np.concatenate(out_of), len(ends)
