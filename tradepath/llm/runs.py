"""Periodic runs of words, by longest common extensions from a difference cover.

Words are the stretches of a text without ASCII white space. A run is a stretch of at least LEAST
words and two periods in which words one period apart are the same, which no neighbour extends and
which has no smaller period.

Harmonic grid: a run with period q holds a multiple of q that is followed by an equal word q further
on, so for each q only the pairs (kq, kq + q) are looked at: n/1 + n/2 + ... of them. From a pair with
equal words the run reaches as far as the longest common extension (LCE) of both places, forward and
backward. Only the leftmost pair of a run, whose backward extension is under q, reports it.

LCE: the residues COVER modulo PERIOD hold every difference, so two places have equal distances of
under PERIOD words to two sampled places. Those few words are compared one by one; most pairs end
there. Beyond them the answer is the least common prefix between two sampled suffixes: these are
sorted (two words at a time, then by doubling, only what still ties), neighbours' common
prefixes come from the ranks of the doublings, and a sparse table gives the least of a range.
Suffixes are sampled only in texts with a pair that needs them.

Spark: every text is for itself; a task takes the texts of an Arrow batch in packs of about PACK
bytes, a longer text alone, with memory in proportion to it. Nothing is shuffled.

Defined results: a null or empty text has no words and no runs, its collapsed text is empty; equal
rows get equal results; an empty table gives an empty result; other columns are not read; with
`rewritten`, a row with a null id stays as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 12
#: a perfect difference cover: each difference modulo 31 occurs between two of the six residues
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
PACK = 1 << 20
_PAIRS = 1 << 19


def meeting(period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """For each difference d a residue of the cover whose sum with d is in the cover too."""
    out = np.full(period, -1)
    for a in cover:
        for b in cover:
            out[(b - a) % period] = a
    if (out < 0).any():
        raise ValueError("not a difference cover")
    return out


class Extensions:
    """LCE of places in a sequence of numbers in which each text ends with a number of its own."""

    def __init__(self, w: np.ndarray, of: np.ndarray, period: int = PERIOD,
                 cover: tuple[int, ...] = COVER):
        self.w, self.of, self.period = w, of, period
        self.meet = meeting(period, cover)
        self.sampled = np.isin(np.arange(period), cover)
        self.lcp = None

    def few(self, i: np.ndarray, j: np.ndarray, most: np.ndarray | None = None
            ) -> tuple[np.ndarray, np.ndarray]:
        """Equal words before the next two sampled places, but `most` at most; and which pairs are
        equal up to the sampled places (and not yet at `most`)."""
        ahead = (self.meet[(j - i) % self.period] - i) % self.period
        stop = ahead if most is None else np.minimum(ahead, most)
        found = np.zeros(len(i), np.int64)
        left = np.flatnonzero(stop > 0)
        for t in range(self.period - 1):
            left = left[self.w[i[left] + t] == self.w[j[left] + t]]
            found[left] = t + 1
            left = left[stop[left] > t + 1]
            if not len(left):
                break
        open_ = found == ahead
        return found, open_ if most is None else open_ & (ahead < most)

    def sample(self, needed: np.ndarray) -> None:
        """Sort the sampled suffixes of the texts that are marked in `needed`."""
        w, v = self.w, self.period
        self.places = places = np.flatnonzero(
            self.sampled[np.arange(len(w)) % v] & needed[self.of])
        self.number = np.full(len(w), -1, np.int32)
        self.number[places] = np.arange(len(places), dtype=np.int32)
        # suffixes of different texts are never compared: the text's number leads
        texts = self.of[places]
        rank = np.searchsorted(np.sort(texts), texts).astype(np.int64)
        self.names = []
        tied = _tied(rank, np.arange(len(places)))
        for t in range(0, v, 2):
            if not len(tied):
                break
            at = places[tied] + t
            key = w[at] << 32
            if t + 1 < v:
                # where the first word already ends a text, the second one does not matter
                key |= w[np.minimum(at + 1, len(w) - 1)]
            tied = _refine(rank, tied, key)
        step = v
        while len(tied):
            self.names.append(rank.copy())
            tied = _refine(rank, tied, rank[self.number[places[tied] + step]])
            step *= 2
        self.rank = rank
        order = np.empty(len(places), np.int64)
        order[rank] = np.arange(len(places))
        self.lcp = _sparse(self._neighbours(order[:-1], order[1:]))

    def _neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of pairs of sampled suffixes, from the ranks of the doublings."""
        x, y = self.places[a], self.places[b]
        out = np.zeros(len(a), np.int64)
        same = self.of[x] == self.of[y]
        for level in range(len(self.names) - 1, -1, -1):
            name = self.names[level]
            more = np.flatnonzero(same)
            more = more[name[self.number[x[more] + out[more]]]
                        == name[self.number[y[more] + out[more]]]]
            out[more] += self.period << level
        left = np.flatnonzero(same)
        for _ in range(self.period):
            left = left[self.w[x[left] + out[left]] == self.w[y[left] + out[left]]]
            if not len(left):
                break
            out[left] += 1
        return out

    def beyond(self, i: np.ndarray, j: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The whole LCE of pairs that are equal for `known` words, up to their sampled places."""
        a = self.rank[self.number[i + known]]
        b = self.rank[self.number[j + known]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.log2(high - low + 0.5).astype(np.int64)
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.lcp[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return known + out


def _tied(rank: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Those whose rank others share, sorted by rank."""
    among = among[np.argsort(rank[among], kind="stable")]
    same = rank[among][1:] == rank[among][:-1]
    tied = np.zeros(len(among), bool)
    tied[1:] |= same
    tied[:-1] |= same
    return among[tied]


def _refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Rank what ties by a further key, in place; a rank is the place of its first one. Returns what
    still ties."""
    order = np.lexsort((key, rank[tied]))
    tied, key = tied[order], key[order]
    old = rank[tied]
    first = np.ones(len(tied), bool)
    first[1:] = old[1:] != old[:-1]
    new = first.copy()
    new[1:] |= key[1:] != key[:-1]
    here = np.arange(len(tied))
    rank[tied] = old + np.maximum.accumulate(np.where(new, here, 0)) - np.maximum.accumulate(
        np.where(first, here, 0))
    return _tied(rank, tied)


def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Row k: the least of 2 ** k values from each place on."""
    rows, width = [values], 1
    while 2 * width <= len(values):
        last = rows[-1]
        rows.append(np.minimum(last[:-width], last[width:]))
        width *= 2
    return rows


def _grid(w: np.ndarray, of: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and periods q of the grid's pairs with equal words in one text. reach[q - 1]: how
    far the texts go that are long enough for q."""
    counts = np.maximum((reach - 1) // np.arange(1, len(reach) + 1), 0)
    upto = np.concatenate([[0], np.cumsum(counts)])
    q = 0
    while q < len(counts):
        end = max(q + 1, int(np.searchsorted(upto, upto[q] + _PAIRS, "right")) - 1)
        for skip in range(0, int(upto[end] - upto[q]), 4 * _PAIRS):  # q = 1 of a long text
            total = min(int(upto[end] - upto[q]) - skip, 4 * _PAIRS)
            number = np.arange(skip, skip + total)
            period = np.searchsorted(upto[q:end + 1] - upto[q], number, "right") + q
            i = (number - (upto[period - 1] - upto[q])) * period
            j = i + period
            some = np.flatnonzero(w[i] == w[j])
            some = some[of[i[some]] == of[j[some]]]
            yield i[some], period[some]
        q = end


def find(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """For each sequence of numbers (from 0, under 2 ** 31) its runs as rows start, length, period,
    sorted by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(texts)
    # the longest first, so that the texts that are long enough for a period lie together
    chosen = np.argsort(-lengths, kind="stable")
    chosen = chosen[lengths[chosen] >= max(least, 2)]
    if not len(chosen):
        return out
    size = lengths[chosen]
    above = 1 + max(int(texts[t].max()) for t in chosen)
    parts = [np.array([above], np.int64)]
    for n, t in enumerate(chosen):
        parts += [texts[t].astype(np.int64), np.array([above + 1 + n], np.int64)]
    w = np.concatenate(parts)
    starts = 1 + np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    of = np.concatenate([[0], np.repeat(np.arange(len(size)), size + 1)])
    periods = np.arange(1, int(size[0]) // 2 + 1)
    fitting = np.searchsorted(-size, -2 * periods, "right")
    reach = (starts + size)[fitting - 1]
    last = len(w) - 1
    forward = Extensions(w, of)
    backward = Extensions(w[::-1].copy(), of[::-1].copy())

    # few words first: pairs that need sampled suffixes mark their texts
    held = []
    for i, q in _grid(w, of, reach):
        b, wide = backward.few(last - (i - 1), last - (i + q - 1), q)
        at = np.flatnonzero(wide | (b < q))
        i, q, b, wide = i[at], q[at], b[at], wide[at]
        f, far = forward.few(i, i + q)
        # a pair that is settled must already be a run
        at = np.flatnonzero(wide | far | ((f + b >= q) & (f + b + q >= least)))
        held.append((i[at], q[at], f[at], far[at], b[at], wide[at]))
    i, q, f, far, b, wide = (np.concatenate(p) for p in zip(*held)) if held else [
        np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)] + [np.zeros(0, np.int64), np.zeros(0, bool)]
    needed = np.zeros(len(size), bool)
    needed[of[i[far | wide]]] = True
    if needed.any():
        forward.sample(needed)
        at = np.flatnonzero(far)
        f[at] = forward.beyond(i[at], i[at] + q[at], f[at])
        backward.sample(needed)
        at = np.flatnonzero(wide)
        b[at] = backward.beyond(last - (i[at] - 1), last - (i[at] + q[at] - 1), b[at])
    at = np.flatnonzero((b < q) & (f + b >= q) & (f + b + q >= least))
    i, q, f, b = i[at], q[at], f[at], b[at]
    start, length = i - b, f + b + q
    # of several periods of a stretch the smallest counts
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(q), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    text = of[start]
    ends = np.searchsorted(text, np.arange(len(size) + 1))
    rows = np.column_stack([start - starts[text], length, q]) if len(q) else none
    for n, t in enumerate(chosen):
        out[t] = rows[ends[n]:ends[n + 1]]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay if each run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _rewritten(n: int, h: int | None) -> np.ndarray:
    """Which word each of n places gets: in a tenth of the texts a tail is made periodic."""
    at = np.arange(n)
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def _pack(texts: list[str | None], seeds: list[int | None], least: int):
    """Runs and the collapsed text of each text."""
    known: dict[bytes, int] = {}
    split = [(t or "").encode().split() for t in texts]
    places = [_rewritten(len(s), h) for s, h in zip(split, seeds)]
    numbers = [np.fromiter((known.setdefault(x, len(known)) for x in s), np.int64, len(s))[at]
               for s, at in zip(split, places)]
    for s, at, runs in zip(split, places, find(numbers, least)):
        yield runs, b" ".join([s[k] for k in at[kept_words(len(at), runs)]])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _tables(least: int):
    def run(batches):
        for batch in batches:
            sizes = batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist()
            ends = np.cumsum([len(s) for s in sizes])
            del sizes
            at = 0
            while at < batch.num_rows:
                base = ends[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(ends, base + PACK, "right")))
                part = batch.slice(at, end - at)
                runs, texts = zip(*_pack(part.column(1).to_pylist(), part.column(2).to_pylist(),
                                         least))
                rows = np.concatenate(runs)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(rows[:, k]) for k in range(3)], fields=list(_RUN)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array([t.decode() for t in texts])],
                    names=["doc_id", "runs", "collapsed"])
                at = end

    return run


def find_runs(docs: DataFrame, least: int = LEAST, doc_id: str = "doc_id", text: str = "text",
              seed: Column | None = None) -> DataFrame:
    """Rows doc_id, runs (start, length and period in words, by start, then period) and collapsed,
    the words that stay if each run keeps its first period. seed: see `rewritten`."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"),
                       (F.lit(None) if seed is None else seed).cast("long").alias("seed"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _tables(least), f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>,"
        " collapsed string")


def rewritten(docs: DataFrame, least: int = LEAST, doc_id: str = "doc_id", text: str = "text"
              ) -> DataFrame:
    """find_runs on texts of which a tenth, by crc32 of the id, has a tail made periodic."""
    seed = F.crc32(docs[doc_id].cast("string").cast("binary"))
    return find_runs(docs, least, doc_id, text, seed)


def digest(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one (ties: smallest start, then period), and checksums."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    length, period = F.col("top.length"), -F.col("top.period")
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
