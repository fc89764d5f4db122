"""Language spans of mixed texts: scripts, word scores, Viterbi.

For each language the model has the frequencies of letter triples (with word ends) and the scripts
of its letters, counted over all training rows. A word's script leaves only the languages written
in it; each of these scores the word by the log frequencies of its triples. Along a text the
sequence of languages with the highest sum is found by Viterbi's method, where each change of
language costs PENALTY; neighbouring words of one language make up a span. All texts of a batch
move through the steps together.

Triples are folded into 2 ** BITS buckets, so the model that is broadcast has a fixed bound per
language; counts are summed by task and then by bucket.

Defined results: a null text, or one without a letter, has no spans and is `und` with score 0; a
text is given the language with most letters in its spans (ties: the first by name), its score is
that share; without training rows all is `und`; a row that is listed twice gets a result each
time; null languages are not learnt, null ids count as training rows; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.llm.common import cut, fold
from tradepath.llm.symbols import letters

FOLDS = 3
HELD_OUT = 1
BITS = 18
PENALTY = 14.0
#: a language is written in a script if so much of its letters are
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
_TEXTS = 1024
# First code points of blocks and the script that begins there; 0 is any other.
SCRIPTS = [(0x0, 1), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 0),
           (0x750, 6), (0x780, 0), (0x900, 7), (0x980, 8), (0xA00, 9), (0xA80, 10), (0xB00, 11),
           (0xB80, 12), (0xC00, 13), (0xC80, 14), (0xD00, 15), (0xD80, 16), (0xE00, 17),
           (0xE80, 18), (0xF00, 19), (0x1000, 20), (0x10A0, 21), (0x1100, 22), (0x1200, 23),
           (0x13A0, 0), (0x1780, 24), (0x1800, 25), (0x18B0, 0), (0x1E00, 1), (0x1F00, 2),
           (0x2000, 0), (0x2C60, 1), (0x2C80, 0), (0x3040, 26), (0x3100, 27), (0x3130, 22),
           (0x3190, 0), (0x31F0, 26), (0x3200, 0), (0x3400, 28), (0xA000, 0), (0xA720, 1),
           (0xA800, 0), (0xAC00, 22), (0xD7B0, 0), (0xF900, 28), (0xFB00, 1), (0xFB1D, 5),
           (0xFB50, 6), (0xFE00, 0), (0x20000, 28), (0x32000, 0)]
N_SCRIPTS = 29


def _scripts(points: np.ndarray) -> np.ndarray:
    firsts, names = (np.array(x) for x in zip(*SCRIPTS))
    return names[np.searchsorted(firsts, points, side="right") - 1]


def _letters_of(texts: list[str | None]):
    """The letters of texts, in lower case with a 0 after each word: points, text, and place of each
    letter in its text."""
    raw = [(t or "").encode("utf-32-le") for t in texts]
    size = np.array([len(r) // 4 for r in raw], np.int64)
    low = letters()[np.frombuffer(b"".join(raw), "<u4")].astype(np.int64)
    of = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(low)) - np.repeat(np.cumsum(size) - size, size)
    # a separator behind each text, then only the first of a run of separators
    low = np.insert(low, np.cumsum(size), 0)
    of = np.insert(of, np.cumsum(size), np.arange(len(size)))
    place = np.insert(place, np.cumsum(size), size)
    keep = low != 0
    keep[1:] |= keep[:-1]
    return low[keep], of[keep], place[keep]


def _triples(low: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of the triple that ends at each place; nothing reaches across a separator."""
    one = np.concatenate([[0], low[:-1]])
    two = np.where(one == 0, 0, np.concatenate([[0, 0], low[:-2]])[:len(low)])
    key = (two.astype(np.uint64) << np.uint64(42)) | (one.astype(np.uint64) << np.uint64(21))
    key = (key | low.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    return ((key * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


class Model:
    """Log frequencies of triple buckets by language, and which scripts each is written in."""

    def __init__(self, names: list[str], triples: np.ndarray, scripts: np.ndarray):
        self.names = names
        total = triples.sum(0, keepdims=True)
        kinds = (triples > 0).sum(0, keepdims=True) + 1
        self.scores = np.log((triples + 0.5) / (total + 0.5 * kinds)).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(0, keepdims=True), 1)
        self.allowed = share >= SCRIPT_SHARE
        self.allowed[~self.allowed.any(1)] = True


def train(docs: DataFrame, text: str, lang: str, bits: int = BITS) -> Model:
    """A model from all rows with a language."""
    def run(batches):
        held: dict[str, list[np.ndarray]] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for at in range(0, batch.num_rows, _TEXTS):
                low, of, _ = _letters_of(batch.column(0).slice(at, _TEXTS).to_pylist())
                bucket, script = _triples(low, bits), _scripts(low)
                names = langs[at:at + _TEXTS]
                for name in set(names):
                    rows = np.array([x == name for x in names])[of]
                    triples, scripts = held.setdefault(
                        name, [np.zeros(1 << bits, np.int64), np.zeros(N_SCRIPTS, np.int64)])
                    triples += np.bincount(bucket[rows], minlength=1 << bits)
                    scripts += np.bincount(script[rows & (low != 0)], minlength=N_SCRIPTS)
        for name, (triples, scripts) in held.items():
            both = np.concatenate([scripts, triples])
            some = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(both[some])],
                names=["lang", "slot", "n"])

    counts = (
        docs.where(F.col(lang).isNotNull()).select(text, F.col(lang).cast("string"))
        .mapInArrow(run, "lang string, slot long, n long")
        .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    )
    names = sorted(counts["lang"].unique())
    table = np.zeros((N_SCRIPTS + (1 << bits), len(names)))
    table[counts["slot"], counts["lang"].map({x: i for i, x in enumerate(names)})] = counts["n"]
    return Model(names, table[N_SCRIPTS:], table[:N_SCRIPTS])


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word of texts that lie one behind the other; sizes: words of each."""
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    labels = np.zeros(len(scores), np.int64)
    switch = np.zeros(scores.shape, bool)
    before = np.zeros(len(scores), np.int64)  # the best label of the word before
    best = np.zeros((len(sizes), scores.shape[1]))
    longest = int(sizes.max(initial=0))
    active = np.searchsorted(-sizes[order], -np.arange(1, longest + 1), side="right")
    starts = first[order]
    for t in range(longest):
        n = active[t]
        at = starts[:n] + t
        if t:
            top = best[:n].argmax(1)
            over = best[:n][np.arange(n), top][:, None] - penalty
            before[at] = top
            switch[at] = best[:n] < over
            best[:n] = np.maximum(best[:n], over)
        best[:n] += scores[at]
    label = best.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = label[:n]
        label[:n] = np.where(switch[at, label[:n]], before[at], label[:n])
    return labels


def label_spans(docs: DataFrame, model: Model, penalty: float = PENALTY, bits: int = BITS,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows doc_id, spans: an array of struct(start, end, lang, letters) in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType),
        T.StructField("spans", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
            T.StructField("lang", T.StringType()), T.StructField("letters", T.LongType())])))])

    def spans_of(texts):
        m = shared.value
        low, of, place = _letters_of(texts)
        is_end = low == 0
        if not m.names or not is_end.any():
            return [[] for _ in texts]
        # a word is its letters and the separator behind them
        begins = np.concatenate([[0], np.flatnonzero(is_end)[:-1] + 1])
        ends = np.flatnonzero(is_end)
        scores = np.add.reduceat(m.scores[_triples(low, bits)], begins, axis=0)
        scores = scores - 1e4 * ~m.allowed[_scripts(low[begins])]
        word_of = of[begins]
        labels = viterbi(scores, np.bincount(word_of, minlength=len(texts)), penalty)
        new = np.ones(len(labels), bool)
        new[1:] = (labels[1:] != labels[:-1]) | (word_of[1:] != word_of[:-1])
        one = np.flatnonzero(new)
        two = np.append(one[1:], len(labels)) - 1
        size = np.concatenate([[0], np.cumsum(ends - begins)])
        out = [[] for _ in texts]
        for a, b in zip(one, two):
            out[word_of[a]].append({
                "start": int(place[begins[a]]), "end": int(place[ends[b] - 1]) + 1,
                "lang": m.names[labels[a]], "letters": int(size[b + 1] - size[a])})
        return out

    def run(batches):
        for batch in batches:
            spans = []
            for at in range(0, batch.num_rows, _TEXTS):
                spans += spans_of(batch.column(1).slice(at, _TEXTS).to_pylist())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                       ("lang", pa.string()), ("letters", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)],
                                             names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             folds: int = FOLDS, held_out: int = HELD_OUT, **options) -> DataFrame:
    """Rows doc_id, held_out, lang_pred, score, n_spans."""
    out = F.coalesce(fold(doc_id, folds) == held_out, F.lit(False))
    model = train(docs.where(~out), text, lang)
    spans = label_spans(docs, model, doc_id=doc_id, text=text, **options)
    sums = [F.struct(
        F.aggregate(F.filter("spans", _is(name)), F.lit(0).cast("long"),
                    lambda a, s: a + s["letters"]).alias("n"),
        F.lit(-i).alias("order"), F.lit(name).alias("lang")) for i, name in enumerate(model.names)]
    if not sums:
        best = F.struct(F.lit(0).cast("long").alias("n"), F.lit(UNKNOWN).alias("lang"))
    else:
        best = F.array_max(F.array(*sums))
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["letters"])
    return spans.select(
        doc_id, out.alias("held_out"), best.alias("_best"), total.alias("_all"),
        F.size("spans").cast("long").alias("n_spans")).select(
        doc_id, "held_out",
        F.when(F.col("_all") > 0, F.col("_best.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_all") > 0, F.col("_best.n") / F.col("_all")).otherwise(0.0).alias("score"),
        "n_spans")


def _is(name: str):
    return lambda s: s["lang"] == name
