"""Document quality by a Bradley-Terry model of preference pairs.

Each text gets a small vector of features (shares of letters, capitals, digits and marks, lengths
of words and lines, repetition of words, triples and lines). A pair is a document labelled 1 and
one labelled 0; the model says that the first is preferred with the chance
1 / (1 + exp(-(s(a) - s(b)))), s being linear in the features, and learns its weights by the
logistic loss on feature differences. The threshold is the quantile of the training scores that
the share of documents labelled 0 names; the score given out is 1/2 there.

The features of all rows are computed once, each row by itself, and go to the shared folder; only
these small rows meet the labels. Weights are learnt on PER_CLASS rows of each label at most, taken
by hash order, and PARTNERS partners for each (documented bounds). The centre and spread of the
features and the threshold are those of all training rows.

Defined results: a null text is an empty one and has all features 0, so all empty texts share a
score; without training rows of both labels all scores are 1/2; a row that is listed twice gets a
result each time; a document that is labelled several times counts as 1 only if all labels say so;
null ids have no label; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.llm.common import cut, fold
from tradepath.llm.symbols import letters, mix, word_hashes
from tradepath.operators.quantiles import distribution

FOLDS = 3
HELD_OUT = 1
PER_CLASS = 20_000
PARTNERS = 4
FEATURES = ["size", "letters", "capitals", "digits", "blanks", "marks", "word_length",
            "distinct_words", "repeats_word", "distinct_triples", "line_length", "distinct_lines",
            "top_word", "odd"]


def text_features(texts: list[str | None]) -> np.ndarray:
    """A row of FEATURES for each text."""
    raw = [(t or "").encode("utf-32-le") for t in texts]
    size = np.array([len(r) // 4 for r in raw], np.int64)
    n = len(size)
    points = np.frombuffer(b"".join(raw), "<u4")
    of = np.repeat(np.arange(n), size)
    low = letters()[points]
    letter = low != 0

    def count(mask):
        return np.bincount(of[mask], minlength=n).astype(float)

    def share(part, whole):
        return part / np.maximum(whole, 1)

    digit = (points >= 48) & (points <= 57)
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    mark = ~letter & ~digit & ~blank
    n_letters = count(letter)
    words, word_of = word_hashes(points, of)
    n_words = np.bincount(word_of, minlength=n).astype(float)

    def distinct(values, value_of):
        order = np.lexsort((values, value_of))
        v, o = values[order], value_of[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
        runs = np.diff(np.append(np.flatnonzero(new), len(v)))
        most = np.zeros(n)
        np.maximum.at(most, o[new], runs)
        return np.bincount(o[new], minlength=n).astype(float), most

    kinds, most = distinct(words, word_of)
    again = (words[1:] == words[:-1]) & (word_of[1:] == word_of[:-1])
    inside = word_of[2:] == word_of[:-2]
    triples = mix(mix(mix(words[:-2]) + words[1:-1]) + words[2:])[inside]
    triple_of = word_of[2:][inside]
    n_triples = np.bincount(triple_of, minlength=n).astype(float)
    # lines: the sum of stirred (symbol, place) pairs
    ends = np.flatnonzero(points == 10)
    line_starts = np.unique(np.concatenate([ends + 1, np.concatenate([[0], np.cumsum(size)[:-1]])]))
    line_starts = line_starts[line_starts < len(points)].astype(np.int64)
    if len(line_starts):
        line = np.cumsum(np.bincount(line_starts, minlength=len(points))) - 1
        place = np.arange(len(points)) - line_starts[line]
        stirred = mix(points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                      + place.astype(np.uint64))
        stirred[points == 10] = 0
        lines = np.add.reduceat(stirred, line_starts)
        line_of = of[line_starts]
    else:
        lines, line_of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n_lines = np.bincount(line_of, minlength=n).astype(float)
    return np.column_stack([
        np.log1p(size), share(n_letters, size), share(count(letter & (low != points)), n_letters),
        share(count(digit), size), share(count(blank), size), share(count(mark), size),
        share(n_letters, n_words), share(kinds, n_words),
        share(np.bincount(word_of[1:][again], minlength=n), n_words),
        share(distinct(triples, triple_of)[0], n_triples), np.log1p(share(size, n_lines)),
        share(distinct(lines, line_of)[0], n_lines), share(most, n_words),
        share(count(mark & (points > 127)), size)])


def features(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType),
                           T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            rows = [text_features(batch.column(1).slice(at, 256).to_pylist())
                    for at in range(0, batch.num_rows, 256)]
            flat = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(flat), pa.list_(pa.float64()))],
                names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


class Expansion:
    """Features by their training spread, cut at four deviations, and their squares."""

    def __init__(self, centre: np.ndarray, spread: np.ndarray):
        self.centre, self.scale = centre, spread + 1e-9

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.centre) / self.scale, -4, 4)
        return np.column_stack([z, z * z])


def preference_weights(better: np.ndarray, worse: np.ndarray, partners: int = PARTNERS,
                       ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Bradley-Terry weights: each row of the smaller side meets `partners` of the other."""
    draw = np.random.default_rng(7)
    n = max(len(better), len(worse)) * partners
    x = better[draw.integers(0, len(better), n)] - worse[draw.integers(0, len(worse), n)]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))  # the chance of the other order
        hessian = (x * (p * (1 - p))[:, None]).T @ x / n + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ p / n - ridge * w)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w


def threshold(rows: DataFrame, column: str, rank: int, total: int) -> float:
    """The value of that rank (from 1) among all rows, exactly."""
    # half a rank lower lies between two values, or at one that is repeated: no rounding matters
    share = max(0.0, (rank - 1.5) / max(1, total - 1))
    below = distribution(rows, column, probs={"q": share}).first()["q"]
    return rows.where(F.col(column) >= below).agg(F.min(column)).first()[0]


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
          per_class: int = PER_CLASS) -> DataFrame:
    """Rows doc_id, held_out, score, predicted, and strength, the Bradley-Terry score."""
    found = cut(features(docs, doc_id, text))
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("_id")).agg(F.min(label).alias("_label"))
    train = cut(found.join(known.where(fold("_id", folds) != held_out), found[doc_id] == F.col("_id"))
                .select("_id", "_label", "features"))
    counts = {r["_label"]: r["count"] for r in train.groupBy("_label").count().collect()}
    out = F.coalesce(fold(doc_id, folds) == held_out, F.lit(False)).alias("held_out")
    if min(counts.get(0, 0), counts.get(1, 0)) == 0:
        half = F.lit(0.5)
        return found.select(doc_id, out, half.alias("score"), F.lit(1).alias("predicted"),
                            F.lit(0.0).alias("strength"))

    def sample(value):
        rows = train.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id")
        return np.array([r[0] for r in rows.limit(per_class).select("features").collect()])

    m = len(FEATURES)
    moments = train.agg(*(f(F.col("features")[i]) for f in (F.avg, F.stddev_pop) for i in range(m)))
    expand = Expansion(*np.array(moments.first(), float).reshape(2, m))
    weights = preference_weights(expand(sample(1)), expand(sample(0)))
    z = [F.greatest(F.lit(-4.0), F.least(F.lit(4.0), (
        F.col("features")[i] - float(expand.centre[i])) / float(expand.scale[i]))) for i in range(m)]
    measure = sum((z[i] * float(weights[i]) + z[i] * z[i] * float(weights[m + i])
                   for i in range(m)), F.lit(0.0))
    strength = measure - threshold(train.select(measure.alias("measure")), "measure", counts[0],
                                   sum(counts.values()))
    return (
        found.select(doc_id, out, strength.alias("strength"))
        .withColumn("score", 1 / (1 + F.exp(-F.col("strength"))))
        .select(doc_id, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                "strength")
    )
