"""Toxicity by two class-conditional Kneser-Ney character models.

Text is read as lower-case letters; all else is one separator, and each separator run counts once.
For each class the model gives the probability of a symbol after the ORDER - 1 before it, from
counts over all labelled training rows with an absolute discount. What the discount frees goes to
one lower-order Kneser-Ney model, built from the distinct left neighbours in both classes together,
so an expression that neither class knows weighs nothing. A document's measure is the toxic minus the
ordinary log-likelihood, by length. The same difference is summed for each word (a separator and the
letters behind it): in a long text a few toxic expressions drown in the mean, so the sums of
the STRONGEST words stand beside it.

Counting, continuation counts and probabilities are joins and groupings of n-gram tables that grow
with the input. Scoring needs only the log ratio of known n-grams and contexts, by their exact keys.
If these are 2 ** BITS at most, they are broadcast; of a larger model the most frequent ones are,
and the n-grams of a text that are not among them are joined with the rest by key. The result is
the same either way.

A logistic curve that turns these figures and the length into a score is fitted on rows of one fold,
CALIBRATION of them at most by hash order (a documented bound). The counts come from all other
training rows, those of that fold that are not in the sample included. Held-out rows are in neither.

Defined results: a null text is an empty one; a text without letters gets the score of measure 0 at
length 0; without toxic or without ordinary training rows all scores are 0; a row that is listed
twice gets a result each time; a document labelled several times counts as toxic if one label
says so; null ids have no label; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepath.llm.common import cut, fold, fresh
from tradepath.llm.symbols import SYMBOL_BITS, packs, symbols, text_sizes

ORDER = 4
DISCOUNT = 0.75
BITS = 21
FOLDS = 5
HELD_OUT = 0
#: Numbers of words whose sums are features.
STRONGEST = (1, 2, 4, 8)
CALIBRATION_FOLD = 1
CALIBRATION = 50_000
#: n-grams that a task holds before it passes its counts on
_HELD = 2_000_000


def _mask(order: int) -> int:
    return (1 << (SYMBOL_BITS * order)) - 1


def ngrams(text_bytes: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams of the texts, none across two of them; which text each belongs to, and
    which word: that of its last symbol."""
    syms, of = symbols(text_bytes, ends)
    packed = np.zeros(max(0, len(syms) - ORDER + 1), np.int64)
    for i in range(ORDER):
        packed = (packed << SYMBOL_BITS) | syms[i:len(syms) - ORDER + 1 + i]
    whole = of[:len(packed)] == of[ORDER - 1:]
    word = np.cumsum(syms == 0)[ORDER - 1:]
    return packed[whole], of[ORDER - 1:][whole], word[whole]


def _contexts(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) >> np.uint64(SYMBOL_BITS)).view(np.int64)


def _words(word: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where each word's n-grams begin, and the sums of values over them."""
    if not len(word):
        return (np.zeros(0, np.int64), *(np.zeros(0) for _ in values))
    first = np.flatnonzero(np.diff(word, prepend=-1))
    return (first, *(np.add.reduceat(v, first) for v in values))


def _strongest(of: np.ndarray, sums: np.ndarray, n: int) -> list[np.ndarray]:
    """The largest sums of the words of each of n texts, in descending order."""
    order = np.lexsort((-sums, of))
    of, sums = of[order], sums[order]
    begin = np.searchsorted(of, np.arange(n + 1))
    return [sums[a:min(b, a + STRONGEST[-1])] for a, b in zip(begin[:-1], begin[1:])]


def _texts(texts) -> tuple[bytes, np.ndarray]:
    raw = [(t or "").encode("utf-32-le") for t in texts]
    return b"".join(raw), np.cumsum([len(r) // 4 for r in raw], dtype=np.int64)


def _sizes(column) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


class Model(NamedTuple):
    """Sorted keys and their log ratios, of n-grams and of contexts; and a table of those that are
    less frequent (columns as of log_ratios), if not all are in the arrays."""

    grams: tuple[np.ndarray, np.ndarray]
    contexts: tuple[np.ndarray, np.ndarray]
    rest: DataFrame | None


def _looked_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The ratio of each key; nan for one that is not in the table."""
    known, ratios = table
    at = np.searchsorted(known, keys)
    return np.where(known[at] == keys, ratios[at], np.nan)


def _count(batches):
    """Rows key, toxic, ordinary of a task, several times for a key if it reads much."""
    def flush():
        for label, parts in held.items():
            if parts:
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                parts.clear()
                zero = np.zeros(len(keys), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(n if label else zero), pa.array(zero if label else n)],
                    names=["key", "toxic", "ordinary"])

    held, size = {0: [], 1: []}, 0
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for at, to in packs(_sizes(batch.column(0))):
            data, ends = _texts(batch.column(0).slice(at, to - at).to_pylist())
            keys, of, _ = ngrams(data, ends)
            toxic = labels[at:to][of] == 1
            for label in (0, 1):
                one, n = np.unique(keys[toxic == label], return_counts=True)
                held[label].append(np.repeat(one, n))
            size += len(keys)
            if size > _HELD:
                yield from flush()
                size = 0
    yield from flush()


def counts(train: DataFrame, text: str, label: str) -> DataFrame:
    rows = train.select(F.coalesce(text, F.lit("")).alias("text"), F.col(label).cast("int"))
    return rows.mapInArrow(_count, "key long, toxic long, ordinary long").groupBy("key").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def log_ratios(found: DataFrame) -> DataFrame:
    """Rows kind (0: n-gram, 1: context), key, ratio, weight from the n-gram counts."""
    def suffix(order):
        return F.col("key").bitwiseAND(F.lit(_mask(order)))

    context = F.shiftrightunsigned("key", SYMBOL_BITS)
    types = {ORDER: found}
    for order in range(ORDER - 1, 0, -1):
        types[order] = types[order + 1].groupBy(suffix(order).alias("key")).agg(
            F.count("*").alias("n"))
    total, kinds = types[1].agg(F.sum("n"), F.count("*")).first()
    d = F.lit(DISCOUNT)
    uniform = DISCOUNT * kinds / max(total or 0, 1) / (1 << SYMBOL_BITS)
    lower = types[1].select("key", ((F.col("n") - d) / F.lit(total) + F.lit(uniform)).alias("p"))
    for order in range(2, ORDER):
        sums = types[order].groupBy(context.alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"))
        below = lower.select(F.col("key").alias("below"), F.col("p").alias("q"))
        lower = (
            types[order].withColumn("context", context).withColumn("below", suffix(order - 1))
            .join(sums, "context").join(below, "below")
            .select("key", ((F.col("n") - d + d * F.col("kinds") * F.col("q")) / F.col("total"))
                    .alias("p"))
        )
    sides = ("toxic", "ordinary")
    sums = found.groupBy(context.alias("context")).agg(
        *(F.sum(c).alias(f"{c}_total") for c in sides),
        *(F.count(F.when(F.col(c) > 0, 1)).alias(f"{c}_kinds") for c in sides))

    def freed(c):
        return F.when(F.col(f"{c}_total") > 0, d * F.col(f"{c}_kinds") / F.col(f"{c}_total")
                      ).otherwise(1.0)

    def p(c):
        seen = F.when(F.col(f"{c}_total") > 0, F.greatest(F.col(c) - d, F.lit(0.0))
                      / F.col(f"{c}_total")).otherwise(0.0)
        return seen + freed(c) * F.col("q")

    below = lower.select(F.col("key").alias("below"), F.col("p").alias("q"))
    grams = (
        found.withColumn("context", context).withColumn("below", suffix(ORDER - 1))
        .join(sums, "context").join(below, "below")
        .select(F.lit(0).alias("kind"), "key", F.log(p("toxic") / p("ordinary")).alias("ratio"),
                (F.col("toxic") + F.col("ordinary")).alias("weight"))
    )
    contexts = sums.select(
        F.lit(1).alias("kind"), F.col("context").alias("key"),
        F.log(freed("toxic") / freed("ordinary")).alias("ratio"),
        (F.col("toxic_total") + F.col("ordinary_total")).alias("weight"))
    return grams.unionByName(contexts)


def _folded(ratios: DataFrame, bits: int) -> Model:
    """The model with at most 2 ** bits keys in its arrays, the most frequent ones."""
    ratios = cut(ratios)
    size = F.floor(F.log2("weight")).cast("int")
    classes = {r["size"]: r["count"] for r in ratios.groupBy(size.alias("size")).count().collect()}
    least, held = 63, 0
    while least and held + classes.get(least - 1, 0) <= 1 << bits:
        least -= 1
        held += classes.get(least, 0)
    often = F.col("weight") >= F.lit(1 << least)
    found = ratios.where(often).select("kind", "key", "ratio").toArrow()
    kind, key, ratio = (found[c].to_numpy() for c in ("kind", "key", "ratio"))
    tables = []
    for k in (0, 1):
        order = np.flatnonzero(kind == k)
        order = order[np.argsort(key[order])]
        # the last key is no n-gram's, so a search always ends at a key
        tables.append((np.append(key[order], np.iinfo(np.int64).max),
                       np.append(ratio[order], np.nan)))
    return Model(*tables, ratios.where(~often) if least else None)


def _rare(docs: DataFrame, shared, text: str, rest: DataFrame) -> DataFrame:
    """Rows of _name (of a text), _rare: the sum over the n-grams of the text that are not in the
    arrays, and _strong: the largest sums of words that hold such n-grams. An n-gram that is not
    in the rest either has the ratio of its context."""
    def run(batches):
        grams, contexts = shared.value
        for batch in batches:
            for at, to in packs(_sizes(batch.column(1))):
                part = batch.slice(at, to - at)
                data, ends = _texts(part.column(1).to_pylist())
                keys, of, word = ngrams(data, ends)
                known = _looked_up(grams, keys)
                left = np.isnan(known)
                first, sums, missing = _words(word, np.nan_to_num(known, nan=0.0), left.astype(float))
                number = np.searchsorted(first, np.flatnonzero(left), "right") - 1
                of, keys, word = of[left], keys[left], word[left]
                freed = _looked_up(contexts, _contexts(keys))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(of)), pa.array(word - (word.min(initial=0))),
                     pa.array(keys), pa.array(freed, mask=np.isnan(freed)),
                     pa.array(sums[number]), pa.array(missing[number])],
                    names=["_name", "_word", "_key", "_freed", "_sum", "_missing"])

    # texts that are the same are read once
    rows = docs.select(F.md5(F.col(text).cast("binary")).alias("_name"), F.col(text).alias("_text"))
    rows = rows.groupBy("_name").agg(F.first("_text").alias("_text")).mapInArrow(
        run, "_name string, _word long, _key long, _freed double, _sum double, _missing double")
    grams = rest.where("kind = 0").select(F.col("key").alias("_g"), F.col("ratio").alias("_known"))
    contexts = rest.where("kind = 1").select(F.col("key").alias("_c"), F.col("ratio").alias("_late"))
    rows = rows.join(grams, F.col("_key") == F.col("_g"), "left")
    # an n-gram that needs no context here has a negative key that no context has
    needed = F.when(F.coalesce("_known", "_freed").isNull(),
                    F.shiftrightunsigned("_key", SYMBOL_BITS))
    spread = -1 - F.shiftrightunsigned("_key", 1)
    rows = rows.withColumn("_context", F.coalesce(needed, spread)).join(
        contexts, F.col("_context") == F.col("_c"), "left")
    ratio = F.coalesce("_known", "_freed", "_late", F.lit(0.0))
    words = rows.groupBy("_name", "_word").agg(
        F.sum(ratio).alias("_rare"), F.max("_sum").alias("_sum"))
    return words.groupBy("_name").agg(
        F.sum("_rare").alias("_rare"),
        F.slice(F.sort_array(F.collect_list(F.col("_rare") + F.col("_sum")), False), 1,
                STRONGEST[-1]).alias("_strong"))


def measured(docs: DataFrame, model: Model | DataFrame, column: str, text: str = "text",
             bits: int = BITS) -> DataFrame:
    """docs with one more column, struct(total, length, strong): the toxic minus the ordinary
    log-likelihood, the number of n-grams, and the largest sums of words. Only texts go to
    Python. bits: if the model is still a table of log ratios."""
    if isinstance(model, DataFrame):
        model = _folded(model, bits)
    shared = docs.sparkSession.sparkContext.broadcast((model.grams, model.contexts))
    whole = model.rest is None

    @F.pandas_udf("total double, length long, strong array<double>")
    def compare(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams, contexts = shared.value
        for batch in batches:
            totals, lengths, strong = [np.zeros(0)], [np.zeros(0, np.int64)], []
            for at, to in packs(text_sizes(batch)):
                data, ends = _texts(batch.iloc[at:to])
                keys, of, word = ngrams(data, ends)
                known = _looked_up(grams, keys)
                left = np.isnan(known)
                if whole:
                    rest = np.flatnonzero(left)
                    known[rest] = _looked_up(contexts, _contexts(keys[rest]))
                    left[:] = False  # a context that neither class knows weighs nothing
                known = np.nan_to_num(known, nan=0.0)
                first, sums, missing = _words(word, known, left.astype(float))
                done = missing == 0
                strong += _strongest(of[first[done]], sums[done], len(ends))
                totals.append(np.bincount(of, known, len(ends)))
                lengths.append(np.bincount(of, minlength=len(ends)))
            yield pd.DataFrame({"total": np.concatenate(totals), "length": np.concatenate(lengths),
                                "strong": pd.Series(strong, dtype=object)})

    out = docs.withColumn(column, compare(F.col(text)))
    if whole:
        return out
    name, of, rare, more = fresh("name"), fresh("of"), fresh("rare"), fresh("strong")
    sums = _rare(docs, shared, text, model.rest).withColumnsRenamed(
        {"_name": of, "_rare": rare, "_strong": more})
    total = F.col(f"{column}.total") + F.coalesce(rare, F.lit(0.0))
    both = F.concat(F.col(f"{column}.strong"), F.coalesce(more, F.array().cast("array<double>")))
    strong = F.slice(F.sort_array(both, False), 1, STRONGEST[-1])
    out = out.withColumn(name, F.md5(F.col(text).cast("binary"))).join(
        sums, F.col(name) == F.col(of), "left")
    return out.withColumn(column, F.struct(
        total.alias("total"), F.col(f"{column}.length"), strong.alias("strong"))).drop(
        name, of, rare, more)


def features(measure: str) -> list[Column]:
    """The measure by length, and by the root of the length, for longer texts vary less; the
    length; and what the strongest words add up to."""
    total = F.col(f"{measure}.total")
    length = F.greatest(F.col(f"{measure}.length"), F.lit(1))
    sums = [F.aggregate(F.slice(F.col(f"{measure}.strong"), 1, k), F.lit(0.0), lambda a, x: a + x)
            for k in STRONGEST]
    return [total / length, total / F.sqrt(length), F.log(length), *sums]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; the last is the constant."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(z) * np.eye(len(w)) / 100
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge * len(z) * w / 100)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    w[:-1] /= scale
    w[-1] -= (w[:-1] * centre).sum()
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT,
        bits: int = BITS, calibration: int = CALIBRATION) -> tuple[Model, list[float] | None]:
    """The model, and the weights that turn a measure into a score."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    known = known.where(fold("_id", folds) != held_out)
    apart = (held_out + CALIBRATION_FOLD) % folds
    plain = docs.select(doc_id, text, F.xxhash64(text).alias("_h"))
    # rows of the sample by id and text, each once; bounded, so they may be broadcast
    some = plain.where(fold(doc_id, folds) == apart).select(
        F.col(doc_id).alias("_sid"), F.col("_h").alias("_sh"))
    chosen = F.broadcast(cut(
        some.join(known.where(fold("_id", folds) == apart), F.col("_sid") == F.col("_id"))
        .groupBy("_sid", "_sh").agg(F.max("_label").alias("_y"))
        .orderBy(F.xxhash64("_sid"), "_sid", "_sh").limit(calibration)))
    in_sample = (plain[doc_id] == F.col("_sid")) & (plain["_h"] == F.col("_sh"))
    # shuffled at every size, so that the join behaves alike; only the labels are held in memory
    train = plain.join(chosen, in_sample, "left_anti").join(
        known.hint("shuffle_hash"), F.col(doc_id) == F.col("_id"))
    model = _folded(log_ratios(cut(counts(train, text, "_label"))), bits)
    rest = plain.where(fold(doc_id, folds) == apart).join(chosen, in_sample)
    rest = measured(rest.dropDuplicates(["_sid", "_sh"]), model, "_measure", text, bits)
    sample = (
        rest.select(
            *(c.alias(f"x{i}") for i, c in enumerate(features("_measure"))),
            F.col("_y").cast("double").alias("y"))
        .toPandas()
    )
    if sample["y"].nunique() < 2:
        return model, None
    x, y = sample.drop(columns="y").to_numpy(float), sample["y"].to_numpy(float)
    return model, [float(w) for w in logistic(x, y)]


def _score(measure: str, weights: list[float] | None):
    if weights is None:
        return F.lit(0.0)
    parts = features(measure)
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, (
        c * w for c, w in zip(parts, weights)), F.lit(weights[-1]))))


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          folds: int = FOLDS, held_out: int = HELD_OUT, **options) -> DataFrame:
    """Rows doc_id, held_out, score, predicted, and the measure by length."""
    model, weights = fit(docs, labels, doc_id, text, folds=folds, held_out=held_out, **options)
    plain = docs.select(doc_id, text)
    out = F.coalesce(fold(doc_id, folds) == held_out, F.lit(False)).alias("held_out")
    scored = measured(plain, model, "_measure", text).select(
        doc_id, out, _score("_measure", weights).alias("score"),
        (F.col("_measure.total") / F.greatest("_measure.length", F.lit(1))).alias("measure"))
    return scored.select(doc_id, "held_out", "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "measure")


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs without the rows that are predicted toxic; their columns stay as they are."""
    model, weights = fit(docs, labels, text=text, **options)
    column = fresh("measure")
    return measured(docs, model, column, text).where(_score(column, weights) < 0.5).select(
        *(docs[c] for c in docs.columns))
