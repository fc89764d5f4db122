"""Word counts and keyword shares over review texts. Texts are read whole."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.functions import reference_data as ref

# A word is two or more letters, digits, underscores or apostrophes, the
# first of them no apostrophe; everything else separates words.
WORD = r"[\p{L}\p{N}_][\p{L}\p{N}_']+"
SEPARATOR = r"[^\p{L}\p{N}_']+"


def word_counts(
    df: DataFrame, text: str, keep: Sequence[str] = (), stop_words=None, copies: str | None = None
) -> DataFrame:
    """Occurrences per word; a possessive ending is dropped, as are stop words and numbers.
    `copies` names a column with the number of texts that a row stands for.

    Pieces between separators are counted as they stand, in each task before the shuffle.
    Cleaning then touches each distinct piece once instead of every occurrence.
    """
    stop = list(ref.STOP_WORDS if stop_words is None else stop_words)
    weight = (F.col(copies) if copies else F.lit(1)).cast("long").alias("_w")
    pieces = df.where(F.col(text).isNotNull()).select(
        *keep, weight, F.explode(F.split(F.lower(F.col(text)), SEPARATOR)).alias("_piece")
    )
    counts = pieces.groupBy(*keep, "_piece").agg(F.sum("_w").alias("_n"))
    valid = "length(_bare) > 1 AND NOT word RLIKE '^[0-9]+$'"
    if stop:
        valid += f" AND word NOT IN ({', '.join(repr(w) for w in stop)})"
    # the test takes in the count, so that it is not pushed below the aggregate and
    # run for every occurrence
    bare = counts.withColumn("_bare", F.expr("ltrim(\"'\", _piece)"))
    cleaned = bare.withColumn("word", F.regexp_replace("_bare", "'s$", "")).withColumn(
        "_kept", F.expr(f"CASE WHEN {valid} THEN _n ELSE 0L END")).where("_kept > 0")
    return cleaned.groupBy(*keep, "word").agg(F.sum("_kept").alias("n"))


def top_words(
    df: DataFrame, text: str, n: int = 100, stop_words=None, copies: str | None = None
) -> DataFrame:
    """The n most frequent words."""
    counts = word_counts(df, text, (), stop_words, copies)
    return counts.orderBy(F.desc("n"), "word").limit(n)


def keyword_share(df: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    """Texts, texts with any keyword, and their share, in total and per keyword."""
    low = F.lower(F.col(text))
    hits = {k: low.contains(k) for k in keywords}
    any_hit = F.lit(False)
    for hit in hits.values():
        any_hit = any_hit | hit
    return df.where(F.col(text).isNotNull()).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_if(any_hit).alias("n_any"),
        F.avg(any_hit.cast("int")).alias("share_any"),
        *[F.avg(hit.cast("int")).alias(f"share_{k}") for k, hit in hits.items()],
    )


def contrast(
    df: DataFrame, text: str, side: str, first: str, second: str, n: int = 50, minimum: int = 1,
    copies: str | None = None,
) -> DataFrame:
    """Words that tell two groups of texts apart, by the log ratio of their smoothed shares."""
    rows = word_counts(df.where(F.col(side).isin(first, second)), text, [side], copies=copies)
    counts = rows.groupBy("word").agg(
        F.sum(F.when(F.col(side) == first, F.col("n")).otherwise(F.lit(0))).alias("n_first"),
        F.sum(F.when(F.col(side) == second, F.col("n")).otherwise(F.lit(0))).alias("n_second"),
    )
    totals = counts.agg(F.struct(F.sum("n_first").alias("a"), F.sum("n_second").alias("b"))).scalar()
    ratio = F.log(
        ((F.col("n_first") + 1) / (totals["a"] + 1)) / ((F.col("n_second") + 1) / (totals["b"] + 1))
    )
    return (
        counts.where(F.col("n_first") + F.col("n_second") >= minimum)
        .withColumn("log_ratio", F.round(ratio, 6))
        .orderBy(F.desc("log_ratio"), "word")
        .limit(n)
    )
