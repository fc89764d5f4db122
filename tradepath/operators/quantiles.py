"""Exact order statistics without sorting a whole group in one task.

`percentile` keeps one entry per distinct value of a group in a single task, which
suits small domains such as scores and days. For money, seconds or ratios the
number of distinct values grows with the data, so the work is split by value:

1. count rows per (group, value), combined before the shuffle;
2. place each value in a bucket of its group's range, and sum the buckets; a group has
   at most 41,000 buckets whatever the row count;
3. a running sum over buckets gives each bucket the number of rows before it;
4. only buckets that hold a wanted rank are opened and counted value by value.

The histogram of step 1 feeds steps 2 and 4; Spark reuses its exchange.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Buckets follow the range of their group: the distance from its least value, as a share of the
# range, on a logarithmic scale. A group has at most about 2,000 * ln(1e9) = 41,000 buckets, fine
# ones near its least value; values in a narrow range far from zero spread as others do.
RESOLUTION = 2_000
SMALLEST = 1e-9
GROUP = ["_total", "_min", "_max", "_mean"]


def _bucket():
    """The bucket of v, from the range of its group in _min and _max. Never null: a null filter
    pushed into one use of the histogram would stop its reuse."""
    share = (F.col("v") - F.col("_min")) / F.nullif(F.col("_max") - F.col("_min"), F.lit(0.0))
    place = F.floor(F.log1p(share / SMALLEST) * RESOLUTION)
    return F.coalesce(place, F.lit(0).cast("long"))


def _same(column: str = "v"):
    """A key that is 0 in all rows, which the optimiser does not know: an equality that it could fold
    away would leave a nested loop."""
    return F.pmod(F.xxhash64(column), F.lit(1)).alias("_all")


def _located(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    """The histogram with its group's _total, _min, _max and _mean, and the bucket _b."""
    # without groups the one row of figures is broadcast
    keys = list(by) or ["_all"]
    hist = hist if by else hist.select("*", _same())
    stats = hist.groupBy(*keys).agg(
        F.sum("n").alias("_total"), F.min("v").alias("_min"), F.max("v").alias("_max"),
        (F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("_mean"),
    )
    located = hist.join(stats if by else F.broadcast(stats), keys)
    return located.withColumn("_b", _bucket()).drop("_all")


def histogram(
    df: DataFrame, value, by: Sequence[str] = (), copies: str | None = None
) -> DataFrame:
    """Rows per (group, value) as columns by + v, n; null values and groups are left out.

    `copies` names a column with the number of rows that each row stands for.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    weight = F.col(copies) if copies else F.lit(1)
    kept = " AND ".join(["v IS NOT NULL", "NOT isnan(v)", *[f"`{k}` IS NOT NULL" for k in by]])
    out = df.select(*by, v.alias("v"), weight.cast("long").alias("_w")).where(kept)
    return out.groupBy(*by, "v").agg(F.sum("_w").alias("n"))


def _bucket_totals(located: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per bucket: rows, rows before it in its group, and the group's figures. Squares are those of
    the distances from the mean, so large values lose nothing."""
    totals = located.groupBy(*by, "_b").agg(
        F.expr("sum(n) AS _rows"),
        F.expr("sum(n * (v - _mean) * (v - _mean)) AS _squares"),
        *[F.max(c).alias(c) for c in GROUP],
    )
    group = f"PARTITION BY {', '.join(by)}" if by else ""
    earlier = f"{group} ORDER BY _b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return totals.selectExpr(
        *by, "_b", "_rows", *GROUP,
        f"coalesce(sum(_rows) OVER ({earlier}), 0L) AS _before",
        f"sum(_squares) OVER ({group}) AS _squares",
    )


def _open_bucket(by: Sequence[str]):
    return (
        Window.partitionBy(*by, "_b").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    )


def distribution(
    df: DataFrame,
    value,
    by: Sequence[str] = (),
    probs: Mapping[str, float] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """Per group: count, mean, std (sample), min, max and linearly interpolated quantiles.

    `probs` maps an output column to its probability.
    """
    return _distribution(histogram(df, value, by, copies), list(by), dict(probs or {}))


def _distribution(hist: DataFrame, by: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    located = _located(hist, by)
    buckets = _bucket_totals(located, by)

    wanted = []
    for i, p in enumerate(probs.values()):
        position = f"((_total - 1) * {float(p)!r}D)"
        for side, rank in (("lo", f"floor({position})"), ("hi", f"ceil({position})")):
            wanted.append(
                f"struct('{i}{side}' AS slot, {rank} - _before AS rank, "
                f"{position} - floor({position}) AS fraction)"
            )
    if wanted:
        inside = f"filter(array({', '.join(wanted)}), w -> w.rank >= 0 AND w.rank < _rows)"
        buckets = buckets.withColumn("_wanted", F.expr(inside)).where("size(_wanted) > 0")
    else:
        buckets = buckets.where("_before = 0").withColumn("_wanted", F.lit(None))

    keys = [*by, "_b"]
    moments = ["_squares", *GROUP]
    if wanted:
        opened = (
            located.select(*keys, "v", "n")
            .join(buckets.select(*keys, "_wanted", *moments), keys)
            .withColumn("_skip", F.coalesce(F.sum("n").over(_open_bucket(by)), F.lit(0)))
            .select(*by, "v", "n", "_skip", *moments, F.explode("_wanted").alias("w"))
            .where("w.rank >= _skip AND w.rank < _skip + n")
        )
    else:
        opened = buckets.select(*by, *moments)

    columns = [
        "max(_total) AS count",
        "max(_mean) AS mean",
        "CASE WHEN max(_total) > 1 THEN sqrt(max(_squares) / (max(_total) - 1)) END AS std",
        "max(_min) AS min",
        "max(_max) AS max",
    ]
    for i, name in enumerate(probs):
        low = f"max(CASE WHEN w.slot = '{i}lo' THEN v END)"
        high = f"max(CASE WHEN w.slot = '{i}hi' THEN v END)"
        fraction = f"max(CASE WHEN w.slot = '{i}lo' THEN w.fraction END)"
        columns.append(f"{low} + ({high} - {low}) * {fraction} AS `{name}`")
    columns = [F.expr(c) for c in columns]
    return opened.groupBy(*by).agg(*columns)


def between_quantiles(
    df: DataFrame, value, low: float = 0.25, high: float = 0.75, copies: str | None = None
) -> DataFrame:
    """One row: count, mean, std and both quantiles of a column, and inner_count, inner_mean and
    inner_std of the values strictly between them. All come from one histogram; its rows meet
    the one row of quantiles."""
    hist = histogram(df, value, (), copies)
    whole = _distribution(hist, [], {"low": low, "high": high})
    rows = hist.select("*", _same()).join(F.broadcast(whole.select("*", _same("mean"))), "_all")
    inner = (F.col("v") > F.col("low")) & (F.col("v") < F.col("high"))
    figures = ["count", "mean", "std", "low", "high"]
    sums = rows.select(
        *figures, F.when(inner, F.col("n")).alias("k"),
        F.when(inner, F.col("v") - F.col("low")).alias("d"),
    ).groupBy(*figures).agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("inner_count"),
        F.expr("sum(k * d) AS _s"), F.expr("sum(k * d * d) AS _q"))
    return sums.select(
        *figures, "inner_count",
        F.expr("low + _s / nullif(inner_count, 0)").alias("inner_mean"),
        F.expr("""CASE WHEN inner_count > 1
          THEN sqrt(greatest(_q - _s * _s / inner_count, 0D) / (inner_count - 1)) END""")
        .alias("inner_std"))


def moments(df: DataFrame, value: str, copies: str | None = None, around=None) -> DataFrame:
    """count, mean and std (sample) of a column in one pass, nulls left out. Sums are of the
    distances from `around`, a value among the column's (the least one unless the caller has one
    at hand), so large values lose nothing."""
    v = F.col(value).cast("double")
    pivot = df.agg(F.min(v)).scalar() if around is None else around
    rows = df.select(
        (v - pivot).alias("d"), (F.col(copies) if copies else F.lit(1)).cast("long").alias("n"),
    ).where("d IS NOT NULL")
    sums = rows.selectExpr("sum(n) AS count", "sum(n * d) AS _s", "sum(n * d * d) AS _q")
    return sums.select(
        "count",
        (pivot + F.col("_s") / F.col("count")).alias("mean"),
        F.expr("""CASE WHEN count > 1 THEN sqrt(greatest(_q - _s * _s / count, 0D) / (count - 1))
           END""").alias("std"),
    )


def medians(
    df: DataFrame, value, by: Sequence[str] = (), name: str = "median", copies: str | None = None
) -> DataFrame:
    return distribution(df, value, by, {name: 0.5}, copies).select(*by, name)


def average_ranks(df: DataFrame, value, group: str, copies: str | None = None) -> DataFrame:
    """Per (group, value): rows, rows with that value in all groups, and their average rank.

    Columns are the group, v, n, n_value, total and avg_rank. Ranks run over all groups;
    only the values of one bucket are ordered together.
    """
    hist = histogram(df, value, [group], copies)
    located = _located(hist, [])
    buckets = _bucket_totals(located, []).select("_b", "_before")
    placed = located.join(buckets, "_b")
    return placed.selectExpr(
        group, "v", "n", "_total AS total", "_before",
        "sum(n) OVER (PARTITION BY _b, v) AS n_value",
        "sum(n) OVER (PARTITION BY _b ORDER BY v) AS _through",
    ).selectExpr(
        group, "v", "n", "n_value", "total",
        "_before + _through - n_value + (n_value + 1) / 2 AS avg_rank",
    )
