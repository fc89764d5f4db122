"""Hypothesis tests as distributed aggregates.

Counting and ranking run on Spark; each test ends in one small row per test, group or
pair. Tail probabilities are expressions over those few rows.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepath.operators.quantiles import average_ranks


def normal_tail(z: str) -> Column:
    """P(Z > z) of the standard normal for a column name.

    Up to 3 by the power series of the distribution, beyond by its continued fraction.
    """
    density = f"(exp(-a * a / 2) / {math.sqrt(2 * math.pi)!r}D)"
    series = f"""(0.5D - {density} * aggregate(sequence(0, 60), struct(a AS t, 0D AS s),
        (acc, k) -> struct(acc.t * a * a / (2 * k + 3) AS t, acc.s + acc.t AS s), acc -> acc.s))"""
    fraction = f"""({density} / (a + aggregate(sequence(200, 1, -1), 0D,
        (acc, k) -> k / (a + acc))))"""
    upper = f"CASE WHEN a <= 3 THEN {series} ELSE {fraction} END"
    # the absolute value is bound once, as the only element of an array
    return F.expr(f"""transform(array(abs(CAST(`{z}` AS DOUBLE))), a ->
        CASE WHEN `{z}` >= 0 THEN {upper} ELSE 1D - ({upper}) END)[0]""")


def add_normal_p(df: DataFrame, z: str, sides: int, name: str = "p_value") -> DataFrame:
    """Upper tail of a z column, or both tails."""
    if sides == 1:
        return df.withColumn(name, normal_tail(z))
    both = df.withColumn("_abs_z", F.abs(F.col(z)))
    return both.withColumn(name, F.least(2 * normal_tail("_abs_z"), F.lit(1.0))).drop("_abs_z")


def add_chi_square_p(df: DataFrame, statistic: str, dof: str, name: str = "p_value") -> DataFrame:
    """Upper tail of chi-square with whole degrees of freedom, by its finite series."""
    root = df.withColumn("_root", F.sqrt(F.col(statistic))).withColumn(
        "_tail", 2 * normal_tail("_root")
    )
    x = f"CAST(`{statistic}` AS DOUBLE)"
    steps = f"CAST((`{dof}` - 1) DIV 2 AS INT)"
    terms = """aggregate(CASE WHEN {steps} > 0 THEN sequence(1, {steps}) ELSE array() END,
        struct({first} AS t, 0D AS s),
        (acc, j) -> struct(acc.t * {x} / (2 * j + {shift}) AS t, acc.s + acc.t AS s),
        acc -> acc.s)"""
    odd = terms.format(steps=steps, first="_root", x=x, shift=1)
    even = terms.format(steps=steps, first=f"{x} / 2", x=x, shift=2)
    return root.withColumn(name, F.expr(f"""CASE WHEN {x} <= 0 THEN 1D
        WHEN `{dof}` % 2 = 1
          THEN _tail + 2 * exp(-{x} / 2) / {math.sqrt(2 * math.pi)!r}D * {odd}
        ELSE exp(-{x} / 2) * (1 + {even}) END""")).drop("_root", "_tail")


def _rows_where(condition: str, weight: str = "w") -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN {weight} END), 0L)"


def _weight(copies: str | None) -> Column:
    return (F.col(copies) if copies else F.lit(1)).cast("long").alias("w")


def two_proportions(
    df: DataFrame, success: Column, treated: Column, copies: str | None = None
) -> DataFrame:
    """z of success share in treated rows against the others, pooled variance."""
    flags = df.select(success.alias("s"), treated.alias("t"), _weight(copies))
    counts = flags.selectExpr(
        f"{_rows_where('s AND t')} AS success_treated",
        f"{_rows_where('t')} AS n_treated",
        f"{_rows_where('s AND NOT t')} AS success_other",
        f"{_rows_where('NOT t')} AS n_other",
    )
    s1, n1, s2, n2 = (F.col(c) for c in counts.columns)
    pooled = (s1 + s2) / (n1 + n2)
    z = F.try_divide(
        F.try_divide(s1, n1) - F.try_divide(s2, n2),
        F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), n1) + F.try_divide(F.lit(1), n2))),
    )
    return counts.withColumn("z", z)


def chi_square_2x2(
    df: DataFrame, outcome: Column, exposed: Column, copies: str | None = None
) -> DataFrame:
    """Chi-square without continuity correction, and the risk ratio of the exposed."""
    flags = df.select(outcome.alias("o"), exposed.alias("e"), _weight(copies))
    counts = flags.selectExpr(
        f"CAST({_rows_where('e AND o')} AS DOUBLE) AS a",
        f"CAST({_rows_where('e AND NOT o')} AS DOUBLE) AS b",
        f"CAST({_rows_where('NOT e AND o')} AS DOUBLE) AS c",
        f"CAST({_rows_where('NOT e AND NOT o')} AS DOUBLE) AS d",
    )
    a, b, c, d = (F.col(x) for x in "abcd")
    n = a + b + c + d
    chi = F.try_divide(n * F.pow(a * d - b * c, 2), (a + b) * (c + d) * (a + c) * (b + d))
    risk = F.try_divide(F.try_divide(a, a + b), F.try_divide(c, c + d))
    return counts.select(
        a.cast("long").alias("exposed_hit"), b.cast("long").alias("exposed_miss"),
        c.cast("long").alias("other_hit"), d.cast("long").alias("other_miss"),
        chi.alias("chi_square"), risk.alias("risk_ratio"),
    )


def rank_sums(df: DataFrame, value, group: str, copies: str | None = None) -> DataFrame:
    """Per group: rows, rank sum, the total over all groups, and its part of the tie term.

    A value held by t rows adds t^3 - t to the tie term, which is t^2 - 1 for each row.
    """
    return average_ranks(df, value, group, copies).groupBy(F.col(group).alias("group")).agg(
        F.expr("sum(n) AS n"),
        F.expr("sum(n * avg_rank) AS rank_sum"),
        F.expr("max(total) AS total"),
        F.expr("sum(CAST(n AS DOUBLE) * (CAST(n_value AS DOUBLE) * n_value - 1)) AS ties"),
    )


def mann_whitney(
    df: DataFrame, value, group: str, first: str, second: str, copies: str | None = None
) -> DataFrame:
    """U of the first group, and z with tie and continuity correction."""
    two = df.where(F.col(group).isin(first, second))
    one = rank_sums(two, value, group, copies).agg(
        F.max(F.when(F.col("group") == first, F.col("rank_sum"))).alias("r1"),
        F.max(F.when(F.col("group") == first, F.col("n"))).cast("double").alias("n1"),
        F.max(F.when(F.col("group") == second, F.col("n"))).cast("double").alias("n2"),
        F.sum("ties").alias("ties"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u = F.col("r1") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n2 / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1))))
    larger = F.greatest(u, n1 * n2 - u)
    return one.select(
        n1.cast("long").alias("n1"), n2.cast("long").alias("n2"), u.alias("u"),
        F.try_divide(larger - n1 * n2 / 2 - 0.5, spread).alias("z"),
    )


def kruskal_wallis(df: DataFrame, value, group: str, copies: str | None = None) -> DataFrame:
    """H over all groups with tie correction, and its degrees of freedom."""
    one = rank_sums(df, value, group, copies).agg(
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("n")).alias("q"),
        F.count(F.lit(1)).alias("k"),
        F.max("total").cast("double").alias("n"),
        F.sum("ties").alias("ties"),
    )
    n = F.col("n")
    h = (12 / (n * (n + 1)) * F.col("q") - 3 * (n + 1)) / (
        1 - F.col("ties") / (n * n * n - n)
    )
    return one.select(
        F.col("k").alias("groups"), n.cast("long").alias("n"), h.alias("h"),
        (F.col("k") - 1).alias("dof"),
    )


#: Blocks of groups whose pairs are formed together; each group is copied once for each.
BLOCKS = 32


def dunn(df: DataFrame, value, group: str, copies: str | None = None, blocks: int = BLOCKS
         ) -> DataFrame:
    """z of the mean rank difference for each pair of groups, and the number of pairs.

    Groups are rows, dealt into blocks; a join on the pair of blocks forms the pairs, so the
    groups of two blocks meet in a task, never all of them. Each group carries its own part of the
    variance, which the two of a pair add up.
    """
    key = F.pmod(F.xxhash64("group"), F.lit(1)).alias("_all")  # 0, which the optimiser cannot fold
    groups = rank_sums(df, value, group, copies).select("*", key)
    figures = groups.groupBy("_all").agg(
        F.max("total").cast("double").alias("_n"), F.sum("ties").alias("_ties"),
        F.count(F.lit(1)).alias("_k"))
    n = F.col("_n")
    spread = (n * (n + 1) / 12 - F.col("_ties") / (12 * (n - 1))) / F.col("n")
    groups = groups.join(F.broadcast(figures), "_all").select(
        "group", (F.col("rank_sum") / F.col("n")).alias("mean"), spread.alias("part"),
        (F.col("_k") * (F.col("_k") - 1) / 2).cast("long").alias("n_pairs"),
        F.pmod(F.xxhash64("group"), F.lit(blocks)).cast("int").alias("_block"))
    first = groups.select(
        F.col("group").alias("a"), F.col("mean").alias("mean_a"), F.col("part").alias("part_a"),
        "n_pairs", F.col("_block").alias("_i"),
        F.explode(F.sequence(F.col("_block"), F.lit(blocks - 1))).alias("_j"))
    second = groups.select(
        F.col("group").alias("b"), F.col("mean").alias("mean_b"), F.col("part").alias("part_b"),
        F.col("_block").alias("_j"), F.explode(F.sequence(F.lit(0), F.col("_block"))).alias("_i"))
    pairs = first.join(second, ["_i", "_j"]).where("_i < _j OR a < b")
    return pairs.select(
        F.least("a", "b").alias("group_a"), F.greatest("a", "b").alias("group_b"),
        (F.abs(F.col("mean_a") - F.col("mean_b")) / F.sqrt(F.col("part_a") + F.col("part_b")))
        .alias("z"),
        "n_pairs",
    )


def dunn_bonferroni(df: DataFrame, value, group: str, copies: str | None = None):
    """Dunn pairs with two-sided probabilities, multiplied by the number of pairs."""
    out = add_normal_p(dunn(df, value, group, copies), "z", 2, "p_raw")
    return out.withColumn("p_value", F.least(F.col("p_raw") * F.col("n_pairs"), F.lit(1.0)))


def log_histogram(
    df: DataFrame, value: str, group: str, bins: int, low: float, high: float,
    copies: str | None = None,
) -> DataFrame:
    """Rows per group and equal-width bin of log1p(value); outer bins are 0 and bins + 1."""
    x = F.log1p(F.col(value).cast("double"))
    kept = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    return kept.groupBy(
        group, F.width_bucket(x, F.lit(low), F.lit(high), F.lit(bins)).alias("bin")
    ).agg((F.sum(copies) if copies else F.count(F.lit(1))).alias("n"))
