"""Distributed quantiles, ranks and tests against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradepath.operators import hypothesis as h
from tradepath.operators.quantiles import average_ranks, distribution, histogram, moments

PROBS = {"p0": 0.0, "p10": 0.1, "q1": 0.25, "med": 0.5, "q3": 0.75, "p99": 0.99, "p100": 1.0}


def samples(seed=3):
    rng = random.Random(seed)
    return {
        "money": [round(rng.expovariate(0.01), 2) for _ in range(997)],
        "hot": [42.0] * 700 + [rng.uniform(-5, 5) for _ in range(300)],
        "signed": [rng.gauss(0, 1e6) for _ in range(500)],
        "tiny": [rng.random() * 1e-7 for _ in range(301)],
        "huge": [rng.random() * 1e15 for _ in range(64)],
        "one": [7.5],
        "two": [1.0, 2.0],
        "ints": [float(rng.randint(-3, 3)) for _ in range(400)],
    }


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(g, v) for g, vs in samples().items() for v in vs]
    rows += [("money", None), (None, 3.0), ("empty", None)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double").repartition(7)


def test_distribution_per_group(frame):
    got = {r["g"]: r for r in distribution(frame, "v", ["g"], PROBS).collect()}
    assert set(got) == set(samples())
    for g, values in samples().items():
        x = np.array(values)
        assert got[g]["count"] == len(x)
        assert math.isclose(got[g]["mean"], x.mean(), rel_tol=1e-9, abs_tol=1e-12)
        assert (got[g]["min"], got[g]["max"]) == (x.min(), x.max())
        if len(x) > 1:
            assert math.isclose(got[g]["std"], x.std(ddof=1), rel_tol=1e-6)
        else:
            assert got[g]["std"] is None
        for name, p in PROBS.items():
            assert math.isclose(got[g][name], np.quantile(x, p), rel_tol=1e-12, abs_tol=1e-18)


def test_distribution_without_group_and_empty(frame):
    every = np.array([v for vs in samples().values() for v in vs] + [3.0])
    got = distribution(frame, "v", (), {"med": 0.5}).first()
    assert got["count"] == len(every)
    assert math.isclose(got["med"], np.quantile(every, 0.5))
    empty = distribution(frame.where("false"), "v", (), {"med": 0.5}).collect()
    assert len(empty) == 1 and empty[0]["med"] is None


def test_copies_equal_repeated_rows(spark):
    rng = random.Random(5)
    rows = [("a" if rng.random() < 0.3 else "b", round(rng.random() * 50, 1), rng.randint(1, 9))
            for _ in range(300)]
    packed = spark.createDataFrame(rows, "g string, v double, k long")
    repeated = packed.select("g", "v", F.explode(F.expr("sequence(1, k)")))
    a = distribution(packed, "v", ["g"], PROBS, "k").orderBy("g").collect()
    b = distribution(repeated, "v", ["g"], PROBS).orderBy("g").collect()
    for x, y in zip(a, b):
        for c in x.asDict():
            assert x[c] == y[c] or math.isclose(x[c], y[c], rel_tol=1e-12)
    one, many = moments(packed, "v", "k").first(), moments(repeated, "v").first()
    values = np.array([r["v"] for r in repeated.collect()])
    assert one["count"] == many["count"] == len(values)
    assert math.isclose(one["mean"], values.mean()) and math.isclose(one["std"], values.std(ddof=1))
    assert histogram(packed, "v", ["g"], "k").agg(F.sum("n")).first()[0] == repeated.count()


def brute_ranks(values):
    ordered = sorted(values)
    first = {}
    for i, v in enumerate(ordered):
        first.setdefault(v, [i + 1, 0])[1] += 1
    return {v: start + (n - 1) / 2 for v, (start, n) in first.items()}


@pytest.fixture(scope="module")
def groups(spark):
    rng = random.Random(11)
    data = {
        "a": [float(rng.randint(1, 5)) for _ in range(300)],
        "b": [float(rng.randint(2, 6)) for _ in range(120)],
        "c": [rng.gauss(4, 2) for _ in range(80)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs],
                               "g string, v double").repartition(5)
    return data, df


def test_average_ranks(groups):
    data, df = groups
    expected = brute_ranks([v for vs in data.values() for v in vs])
    rows = average_ranks(df, "v", "g").collect()
    assert {r["v"]: r["avg_rank"] for r in rows} == expected
    assert sum(r["n"] for r in rows) == 500


def rank_parts(data):
    ranks = brute_ranks([v for vs in data.values() for v in vs])
    n = sum(map(len, data.values()))
    counts = {}
    for vs in data.values():
        for v in vs:
            counts[v] = counts.get(v, 0) + 1
    ties = sum(t ** 3 - t for t in counts.values())
    return ranks, n, ties


def test_kruskal(groups):
    data, df = groups
    ranks, n, ties = rank_parts(data)
    q = sum(sum(ranks[v] for v in vs) ** 2 / len(vs) for vs in data.values())
    expected = (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (n ** 3 - n))
    row = h.kruskal_wallis(df, "v", "g").first()
    assert math.isclose(row["h"], expected, rel_tol=1e-9)
    assert (row["groups"], row["dof"], row["n"]) == (3, 2, 500)


def test_mann_whitney(groups):
    data, df = groups
    a, b = data["a"], data["b"]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    row = h.mann_whitney(df, "v", "g", "a", "b").first()
    assert row["u"] == u
    _, n, ties = rank_parts({"a": a, "b": b})
    n1, n2 = len(a), len(b)
    s = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    assert math.isclose(row["z"], (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / s, rel_tol=1e-9)


def test_dunn(groups):
    data, df = groups
    ranks, n, ties = rank_parts(data)
    mean = {g: sum(ranks[v] for v in vs) / len(vs) for g, vs in data.items()}
    rows = h.dunn_bonferroni(df, "v", "g").collect()
    assert {(r["group_a"], r["group_b"]) for r in rows} == set(itertools.combinations("abc", 2))
    for r in rows:
        a, b = r["group_a"], r["group_b"]
        spread = math.sqrt((n * (n + 1) / 12 - ties / (12 * (n - 1)))
                           * (1 / len(data[a]) + 1 / len(data[b])))
        z = abs(mean[a] - mean[b]) / spread
        assert math.isclose(r["z"], z, rel_tol=1e-9)
        assert math.isclose(r["p_value"], min(1, 3 * math.erfc(z / math.sqrt(2))), rel_tol=1e-6)


def test_dunn_of_many_groups(spark):
    """5,000 groups: 12,497,500 pairs, none twice, no array of all groups, no nested loop."""
    df = spark.range(20_000).select(
        F.format_string("g%d", F.col("id") % 5000).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(997)).alias("v"))
    pairs = h.dunn(df, "v", "g")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "collect_list" not in plan
    row = pairs.agg(F.count(F.lit(1)), F.count_if(F.col("group_a") < F.col("group_b")),
                    F.min("n_pairs"), F.max("n_pairs"), F.sum(F.hash("group_a", "group_b"))).first()
    assert tuple(row)[:4] == (12_497_500,) * 4
    few = df.where("g IN ('g1', 'g2', 'g3', 'g4')")
    for blocks in (1, 2, 7):
        got = h.dunn(few, "v", "g", blocks=blocks).orderBy("group_a", "group_b").collect()
        assert got == h.dunn(few, "v", "g").orderBy("group_a", "group_b").collect()
        assert len(got) == 6


def test_two_proportions_and_chi_square(spark):
    rows = [(True, True)] * 30 + [(False, True)] * 70 + [(True, False)] * 15 + [(False, False)] * 85
    df = spark.createDataFrame(rows, "hit boolean, late boolean")
    row = h.two_proportions(df, F.col("hit"), F.col("late")).first()
    pooled = 45 / 200
    z = (0.30 - 0.15) / math.sqrt(pooled * (1 - pooled) * (2 / 100))
    assert math.isclose(row["z"], z)
    chi = h.chi_square_2x2(df, F.col("hit"), F.col("late")).first()
    assert math.isclose(chi["chi_square"], z * z)
    assert math.isclose(chi["risk_ratio"], 2.0)


def test_tail_probabilities(spark):
    zs = [-2.0, 0.0, 0.5, 1.96, 3.0, 3.1, 5.0, 20.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for r in h.add_normal_p(df, "z", 1).collect():
        assert math.isclose(r["p_value"], 0.5 * math.erfc(r["z"] / math.sqrt(2)), rel_tol=1e-9)
    # upper 5 % points from standard tables
    table = [(3.841459, 1), (5.991465, 2), (7.814728, 3), (9.487729, 4), (18.307038, 10)]
    df = spark.createDataFrame(table, "x double, k long")
    for r in h.add_chi_square_p(df, "x", "k").collect():
        assert abs(r["p_value"] - 0.05) < 1e-6


def test_std_of_large_values(spark):
    """Instants, identifiers and coordinates: little spread far from zero."""
    rows = [(g, base + i, 1 + i % 2) for g, base in (("a", 1e9), ("b", 1.7e15), ("c", -23.5))
            for i in range(3)]
    df = spark.createDataFrame(rows, "g string, v double, k long")
    want = {r["g"]: r["s"] for r in df.groupBy("g").agg(F.stddev_samp("v").alias("s")).collect()}
    got = {r["g"]: r["std"] for r in distribution(df, "v", ["g"], {"m": 0.5}).collect()}
    assert got == pytest.approx(want) and got["a"] == pytest.approx(1.0)
    many = df.where("g = 'a'").selectExpr("v", "explode(sequence(1L, k)) AS one")
    expected = many.agg(F.stddev_samp("v")).first()[0]
    assert moments(df.where("g = 'a'"), "v", "k").first()["std"] == pytest.approx(expected)


def test_narrow_ranges_split(spark):
    """Values near 1e9 do not share a few buckets."""
    from tradepath.operators.quantiles import _located, histogram

    df = spark.range(5000).selectExpr("1e9 + id AS v")
    buckets = _located(histogram(df, "v"), ()).select("_b").distinct().count()
    assert buckets > 1000
