"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepath.llm.common import remove, written


def components(links: DataFrame, made: list[str]) -> DataFrame:
    """Rows (node, root) for all nodes of the links (a, b); root is the least node that can be
    reached. Each round every node of a star points its neighbours to its least neighbour, large
    ones first and then small ones, until nothing changes; a long chain halves in each round.
    Lineage is cut in the shared folder after each round, and the round before is removed; the
    result reads the first and the last one, which are added to `made`. Links with a null end are
    left out."""
    edges = written(links.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", made)
    rounds: list[str] = []
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("node", "m").alias("m"))
        large = both.join(least, both["a"] == least["node"]).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
        small = large.join(low, large["a"] == low["node"])
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("node").alias("a"), F.col("m").alias("b")))
        edges = written(small.where("a != b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
            "links", rounds)
        for path in rounds[:-1]:
            remove(links.sparkSession, path)
        del rounds[:-1]
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    made += rounds
    root = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "_a")
    return nodes.join(root, nodes["node"] == root["_a"], "left").select(
        "node", F.coalesce("root", "node").alias("root"))
