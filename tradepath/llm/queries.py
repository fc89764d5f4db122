"""The queries of this folder and the SQL that checks them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradepath.llm import (
    ball_codes,
    decontamination,
    fingerprints,
    jaccard,
    language,
    packing,
    quality,
    repeats,
    ring,
    runs,
    secret_scan,
    separators,
    toxicity,
)
from tradepath.llm.common import table
from tradepath.session import tune

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def wrap(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            # Python workers on this machine find the package wherever the driver was started
            spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
            return build(lambda t: table(spark, sf_dir, t))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return wrap


@_query("op3_secret_scan")
def _(read):
    return secret_scan.digest(secret_scan.find_secrets(read("documents")))


@_query("op5_benchmark_decontamination",
        decontamination.CONTAINED_SQL.replace("{docs}", "documents"))
def _(read):
    return decontamination.contained_items(read("documents"), read("benchmark"))


@_query("op9_best_fit_packing")
def _(read):
    return packing.pack_documents(read("documents"))


@_query("op10_toxicity")
def _(read):
    return toxicity.score(read("documents"), read("labels"))


@_query("op8_ngram_jaccard_join", jaccard.LINKS_SQL)
def _(read):
    return jaccard.near_duplicates(read("documents"))


@_query("op1_suffix_array_dedup")
def _(read):
    return repeats.remove_repeats(read("documents"))


@_query("op2_language_id")
def _(read):
    return language.identify(read("documents"))


@_query("op7_quality_ranking")
def _(read):
    return quality.score(read("documents"), read("labels"))


@_query("op6_fingerprint_digest")
def _(read):
    return fingerprints.compare_with_next(read("documents"))


@_query("op4_separator_scan")
def _(read):
    return separators.count_tokens(read("documents"))


@_query("op11_bounded_ring")
def _(read):
    return ring.digest(ring.assign(read("documents")))


@_query("op12_periodic_runs")
def _(read):
    return runs.digest(runs.rewritten(read("documents")))


@_query("op13_ball_codes", ball_codes.CODES_SQL)
def _(read):
    return ball_codes.encode(read("embeddings"))
