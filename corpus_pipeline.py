"""A corpus pipeline: toxic documents go, one of each group of near copies stays, documents that
contain test items go, live-looking secrets are masked, and what is left is packed into sequences.

Each stage gets a table with the columns of documents, extra ones included, and all but the last
return such a table; run() writes each as Parquet in the shared folder and reads it again. A
row is judged by its own text in all stages, also if it shares its id with others or has none; of
exact repeats one row stays in the second stage. Null ids, null texts and empty tables pass through the
stages as their operators define.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepath.llm import decontamination, jaccard, packing, secret_scan, toxicity
from tradepath.llm.common import table
from tradepath.session import tune
from tradepath.sources.workspace import materialise


def _ready(spark: SparkSession) -> None:
    tune(spark)
    # the stages share their executors' Python workers, which keep what their largest batch took
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.sparkContext.environment.setdefault(
        "PYTHONPATH", os.path.dirname(os.path.abspath(__file__)))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return jaccard.keep_one_row(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return decontamination.drop_contained(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _ready(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: The toxicity models and the packing rule are not expressible in SQL; tests hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
