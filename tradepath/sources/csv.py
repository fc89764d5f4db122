"""CSV files with declared schemas, and publishing of validated rows."""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradepath.contracts import TableContract
from tradepath.operators.quality import QUARANTINE_ON, contract_checks, flag_rows
from tradepath.sources.kafka import encode


def read_csv(spark: SparkSession, path: str, schema, multi_line: bool = False) -> DataFrame:
    """CSV with a header and a declared schema; a missing path is an error.

    Line breaks inside quoted text need `multi_line`, which reads each file in one task: such
    files should be bounded, as `write_csv` does. Leave it off for tables without free text, so
    that files split.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, file_bytes: int | None = None) -> None:
    """CSV with a header. No file gets more than `file_bytes` of rows, if that is given, or one row:
    the longest row is measured first, and each file holds as many rows as fit if all were as long.
    """
    out = df.write.option("header", True).option("quote", '"').option("escape", '"')
    if file_bytes is not None:
        # a value, its doubled quotes, the quotes around it and the separator
        row = sum((F.coalesce(F.octet_length(F.replace(
            F.col(f"`{c}`").cast("string"), F.lit('"'), F.lit('""'))), F.lit(0)).cast("long") + 3
            for c in df.columns), F.lit(0))
        longest = df.agg(F.max(row)).first()[0] or 1
        out = out.option("maxRecordsPerFile", max(1, file_bytes // longest))
    out.csv(path)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    if n < 1:
        raise ValueError("a preview needs at least one row")
    return df.limit(n)


def publish(df: DataFrame, contract: TableContract, write, quarantine_on=QUARANTINE_ON):
    """Encode the rows that meet the contract and hand them to `write`; return the counts.

    `write` takes a frame with key and value, for instance a Kafka or file writer, and must
    run one action on it. The counts are observed while it runs, so the data is read once.
    """
    seen = Observation(f"publish-{uuid.uuid4().hex}")
    bad = F.size("_failed_checks") > 0
    flagged = flag_rows(df, contract_checks(contract), quarantine_on).observe(
        seen,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(~bad).alias("published"),
        F.count_if(bad).alias("skipped_invalid"),
    )
    write(encode(flagged.where(~bad).drop("_failed_checks"), contract.key))
    counts = {**seen.get, "failed": 0}
    return df.sparkSession.range(1).select(
        *[F.lit(n).cast("long").alias(name) for name, n in counts.items()]
    )
