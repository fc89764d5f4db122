"""Every query by name, with the SQL that checks it where SQL can express it."""

from importlib import import_module

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepath.adapters import Marketplace
from tradepath.registry.sql import query as _with_views
from tradepath.session import tune

QUERIES = {}
ORACLES = {}

_SECTIONS = ["sources", "validation", "silver", "joins", "kpis", "measures", "hypotheses",
             "ordering", "text", "streams", "warehouse", "metrics"]


def presentable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, decimals as doubles, dates and times as text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str, sql: str | None = None, digits: int = 6):
    """Add a function of a Marketplace to the registry, with its checking SQL."""

    def wrap(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, path: presentable(
            build(Marketplace(tune(spark), path)), digits
        )
        if sql is not None:
            ORACLES[name] = _with_views(sql)
        return build

    return wrap


def load():
    for section in _SECTIONS:
        import_module(f"tradepath.registry.{section}")
    return QUERIES, ORACLES
