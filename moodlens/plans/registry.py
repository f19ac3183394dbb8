"""The catalogue of registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlens.plans import twin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Portable result types: long, double rounded to six places, string, boolean."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)``; ``sql`` may use the shared tables of :mod:`twin`."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = twin.with_tables(sql)
        return fn

    return register
