"""Queries by name, each with the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselog.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType)


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text and integers as bigint, so that any engine's result compares."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        return c.cast("bigint").alias(f.name) if isinstance(f.dataType, INTEGRAL) else c

    return df.select(*[column(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return portable(function(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register
