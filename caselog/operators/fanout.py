"""Operators that change the grain, and row generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fan_out(
    df: DataFrame, arr: str, seq_name: str, item_name: str, outer: bool = False
) -> DataFrame:
    """One row per array item with its 0-based position. Rows without items are dropped, or kept
    with NULL position and item when outer. The array column itself is not carried along."""
    explode = F.posexplode_outer if outer else F.posexplode
    rest = [F.col(f"`{c}`") for c in df.columns if c != arr]
    return df.select(*rest, explode(F.col(arr)).alias(seq_name, item_name))


def days_between(ends: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from the first to the last date of a one-row frame, in a column date_day."""
    return ends.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))).alias("date_day"))


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from start to end, both included, in a column date_day."""
    ends = spark.range(1).select(F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("last"))
    return days_between(ends, "first", "last")


def recursive_sequence(spark: SparkSession, n: int) -> DataFrame:
    """1..n by a recursive query. Spark's bounds on depth and rows are raised where n needs it."""
    for bound in ("spark.sql.cteRecursionLevelLimit", "spark.sql.cteRecursionRowLimit"):
        if int(spark.conf.get(bound)) <= n:
            spark.conf.set(bound, str(n + 1))
    return spark.sql(
        "WITH RECURSIVE seq(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM seq WHERE n < :last) "
        "SELECT n FROM seq",
        args={"last": int(n)},
    )


def to_long(df: DataFrame, metrics: dict[str, tuple[Column | str, str | None]]) -> DataFrame:
    """A wide one-row frame as (metric, value, denominator) rows.

    metrics maps the metric to its value and to the metric to divide it by, if there is one.
    """
    cells: list[Column] = []
    for name, (value, denominator) in metrics.items():
        column = F.col(value) if isinstance(value, str) else value
        cells += [F.lit(name), column.cast("bigint"), F.lit(denominator).cast("string")]
    return df.select(
        F.stack(F.lit(len(metrics)), *cells).alias("metric", "value", "denominator")
    )
