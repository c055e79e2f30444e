"""How old the newest row of each source is."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD_SCHEMA = (
    "source_name string, table_name string, checked boolean, warn_hours int, error_hours int"
)

# Hours after which a source is late. A row with a table name overrides its source's
# row; a source with checked = false opts out.
THRESHOLDS = [
    ("ctgov", None, True, 26, 50),
    ("ctgov", "studies", True, 12, 24),
    ("faers", None, True, 45 * 24, 120 * 24),
    ("drugsfda", None, True, 14 * 24, 30 * 24),
    ("mesh", None, False, None, None),
]


def threshold_frame(spark: SparkSession, rows: list[tuple] = THRESHOLDS) -> DataFrame:
    return spark.createDataFrame(rows, THRESHOLD_SCHEMA)


def freshness(
    sources: dict[tuple[str, str], DataFrame],
    thresholds: DataFrame,
    now: datetime | str,
    loaded_at: str = "_loaded_at",
) -> DataFrame:
    """One row per checked source table: its newest load, age in seconds and pass / warn / error.

    sources maps (source name, table name) to the landed rows. Sources that opted out do not show
    up at all, neither as passed. An empty table is an error.
    """
    newest = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at")).select(
                F.lit(source).alias("source_name"), F.lit(table).alias("table_name"), "max_loaded_at"
            )
            for (source, table), df in sources.items()
        ],
    )
    limit_fields = F.struct("checked", "warn_hours", "error_hours")
    of_source = thresholds.where("table_name is null").select("source_name", limit_fields.alias("s"))
    of_table = thresholds.where("table_name is not null").select(
        "source_name", "table_name", limit_fields.alias("t")
    )
    instant = F.lit(now).cast("timestamp")
    age = F.unix_timestamp(instant) - F.unix_timestamp("max_loaded_at")
    return (
        newest.join(F.broadcast(of_source), "source_name", "left")
        .join(F.broadcast(of_table), ["source_name", "table_name"], "left")
        .withColumn("_limits", F.coalesce(F.col("t"), F.col("s")))
        .where("_limits.checked")
        .withColumn("age_seconds", age)
        .select(
            "source_name",
            "table_name",
            "max_loaded_at",
            "age_seconds",
            F.col("_limits.warn_hours").alias("warn_hours"),
            F.col("_limits.error_hours").alias("error_hours"),
            F.when(F.col("age_seconds").isNull(), "error")
            .when(F.col("age_seconds") > F.col("_limits.error_hours") * 3600, "error")
            .when(F.col("age_seconds") > F.col("_limits.warn_hours") * 3600, "warn")
            .otherwise("pass")
            .alias("status"),
        )
    )
