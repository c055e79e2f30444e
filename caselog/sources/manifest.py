"""Which published files to load, and whether what landed matches what was declared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

# Fixed value: where a path names its quarter.
QUARTER_PATTERN = r"/drug/event/(\d{4})q(\d)/"


def with_quarter(index: DataFrame) -> DataFrame:
    """Add year and quarter parsed from the path; both NULL for an undated file."""
    year = F.regexp_extract("file", QUARTER_PATTERN, 1).try_cast("int")
    quarter = F.regexp_extract("file", QUARTER_PATTERN, 2).try_cast("int")
    return index.withColumn("year", year).withColumn("quarter", quarter)


def undated_parts(index: DataFrame) -> DataFrame:
    """Files set aside because their path names no quarter."""
    return with_quarter(index).where("year is null").drop("year", "quarter")


def plan_parts(
    index: DataFrame,
    quarters: list[tuple[int, int]] | None = None,
    newest: int = 2,
    parts: int = 3,
) -> DataFrame:
    """The first `parts` files by path of each chosen quarter: the listed ones, or the newest.

    Listed quarters that the index lacks are an error.
    """
    dated = with_quarter(index).where("year is not null")
    available = dated.select("year", "quarter").distinct()
    if quarters is None:
        chosen = available.orderBy(F.desc("year"), F.desc("quarter")).limit(newest)
    else:
        wanted = index.sparkSession.createDataFrame(sorted(set(quarters)), "year int, quarter int")
        absent = wanted.join(available, ["year", "quarter"], "left_anti").limit(10).collect()
        if absent:
            raise ValueError(f"not in the index: {[f'{r.year}q{r.quarter}' for r in absent]}")
        chosen = wanted
    by_path = Window.partitionBy("year", "quarter").orderBy("file")
    # `chosen` has one row per asked-for quarter, a number the caller gives.
    return (
        dated.join(F.broadcast(chosen), ["year", "quarter"])
        .withColumn("part_no", F.row_number().over(by_path))
        .where(F.col("part_no") <= parts)
    )


def plan_totals(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count("*").alias("n_parts"),
        F.sum("records").alias("records"),
        F.sum(F.col("size_mb").cast("double")).alias("size_mb"),
    )


def landed_counts(landed: DataFrame, file_col: str = "_source_file") -> DataFrame:
    return landed.groupBy(F.col(file_col).alias("file")).agg(F.count("*").alias("written"))


def reconcile_parts(plan: DataFrame, landed: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """Per file: declared against landed records, which are counted from the landed rows."""
    return reconcile_counts(plan, landed_counts(landed), present)


def reconcile_counts(plan: DataFrame, counts: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """Per file: declared against landed records, given as (file, written).

    present lists files that were there before the load; they are skipped, so nothing was written
    for them. A file landed without being planned is a MISMATCH too.
    """
    files = plan.select("file", "records").join(counts, "file", "full")
    if present is None:
        known = files.withColumn("_present", F.lit(False))
    else:
        marks = present.select("file").distinct().withColumn("_mark", F.lit(True))
        known = files.join(marks, "file", "left").withColumn("_present", F.col("_mark").isNotNull()).drop("_mark")
    return known.select(
        "file",
        "records",
        F.when(F.col("_present"), None).otherwise(F.coalesce("written", F.lit(0))).cast("bigint").alias("written"),
        F.when(F.col("_present"), "already present")
        .when(F.col("written").eqNullSafe(F.col("records")), "ok")
        .otherwise("MISMATCH")
        .alias("status"),
    )


def reconcile_totals(reconciled: DataFrame) -> DataFrame:
    """Written, already present and planned records; what was present is not counted as written."""
    present = F.col("status") == "already present"
    return reconciled.agg(
        F.coalesce(F.sum("written"), F.lit(0)).alias("written"),
        F.coalesce(F.sum(F.when(present, F.col("records"))), F.lit(0)).alias("already_present"),
        F.sum("records").alias("plan_total"),
        F.count_if(F.col("status") == "MISMATCH").alias("n_mismatch"),
    )
