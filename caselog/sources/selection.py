"""Which entities of a registry a pull takes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def change_window(
    df: DataFrame, date_col: Column | str, since: str | date | None = None, until: str | date | None = None
) -> DataFrame:
    """Rows changed between two days, both included: by default the last seven days, without an
    upper bound. Successive windows may overlap; the log keeps every copy."""
    changed = F.col(date_col) if isinstance(date_col, str) else date_col
    first = since or date.today() - timedelta(days=7)
    condition = changed >= F.lit(first).cast("date")
    if until is not None and until != "MAX":
        condition = condition & (changed <= F.lit(until).cast("date"))
    return df.where(condition)


def cohort(df: DataFrame, study_type: str, phases: list[str], condition: str) -> DataFrame:
    """Studies of a type, in any of the phases, with a condition naming the given word."""
    return df.where(
        (F.col("study_type") == study_type)
        & F.arrays_overlap("phases", F.array(*[F.lit(p) for p in phases]))
        & F.exists("conditions", lambda c: F.contains(F.lower(c), F.lit(condition.lower())))
    )
