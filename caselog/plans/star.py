"""Dimensions and the reaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.functions import calendar_columns, date_key, surrogate_key
from caselog.functions.text import DRUG_NAME_SOURCES, NO_CODE
from caselog.operators.aggregates import priority_label
from caselog.operators.fanout import date_spine
from caselog.operators.joins import Dimension, star_join

# The span of the calendar.
CALENDAR_START = "1960-01-01"
CALENDAR_END = "2027-12-31"
NO_CODE_LABEL = "Not stated"


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day."""
    return calendar_of(date_spine(spark, start, end))


def calendar_of(days: DataFrame) -> DataFrame:
    """Calendar attributes of the days in date_day."""
    return days.select(*calendar_columns(F.col("date_day")))


def dim_outcome(seed: DataFrame) -> DataFrame:
    """The seeded codes and the default row for a missing one."""
    default = seed.sparkSession.createDataFrame([(NO_CODE, NO_CODE_LABEL)], seed.schema)
    return seed.unionByName(default).select(
        surrogate_key("outcome_code").alias("outcome_key"), "outcome_code", "outcome_label"
    )


def dim_drug(susp: DataFrame) -> DataFrame:
    """One row per drug name. A name that any report took from the harmonised field counts as such."""
    return (
        susp.groupBy("drug_name")
        .agg(
            priority_label(F.col("drug_name_source"), DRUG_NAME_SOURCES).alias("drug_name_source"),
            F.count("*").alias("n_reports"),
        )
        .select(surrogate_key("drug_name").alias("drug_key"), "drug_name", "drug_name_source", "n_reports")
    )


def dim_reaction(react: DataFrame) -> DataFrame:
    return (
        react.groupBy("reaction_term")
        .agg(F.count("*").alias("n_reactions"))
        .select(surrogate_key("reaction_term").alias("reaction_key"), "reaction_term", "n_reactions")
    )


def fact_reactions(react: DataFrame) -> DataFrame:
    """One row per reaction within a report. Foreign keys hash the same values as the dimensions
    do, so no join is needed to find them. Count deaths over distinct reports, never over rows."""
    return react.select(
        surrogate_key("safety_report_id", "reaction_seq").alias("reaction_event_key"),
        date_key(F.col("receive_date")).alias("receive_date_key"),
        surrogate_key("drug_name").alias("drug_key"),
        surrogate_key("outcome_code").alias("outcome_key"),
        surrogate_key("reaction_term").alias("reaction_key"),
        "safety_report_id",
        "receive_date",
        "is_serious",
        "is_report_death",
        "is_probable_duplicate",
        "n_suspect_drugs",
    )


def exclude_duplicates(df: DataFrame) -> DataFrame:
    """Without the cases the publisher marks as probable duplicates of another one."""
    return df.where(~F.col("is_probable_duplicate"))


def with_dimensions(
    fact: DataFrame, dates: DataFrame, drugs: DataFrame, outcomes: DataFrame, terms: DataFrame
) -> DataFrame:
    """All rows of the fact with the attributes of its four dimensions. Undated facts, and those outside the
    calendar, have no calendar attributes."""
    return star_join(
        fact,
        [
            Dimension(dates, "receive_date_key", "date_key"),
            Dimension(drugs, "drug_key", "drug_key"),
            Dimension(outcomes, "outcome_key", "outcome_key"),
            Dimension(terms, "reaction_key", "reaction_key"),
        ],
    )
