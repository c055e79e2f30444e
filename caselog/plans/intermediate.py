"""Attribution of a report to a drug, and the fan-out to reactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselog.functions import (
    clean_text,
    default_code,
    first_item,
    flag,
    matching,
    n_items,
    name_source,
    shortest_variant,
)
from caselog.functions.text import NO_SUSPECT, NO_TERM
from caselog.operators.fanout import fan_out
from caselog.operators.joins import attach

REACTION_COLUMNS = [
    "safety_report_id",
    "reaction_seq",
    "receive_date",
    "reaction_term",
    "outcome_code",
    "is_serious",
    "is_report_death",
    "is_probable_duplicate",
    "drug_name",
    "drug_name_source",
    "n_suspect_drugs",
]


def suspects_of(drugs: Column) -> Column:
    """Drugs of a report that are suspected, in the order listed."""
    return matching(drugs, lambda d: d["drugcharacterization"] == "1")


def drug_name_of(suspect: Column) -> Column:
    """Shortest harmonised name, else the verbatim product name, else the default."""
    return F.coalesce(
        clean_text(shortest_variant(suspect["openfda"]["generic_name"])),
        clean_text(suspect["medicinalproduct"], NO_SUSPECT),
    )


def with_suspect(stg: DataFrame) -> DataFrame:
    """Staged reports with the number of suspects, and name and name source of the first one."""
    return (
        stg.withColumn("_suspects", suspects_of(F.col("drugs")))
        .withColumn("n_suspect_drugs", n_items(F.col("_suspects")))
        .withColumn("_suspect", first_item(F.col("_suspects")))
        .withColumn("drug_name", drug_name_of(F.col("_suspect")))
        .withColumn("drug_name_source", name_source(F.col("_suspect")))
        .drop("_suspects", "_suspect")
    )


DRUG_COLUMNS = ["n_suspect_drugs", "drug_name", "drug_name_source"]


def attributed(stg: DataFrame) -> DataFrame:
    """Staged reports with their suspect's columns, which they have already if `with_suspect` came before the
    collapse."""
    return stg if set(DRUG_COLUMNS) <= set(stg.columns) else with_suspect(stg)


def suspect_drugs(stg: DataFrame) -> DataFrame:
    """One row per report: its first-listed suspect drug. n_suspect_drugs tells how many there were."""
    return attributed(stg).select("safety_report_id", *DRUG_COLUMNS)


def _reaction_rows(reports: DataFrame) -> DataFrame:
    return fan_out(reports, "reactions", "reaction_seq", "reaction").select(
        "*",
        clean_text(F.col("reaction.reactionmeddrapt"), NO_TERM).alias("reaction_term"),
        default_code(F.col("reaction.reactionoutcome")).alias("outcome_code"),
        flag(F.col("serious")).alias("is_serious"),
        flag(F.col("seriousness_death")).alias("is_report_death"),
        flag(F.col("duplicate")).alias("is_probable_duplicate"),
    )


REPORT_FIELDS = ["safety_report_id", "receive_date", "serious", "seriousness_death", "duplicate", "reactions"]


def resolve_reports(stg: DataFrame) -> DataFrame:
    """What the star needs of each report: flags, date, reactions, and the attributed drug.

    Narrow and one row per report, so it is the table to save when several results follow from it.
    """
    return attributed(stg).select(*REPORT_FIELDS, *DRUG_COLUMNS)


def reactions_of(resolved: DataFrame) -> DataFrame:
    """Resolved reports fanned out to their reactions."""
    keyed = resolved.where(F.col("safety_report_id").isNotNull())
    return _reaction_rows(keyed).select(*REACTION_COLUMNS)


def reactions(stg: DataFrame, susp: DataFrame | None = None) -> DataFrame:
    """One row per reaction within a report.

    Without susp, the drug columns are computed beside the array: since a report has one row, that
    equals joining staging with its own derivative, without its second scan and shuffle. With susp
    given, the report id is joined on.
    """
    if susp is None:
        return reactions_of(resolve_reports(stg))
    return attach(_reaction_rows(stg.select(*REPORT_FIELDS)), susp, "safety_report_id").select(
        *REACTION_COLUMNS
    )
