"""The whole build: four raw logs to the star, and the checks on every layer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caselog.functions import has_no_items
from caselog.functions.text import DRUG_NAME_SOURCES, NO_CODE
from caselog.operators import checks
from caselog.plans.intermediate import REPORT_FIELDS, reactions_of, with_suspect
from caselog.plans.staging import (
    stage_applications,
    stage_descriptors,
    stage_reports,
    stage_studies,
)
from caselog.plans.star import dim_date, dim_drug, dim_outcome, dim_reaction, fact_reactions
from caselog.sources.sinks import materialise, write_parquet
from caselog.sources.storage import DENSE, new_folder, save


@dataclass(frozen=True)
class Raw:
    studies: DataFrame
    reports: DataFrame
    applications: DataFrame
    descriptors: DataFrame


@dataclass(frozen=True)
class Warehouse:
    """`staged` are the reports with all their columns, `reports` what the star needs of them. `observed` has by
    field the frame that was written, and the counts taken while it was."""

    studies: DataFrame
    staged: DataFrame
    reports: DataFrame
    applications: DataFrame
    descriptors: DataFrame
    suspects: DataFrame
    reactions: DataFrame
    dates: DataFrame
    drugs: DataFrame
    outcomes: DataFrame
    terms: DataFrame
    fact: DataFrame
    observed: dict[str, tuple[DataFrame, dict[str, int]]] = field(default_factory=dict)

    def counts(self, *fields: str) -> dict[str, int] | None:
        """What was counted while these tables were written, unless one of them is another frame by now."""
        found: dict[str, int] = {}
        for name in fields:
            frame, counts = self.observed.get(name, (None, {}))
            if frame is not getattr(self, name):
                return None
            found |= counts
        return found


# The outcome codes a reaction may have, beside the default one.
OUTCOMES = ["1", "2", "3", "4", "5", "6"]

# What the models and checks on top of staging read of a report.
KEPT = [
    *REPORT_FIELDS,
    "safety_report_version",
    "receipt_date",
    "transmission_date",
    "n_suspect_drugs",
    "drug_name",
    "drug_name_source",
]


# Columns that must not be NULL, of the tables that `build` writes, by their names in the checks.
REPORT_COLUMNS = ["safety_report_id", "safety_report_version", "receipt_date", "receive_date", "transmission_date"]
FACT_COLUMNS = ["reaction_event_key", "receive_date_key", "drug_key", "outcome_key", "reaction_key"]
DIMENSION_KEYS = {"dates": ("dim_date", "date_key"), "drugs": ("dim_drug", "drug_key"), "outcomes": ("dim_outcome", "outcome_key"), "terms": ("dim_reaction", "reaction_key")}


def _observed(df: DataFrame, counts: dict[str, Column], write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """What was written, and the counts taken in the tasks that wrote it."""
    seen = Observation()
    written = write(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
    return written, seen.get


def build(raw: Raw, seed: DataFrame, root: str | None = None) -> Warehouse:
    """Build everything. Reports are collapsed once, and saved with all their columns; the narrow
    reports with the attributed drug are saved from there, and the intermediate tables, the dimensions,
    the fact and their checks read those. The tables of the star are written once, under the root
    folder, which `publish` only names; without a root, to the shared folder. The raw reports are read several times.

    What a check can count row by row is counted in the tasks that write a table, so no check scans it for that.
    """
    root = root or new_folder(seed.sparkSession, "star")
    staged = save(stage_reports(raw.reports, packed=True, apart=True), "stg_reports", compression=DENSE)
    observed = {}
    observed["reports"] = _observed(
        with_suspect(staged).select(*KEPT),
        checks.null_counts("stg_reports", REPORT_COLUMNS)
        | checks.null_counts("int_suspects", ["safety_report_id", "drug_name_source"])
        | {
            "accepted int_suspects.drug_name_source": checks.unaccepted("drug_name_source", DRUG_NAME_SOURCES),
            "children reports have reactions": F.count_if(has_no_items(F.col("reactions"))),
        },
        lambda df: save(df, "reports", compression=DENSE),
    )
    reports = observed["reports"][0]
    suspects = reports.select("safety_report_id", "n_suspect_drugs", "drug_name", "drug_name_source")
    react = reactions_of(reports)
    dimensions = {"dates": dim_date(seed.sparkSession), "drugs": dim_drug(suspects), "outcomes": dim_outcome(seed), "terms": dim_reaction(react)}
    for name, frame in dimensions.items():
        label, key = DIMENSION_KEYS[name]
        counts = checks.null_counts(label, [key])
        if name == "drugs":
            counts["accepted dim_drug.drug_name_source"] = checks.unaccepted("drug_name_source", DRUG_NAME_SOURCES)
        observed[name] = _observed(frame, counts, lambda df, label=label: write_parquet(df, f"{root}/{label}"))
    # the reactions are seen on their way into the fact
    codes = Observation()
    seen = checks.null_counts("int_reactions", ["outcome_code"]) | {
        "accepted int_reactions.outcome_code": checks.unaccepted("outcome_code", [*OUTCOMES, NO_CODE])
    }
    rows = fact_reactions(react.observe(codes, *[c.alias(name) for name, c in seen.items()]))
    observed["fact"] = _observed(rows, checks.null_counts("fact_reactions", FACT_COLUMNS), lambda df: write_parquet(df, f"{root}/fact_reactions", DENSE))
    observed |= {"suspects": (suspects, {}), "reactions": (react, codes.get)}
    return Warehouse(
        studies=stage_studies(raw.studies),
        staged=staged,
        reports=reports,
        applications=stage_applications(raw.applications),
        descriptors=stage_descriptors(raw.descriptors),
        suspects=suspects,
        reactions=react,
        fact=observed["fact"][0],
        **{name: observed[name][0] for name in dimensions},
        observed=observed,
    )


# Name of each relation, and the field that holds it.
PUBLISHED = [
    ("stg_studies", "studies"),
    ("stg_reports", "staged"),
    ("stg_applications", "applications"),
    ("stg_descriptors", "descriptors"),
    ("int_suspect_drugs", "suspects"),
    ("int_reactions", "reactions"),
    ("dim_date", "dates"),
    ("dim_drug", "drugs"),
    ("dim_outcome", "outcomes"),
    ("dim_reaction", "terms"),
    ("fact_reactions", "fact"),
]


def publish(w: Warehouse) -> list[str]:
    """Give the relations their names: views on the layers below the star, which recompute from the saved
    reports, and on the star's tables, which `build` wrote."""
    for name, field in PUBLISHED:
        materialise(getattr(w, field), name)
    return [name for name, _ in PUBLISHED]


def all_checks(raw: Raw, w: Warehouse, seed: DataFrame) -> DataFrame:
    """The 54 checks as (check_name, n_violations) rows.

    NULLs, unaccepted values and childless reports were counted while the tables were written. The fact is
    scanned once, for the keys of all its checks, and the reactions aren't fanned out again: they are as
    unique as the fact's key, which is made of theirs. A table that isn't the one `build` wrote, or that had
    unaccepted values, is scanned.
    """
    study_key = F.col("protocolSection.identificationModule.nctId")
    raw_studies = raw.studies.select(study_key.alias("nctId"), "_loaded_at")
    known: dict[str, int] = {}
    frames: list[DataFrame] = []

    def columns(table: str, df: DataFrame, key: str | None, cols: list[str], *fields: str) -> None:
        """not_null of the columns and unique of the key, in one pass, or only the key if the rest is known."""
        counts = w.counts(*fields) if fields else None
        if counts is not None:
            known.update({name: counts[name] for name in checks.null_counts(table, cols)})
            cols = []
        if key or cols:
            frames.append(checks.column_checks(df, key, cols, table))

    def accepted(name: str, df: DataFrame, col: str, values: list[str], *fields: str) -> None:
        counts = w.counts(*fields)
        if counts is not None and counts[name] == 0:
            known[name] = 0
        else:
            frames.append(checks.summarise({name: checks.accepted_values(df, col, values)}))

    columns("raw_studies", raw_studies, None, ["nctId", "_loaded_at"])
    columns("raw_reports", raw.reports, None, ["safetyreportid", "_loaded_at"])
    columns("raw_applications", raw.applications, None, ["application_number", "_loaded_at", "_batch_id"])
    columns("raw_descriptors", raw.descriptors, None, ["descriptor_ui", "_loaded_at"])
    columns("stg_studies", w.studies, "nct_id", ["nct_id"])
    columns("stg_applications", w.applications, "application_number", ["application_number", "application_type"])
    columns("stg_reports", w.reports, "safety_report_id", REPORT_COLUMNS, "reports")
    columns("stg_descriptors", w.descriptors, "descriptor_ui", ["descriptor_ui", "descriptor_name"])
    columns("int_suspects", w.suspects, "safety_report_id", ["safety_report_id", "drug_name_source"], "suspects", "reports")
    columns("int_reactions", w.reactions, None, ["outcome_code"], "reactions")
    for name, (label, key) in DIMENSION_KEYS.items():
        columns(label, getattr(w, name), key, [key], name)
    columns("fact_reactions", w.fact, None, FACT_COLUMNS, "fact")
    columns("seed_outcomes", seed, "outcome_code", ["outcome_code", "outcome_label"])

    accepted("accepted int_suspects.drug_name_source", w.suspects, "drug_name_source", DRUG_NAME_SOURCES, "suspects", "reports")
    accepted("accepted int_reactions.outcome_code", w.reactions, "outcome_code", [*OUTCOMES, NO_CODE], "reactions")
    accepted("accepted dim_drug.drug_name_source", w.drugs, "drug_name_source", DRUG_NAME_SOURCES, "drugs")

    childless = "children reports have reactions"
    if (counts := w.counts("reports")) is not None:
        known[childless] = counts[childless]
    else:
        frames.append(checks.summarise({childless: checks.has_children(w.reports, "safety_report_id", "reactions")}))

    keys = checks.key_checks(
        w.fact,
        {
            "relationship receive_date_key": ("receive_date_key", w.dates, "date_key"),
            "relationship drug_key": ("drug_key", w.drugs, "drug_key"),
            "relationship outcome_key": ("outcome_key", w.outcomes, "outcome_key"),
            "relationship reaction_key": ("reaction_key", w.terms, "reaction_key"),
        },
        "reaction_event_key",
        {"complete reports reach the fact": ("safety_report_id", w.reports)},
    )
    names = ["unique fact_reactions.reaction_event_key"]
    if w.counts("fact", "reactions") is not None:
        names.append("grain int_reactions")
    else:
        frames.append(checks.summarise({"grain int_reactions": checks.grain(w.reactions, ["safety_report_id", "reaction_seq"])}))
    named = F.when(F.col("check_name") == "unique", F.array(*map(F.lit, names))).otherwise(F.array("check_name"))
    frames.append(keys.select(F.explode(named).alias("check_name"), "n_violations"))
    if known:
        frames.append(seed.sparkSession.createDataFrame(list(known.items()), "check_name string, n_violations bigint"))
    return checks.union_all(frames)
