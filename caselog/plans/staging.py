"""Raw logs to one typed row per entity. Arrays pass through; nothing changes grain here except the
collapse of the log to current state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselog.functions import (
    compact_date,
    date_precision,
    key_prefix,
    partial_date,
    pulled_at,
    version_int,
)
from caselog.operators.current import latest_per_key, newest_batch

# Staged name -> path in the raw record.
REPORT_PATHS = {
    "company_number": "companynumb",
    "authority_number": "authoritynumb",
    "duplicate": "duplicate",
    "report_duplicate": "reportduplicate",
    "report_type": "reporttype",
    "serious": "serious",
    "seriousness_death": "seriousnessdeath",
    "seriousness_hospitalization": "seriousnesshospitalization",
    "seriousness_life_threatening": "seriousnesslifethreatening",
    "seriousness_disabling": "seriousnessdisabling",
    "seriousness_congenital_anomaly": "seriousnesscongenitalanomali",
    "seriousness_other": "seriousnessother",
    "fulfill_expedite_criteria": "fulfillexpeditecriteria",
    "occur_country": "occurcountry",
    "primary_source_country": "primarysourcecountry",
    "reporter_country": "primarysource.reportercountry",
    "reporter_qualification": "primarysource.qualification",
    "literature_reference": "primarysource.literaturereference",
    "sender_organization": "sender.senderorganization",
    "sender_type": "sender.sendertype",
    "receiver_organization": "receiver.receiverorganization",
    "receiver_type": "receiver.receivertype",
    "patient_sex": "patient.patientsex",
    "patient_age_group": "patient.patientagegroup",
    "patient_onset_age": "patient.patientonsetage",
    "patient_onset_age_unit": "patient.patientonsetageunit",
    "patient_weight": "patient.patientweight",
    "narrative_include_clinical": "patient.summary.narrativeincludeclinical",
    "drugs": "patient.drug",
    "reactions": "patient.reaction",
}

STUDY_PATHS = {
    "nct_id": "identificationModule.nctId",
    "acronym": "identificationModule.acronym",
    "brief_title": "identificationModule.briefTitle",
    "official_title": "identificationModule.officialTitle",
    "org_study_id": "identificationModule.orgStudyIdInfo.id",
    "organization_name": "identificationModule.organization.fullName",
    "organization_class": "identificationModule.organization.class",
    "nct_id_aliases": "identificationModule.nctIdAliases",
    "lead_sponsor_name": "sponsorCollaboratorsModule.leadSponsor.name",
    "lead_sponsor_class": "sponsorCollaboratorsModule.leadSponsor.class",
    "collaborators": "sponsorCollaboratorsModule.collaborators",
    "study_type": "designModule.studyType",
    "phases": "designModule.phases",
    "enrollment_count": "designModule.enrollmentInfo.count",
    "enrollment_type": "designModule.enrollmentInfo.type",
    "allocation": "designModule.designInfo.allocation",
    "intervention_model": "designModule.designInfo.interventionModel",
    "primary_purpose": "designModule.designInfo.primaryPurpose",
    "masking": "designModule.designInfo.maskingInfo.masking",
    "conditions": "conditionsModule.conditions",
    "keywords": "conditionsModule.keywords",
    "arm_groups": "armsInterventionsModule.armGroups",
    "interventions": "armsInterventionsModule.interventions",
    "overall_status": "statusModule.overallStatus",
    "last_known_status": "statusModule.lastKnownStatus",
    "why_stopped": "statusModule.whyStopped",
    "has_expanded_access": "statusModule.expandedAccessInfo.hasExpandedAccess",
    "expanded_access_ref_nct_id": "statusModule.expandedAccessInfo.nctId",
}

# Sponsor-given dates, with a type and a precision; then registry-generated ones.
SPONSOR_DATES = {
    "start_date": "statusModule.startDateStruct",
    "primary_completion_date": "statusModule.primaryCompletionDateStruct",
    "completion_date": "statusModule.completionDateStruct",
}
REGISTRY_DATES = {
    "study_first_post_date": "statusModule.studyFirstPostDateStruct",
    "last_update_post_date": "statusModule.lastUpdatePostDateStruct",
    "results_first_post_date": "statusModule.resultsFirstPostDateStruct",
}


def project(paths: dict[str, str], root: str = "") -> list[Column]:
    """Columns for a mapping of names to (nested) paths. Only these leaves are read from Parquet."""
    return [F.col(root + path).alias(name) for name, path in paths.items()]


def load_metadata(raw: DataFrame) -> list[Column]:
    """The load metadata, and the record's digest if it was stored."""
    return [
        pulled_at(F.col("_pulled_at")).alias("_pulled_at"),
        F.col("_loaded_at"),
        F.col("_source_file"),
        F.col("_batch_id"),
        *[F.col(c) for c in ("_digest",) if c in raw.columns],
    ]


def project_reports(raw: DataFrame, strict: bool = True) -> DataFrame:
    return raw.select(
        F.col("safetyreportid").alias("safety_report_id"),
        version_int(F.col("safetyreportversion"), strict).alias("safety_report_version"),
        *project(REPORT_PATHS),
        compact_date(F.col("receiptdate")).alias("receipt_date"),
        compact_date(F.col("receivedate")).alias("receive_date"),
        compact_date(F.col("transmissiondate")).alias("transmission_date"),
        *load_metadata(raw),
    )


def stage_reports(
    raw: DataFrame, strict: bool = True, derive: Callable[[DataFrame], DataFrame] | None = None, packed: bool = False, apart: bool = False
) -> DataFrame:
    """One row per case report: the highest version, then the newest pull, then the last file.

    The version is cast before it is ordered by. Case duplicates under another id stay. derive adds columns
    made of each row alone before the collapse: what they are made of isn't shuffled then, unless it is used
    itself. packed is for results that use all columns, and shuffles those of the record as one text; apart shuffles
    only reports with several rows in the log.
    """
    order = [F.desc("safety_report_version"), F.desc("_pulled_at")]
    rows = project_reports(raw, strict)
    return latest_per_key(derive(rows) if derive else rows, "safety_report_id", order, packed=tuple(REPORT_PATHS) if packed else (), apart=apart)


def project_studies(raw: DataFrame) -> DataFrame:
    root = "protocolSection."
    dates: list[Column] = []
    for name, path in SPONSOR_DATES.items():
        text = F.col(f"{root}{path}.date")
        dates += [
            partial_date(text).alias(name),
            F.col(f"{root}{path}.type").alias(f"{name}_type"),
            date_precision(text).alias(f"{name}_precision"),
        ]
    for name, path in REGISTRY_DATES.items():
        dates.append(partial_date(F.col(f"{root}{path}.date")).alias(name))
    return raw.select(*project(STUDY_PATHS, root), *dates, *load_metadata(raw))


def stage_studies(raw: DataFrame, content_tiebreak: bool = False) -> DataFrame:
    """One row per study, newest pull. The source lands changes only, so older batches count."""
    return latest_per_key(
        project_studies(raw), "nct_id", [F.desc("_pulled_at")], content_tiebreak=content_tiebreak
    )


def stage_applications(raw: DataFrame, content_tiebreak: bool = False) -> DataFrame:
    """One row per application of the newest batch, which mirrors the whole catalogue."""
    renamed = newest_batch(raw).select(
        "application_number",
        key_prefix(F.col("application_number")).alias("application_type"),
        "sponsor_name",
        "products",
        "submissions",
        "openfda",
        *load_metadata(raw),
    )
    return latest_per_key(
        renamed, "application_number", [F.desc("_pulled_at")], content_tiebreak=content_tiebreak
    )


def stage_descriptors(raw: DataFrame, content_tiebreak: bool = False) -> DataFrame:
    """One row per descriptor, newest pull. Tree numbers stay an array."""
    renamed = raw.select("descriptor_ui", "descriptor_name", "tree_numbers", *load_metadata(raw))
    return latest_per_key(
        renamed, "descriptor_ui", [F.desc("_pulled_at")], content_tiebreak=content_tiebreak
    )
