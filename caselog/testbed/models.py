"""Queries for the models and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.operators.fanout import days_between
from caselog.plans import profiles
from caselog.plans.intermediate import reactions, reactions_of, suspect_drugs, with_suspect
from caselog.plans.staging import (
    REPORT_PATHS,
    stage_applications,
    stage_descriptors,
    stage_reports,
    stage_studies,
)
from caselog.plans.star import calendar_of, dim_drug, dim_outcome, dim_reaction, fact_reactions
from caselog.plans.warehouse import KEPT
from caselog.sources.storage import save
from caselog.testbed.adapters import application_log, case_log, study_log, table, vocabulary_log
from caselog.testbed.columns import CALENDAR_SQL
from caselog.testbed.operators import attributed_cases, outcome_seed, reactions_of_cases
from caselog.testbed.registry import query
from caselog.testbed.sql import (
    APPLICATIONS,
    DIMENSIONS,
    OUTCOMES,
    REACTIONS,
    STG_REPORTS,
    STUDIES,
    SUSPECTS,
    VOCABULARY,
    iso,
    with_,
)


def _landing(df: DataFrame) -> list:
    return [F.col(c).alias(c[1:]) for c in ("_pulled_at", "_source_file", "_batch_id")]


def landed_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application log at rest, partitioned by batch, so that staging reads the newest only."""
    return save(application_log(spark, sf_dir), "applications", by=("_batch_id",))


def _date_sql(text: str) -> str:
    return f"coalesce(try_strptime({text}, '%Y-%m-%d'), try_strptime({text}, '%Y-%m'))::date::varchar"


def _precision_sql(text: str) -> str:
    return f"case when {text} is null then null when length({text}) = 7 then 'month' else 'day' end"


@query(
    "stg_studies",
    with_(
        STUDIES,
        f"""
select nct_id, o_orderstatus || v as overall_status, o_orderpriority as official_title,
  case when o_orderstatus = 'O' then 'OBSERVATIONAL' else 'INTERVENTIONAL' end as study_type,
  case substr(o_orderpriority, 1, 1) when '1' then 'PHASE1' when '2' then 'PHASE2' when '3' then 'PHASE3'
    when '4' then 'PHASE2|PHASE3' end as phases,
  case when o_custkey % 3 = 0 then 'Lung Cancer' else 'Asthma' end || '|Cond ' || (o_custkey % 20) as conditions,
  (o_custkey % 1000)::bigint as enrollment_count, o_custkey % 11 = 0 as has_expanded_access,
  {_date_sql("start_text")} as start_date, 'ACTUAL' as start_date_type, {_precision_sql("start_text")} as start_date_precision,
  {_date_sql("primary_text")} as primary_completion_date, {_precision_sql("primary_text")} as primary_completion_date_precision,
  {_date_sql("completion_text")} as completion_date, {_precision_sql("completion_text")} as completion_date_precision,
  o_orderdate::date::varchar as study_first_post_date, (o_orderdate::date + 20 * v::int)::varchar as last_update_post_date,
  case when o_custkey % 2 <> 0 then (o_orderdate::date + 20 * v::int)::varchar end as results_first_post_date,
  case when o_custkey % 4 = 0 then 'ACR' || (o_custkey % 50) end as acronym, 'Study ' || o_orderkey as brief_title,
  'S-' || o_custkey as org_study_id, 'Org ' || (o_custkey % 100) as organization_name, 'INDUSTRY' as organization_class,
  case when o_orderkey % 30 = 0 then 'OLD' || o_orderkey end as nct_id_aliases,
  'Org ' || (o_custkey % 100) as lead_sponsor_name, 'INDUSTRY' as lead_sponsor_class,
  'Col ' || (o_custkey % 9) || '/OTHER' as collaborators, 'ESTIMATED' as enrollment_type, 'RANDOMIZED' as allocation,
  'PARALLEL' as intervention_model, 'TREATMENT' as primary_purpose,
  case when o_custkey % 2 = 0 then 'NONE' else 'DOUBLE' end as masking,
  case when o_custkey % 2 = 0 then 'kw' end as keywords, 'A/EXPERIMENTAL' as arm_groups,
  'DRUG/Drug ' || (o_custkey % 60) as interventions, null::varchar as last_known_status,
  case when o_orderkey % 40 = 0 then 'funding' end as why_stopped,
  case when o_custkey % 11 = 0 then 'NCT' || o_custkey end as expanded_access_ref_nct_id,
  'ESTIMATED' as primary_completion_date_type, 'ESTIMATED' as completion_date_type,
  strftime(pulled_at + interval 1 hour, '%Y-%m-%d %H:%M:%S.%f') as loaded_at,
  {iso("pulled_at")} as pulled_at, source_file, batch_id
from studies""",
    ),
)
def stg_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns; lists as text, their structs' fields joined by a slash."""
    staged = stage_studies(study_log(spark, sf_dir), content_tiebreak=True)

    def items(column: str, *fields: str):
        parts = F.transform(column, lambda x: F.concat_ws("/", *[x[f] for f in fields]))
        return F.array_join(parts, "|").alias(column)

    return staged.select(
        "nct_id",
        "overall_status",
        "official_title",
        "study_type",
        F.array_join("phases", "|").alias("phases"),
        F.array_join("conditions", "|").alias("conditions"),
        "enrollment_count",
        "has_expanded_access",
        "start_date",
        "start_date_type",
        "start_date_precision",
        "primary_completion_date",
        "primary_completion_date_precision",
        "completion_date",
        "completion_date_precision",
        "study_first_post_date",
        "last_update_post_date",
        "results_first_post_date",
        "acronym",
        "brief_title",
        "org_study_id",
        "organization_name",
        "organization_class",
        F.array_join("nct_id_aliases", "|").alias("nct_id_aliases"),
        "lead_sponsor_name",
        "lead_sponsor_class",
        items("collaborators", "name", "class"),
        "enrollment_type",
        "allocation",
        "intervention_model",
        "primary_purpose",
        "masking",
        F.array_join("keywords", "|").alias("keywords"),
        items("arm_groups", "label", "type"),
        items("interventions", "type", "name"),
        "last_known_status",
        "why_stopped",
        "expanded_access_ref_nct_id",
        "primary_completion_date_type",
        "completion_date_type",
        F.col("_loaded_at").alias("loaded_at"),
        *_landing(staged),
    )


@query(
    "stg_reports",
    with_(
        STG_REPORTS,
        f"""
select id as safety_report_id, version::bigint as safety_report_version, 'US-' || o_custkey as company_number,
  null::varchar as authority_number, duplicate, case when o_custkey % 5 = 0 then 'of-' || o_custkey end as report_duplicate,
  (o_custkey % 4 + 1)::varchar as report_type, serious, death as seriousness_death,
  case when o_custkey % 3 = 0 then '1' end as seriousness_hospitalization, null::varchar as seriousness_life_threatening,
  case when o_custkey % 7 = 0 then '1' else '2' end as seriousness_disabling, null::varchar as seriousness_congenital_anomaly,
  case when substr(o_orderpriority, 1, 1) = '1' then '1' end as seriousness_other,
  case when o_orderstatus = 'P' then '1' else '2' end as fulfill_expedite_criteria, 'C' || (o_custkey % 25) as occur_country,
  'C' || ((o_custkey + 1) % 25) as primary_source_country, 'C' || (o_custkey % 25) as reporter_country,
  substr(o_orderpriority, 1, 1) as reporter_qualification,
  case when o_orderkey % 50 = 0 then 'ref ' || o_orderkey end as literature_reference,
  'ORG-' || (o_custkey % 7) as sender_organization, '2' as sender_type, 'ORG-0' as receiver_organization, '6' as receiver_type,
  (o_custkey % 3)::varchar as patient_sex, null::varchar as patient_age_group, (o_orderkey % 90)::varchar as patient_onset_age,
  '801' as patient_onset_age_unit, null::varchar as patient_weight,
  case when o_orderkey % 4 = 0 then 'case ' || o_orderkey end as narrative_include_clinical,
  array_to_string(list_transform(drugs, lambda d: concat_ws('~', d.code, d.product, array_to_string(d.generic, ','))), '|') as drugs,
  array_to_string(list_transform(reactions, lambda r: concat_ws('~', r.term, r.outcome)), '|') as reactions,
  day::varchar as receipt_date, day::varchar as receive_date, day::varchar as transmission_date,
  {iso("pulled_at")} as pulled_at, source_file, batch_id
from reports""",
    ),
)
def stg_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_reports(case_log(spark, sf_dir), packed=True)
    drug = lambda d: F.concat_ws(
        "~", d["drugcharacterization"], d["medicinalproduct"], F.array_join(d["openfda"]["generic_name"], ",")
    )
    reaction = lambda r: F.concat_ws("~", r["reactionmeddrapt"], r["reactionoutcome"])
    return staged.select(
        "safety_report_id",
        "safety_report_version",
        *[c for c in REPORT_PATHS if c not in ("drugs", "reactions")],
        F.array_join(F.transform("drugs", drug), "|").alias("drugs"),
        F.array_join(F.transform("reactions", reaction), "|").alias("reactions"),
        "receipt_date",
        "receive_date",
        "transmission_date",
        *_landing(staged),
    )


@query(
    "stg_applications",
    with_(
        APPLICATIONS,
        f"""
select application_number, regexp_extract(application_number, '^([A-Z]+)', 1) as application_type, sponsor_name,
  n_products, part_list, has_openfda, {iso("pulled_at")} as pulled_at, source_file, batch_id from applications""",
    ),
)
def stg_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_applications(landed_applications(spark, sf_dir), content_tiebreak=True)
    numbers = F.transform("products", lambda p: p["product_number"])
    return staged.select(
        "application_number",
        "application_type",
        "sponsor_name",
        F.size("products").cast("bigint").alias("n_products"),
        F.array_join(F.sort_array(numbers), ",").alias("part_list"),
        F.col("openfda").isNotNull().alias("has_openfda"),
        *_landing(staged),
    )


@query(
    "stg_descriptors",
    with_(
        VOCABULARY,
        f"""
select descriptor_ui, descriptor_name, array_to_string(tree_numbers, '|') as tree_numbers,
  {iso("pulled_at")} as pulled_at, source_file, batch_id from vocabulary""",
    ),
)
def stg_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_descriptors(vocabulary_log(spark, sf_dir), content_tiebreak=True)
    return staged.select(
        "descriptor_ui", "descriptor_name", F.array_join("tree_numbers", "|").alias("tree_numbers"), *_landing(staged)
    )


@query(
    "suspect_drugs",
    with_(SUSPECTS, "select id as safety_report_id, n_suspect_drugs, drug_name, drug_name_source from suspect_drugs"),
)
def suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suspect_drugs(attributed_cases(spark, sf_dir))


@query(
    "reactions",
    with_(
        REACTIONS,
        """select id as safety_report_id, seq as reaction_seq, day::varchar as receive_date, term as reaction_term,
  outcome as outcome_code, is_serious, is_report_death, is_probable_duplicate, drug_name, drug_name_source, n_suspect_drugs
from reactions""",
    ),
)
def reaction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reactions(attributed_cases(spark, sf_dir))


@query(
    "dim_date",
    f"""
with b as (select date_trunc('year', min(o_orderdate))::date as d1,
  (date_trunc('year', max(o_orderdate)) + interval 1 year - interval 1 day)::date as d2 from orders),
days as (select unnest(generate_series(d1, d2, interval 1 day))::date as d from b)
select {CALENDAR_SQL.format(d="d")} from days""",
)
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the whole years that the orders span."""
    day = F.col("o_orderdate").cast("date")
    ends = table(spark, sf_dir, "orders").agg(
        F.make_date(F.year(F.min(day)), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.year(F.max(day)), F.lit(12), F.lit(31)).alias("last"),
    )
    return calendar_of(days_between(ends, "first", "last"))


@query(
    "dim_outcome",
    with_(
        REACTIONS + "," + OUTCOMES,
        """select md5(outcome_code) as outcome_key, outcome_code, outcome_label, count(id) as n_reactions
from outcomes left join reactions on outcome = outcome_code group by all""",
    ),
)
def outcome_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome dimension, with how many reactions have each outcome."""
    used = reactions_of_cases(spark, sf_dir).groupBy("outcome_code").agg(F.count("*").alias("n_reactions"))
    return (
        dim_outcome(outcome_seed(spark))
        .join(used, "outcome_code", "left")
        .select("outcome_key", "outcome_code", "outcome_label", F.coalesce("n_reactions", F.lit(0)).alias("n_reactions"))
    )


@query("dim_drug", with_(DIMENSIONS, "select * from dim_drug"))
def drug_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_drug(suspect_drugs(attributed_cases(spark, sf_dir)))


@query("dim_reaction", with_(DIMENSIONS, "select * from dim_reaction"))
def reaction_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_reaction(reactions_of_cases(spark, sf_dir))


@query("fact_reactions", with_(DIMENSIONS, "select * replace (receive_date::varchar as receive_date) from fact"))
def reaction_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_reactions(reactions_of_cases(spark, sf_dir))


# Profiles


def _long(metrics: list[tuple[str, str, str | None]]) -> str:
    """SQL for (metric, value expression, denominator) rows."""
    return "\nunion all ".join(
        f"select '{m}' as metric, ({v})::bigint as value, {repr(d) if d else 'null'}::varchar as denominator"
        for m, v, d in metrics
    )


@query(
    "headline_outcomes",
    with_(
        REACTIONS,
        """select count(distinct id) as cases, count(*) as reactions,
  count(distinct case when outcome = '5' then id end) as fatal_cases from reactions where not is_probable_duplicate""",
    ),
)
def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.headline_outcomes(reactions_of_cases(spark, sf_dir))


@query(
    "profile_cases",
    with_(
        DIMENSIONS,
        _long(
            [
                ("raw_rows", "select count(*) from case_log", None),
                ("raw_distinct_cases", "select count(distinct id) from case_log", "raw_rows"),
                ("receipt_date_format_variants", "select count(distinct format) from case_log", None),
                ("staged_cases", "select count(*) from reports", None),
                ("cases_flagged_duplicate", "select count(duplicate) from reports", "staged_cases"),
                ("cases_no_reactions", "select count(*) from reports where len(reactions) = 0", "staged_cases"),
                ("max_report_version", "select max(version) from reports", None),
                ("drug_name_from_openfda", "select count(*) from suspect_drugs where drug_name_source = 'openfda_generic'", "staged_cases"),
                ("drug_name_from_verbatim", "select count(*) from suspect_drugs where drug_name_source = 'medicinalproduct'", "staged_cases"),
                ("drug_name_absent", "select count(*) from suspect_drugs where drug_name_source = 'none'", "staged_cases"),
                ("cases_multi_suspect", "select count(*) from suspect_drugs where n_suspect_drugs >= 2", "staged_cases"),
                ("reaction_events", "select count(*) from reactions", None),
                ("reactions_no_outcome_code", "select count(*) from reactions where outcome = '-1'", "reaction_events"),
                ("reaction_events_ex_duplicates", "select count(*) from reactions where not is_probable_duplicate", "reaction_events"),
                ("cases_ex_duplicates", "select count(distinct id) from reactions where not is_probable_duplicate", "staged_cases"),
                (
                    "fatal_cases_ex_duplicates",
                    "select count(distinct id) from reactions where not is_probable_duplicate and outcome = '5'",
                    "cases_ex_duplicates",
                ),
                ("distinct_drug_names", "select count(*) from dim_drug", None),
                ("distinct_reaction_terms", "select count(*) from dim_reaction", None),
            ]
        ),
    ),
)
def profile_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = case_log(spark, sf_dir)  # each reader makes the columns it reads
    reports = save(stage_reports(raw, derive=with_suspect).select(*KEPT), "reports")
    react = reactions_of(reports)
    return profiles.profile_cases(raw, reports, reports, react, dim_drug(reports), dim_reaction(react))


@query(
    "profile_apps",
    with_(
        APPLICATIONS,
        _long(
            [
                ("raw_rows", "select count(*) from application_log", None),
                ("raw_distinct_applications", "select count(distinct application_number) from application_log", "raw_rows"),
                ("raw_batches", "select count(distinct batch_id) from application_log", None),
                ("staged_applications", "select count(*) from applications", None),
                ("applications_no_openfda", "select count(*) from applications where not has_openfda", "staged_applications"),
                (
                    "applications_no_products",
                    "select count(*) from applications where coalesce(n_products, 0) = 0",
                    "staged_applications",
                ),
                ("products_total", "select sum(n_products) from applications", None),
                ("max_products_per_application", "select max(n_products) from applications", None),
            ]
        ),
    ),
)
def profile_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = landed_applications(spark, sf_dir)
    return profiles.profile_applications(raw, stage_applications(raw))


@query(
    "profile_terms",
    with_(
        VOCABULARY + ", numbers as (select unnest(tree_numbers) as t from vocabulary)",
        _long(
            [
                ("raw_rows", "select count(*) from vocabulary_log", None),
                ("raw_distinct_descriptors", "select count(distinct descriptor_ui) from vocabulary_log", "raw_rows"),
                ("staged_descriptors", "select count(*) from vocabulary", None),
                ("descriptors_multi_tree", "select count(*) from vocabulary where len(tree_numbers) > 1", "staged_descriptors"),
                ("descriptors_no_tree", "select count(*) from vocabulary where len(tree_numbers) = 0", "staged_descriptors"),
                ("max_tree_numbers_per_descriptor", "select max(len(tree_numbers)) from vocabulary", None),
                ("tree_numbers_total", "select count(*) from numbers", None),
                ("tree_numbers_distinct", "select count(distinct t) from numbers", "tree_numbers_total"),
            ]
        ),
    ),
)
def profile_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = save(vocabulary_log(spark, sf_dir), "vocabulary")
    return profiles.profile_vocabulary(raw, stage_descriptors(raw))


def _reconcile_sql(name: str, log: str, key: str, staged: str) -> str:
    return f"""select '{name}' as source_name, count(*) as landed_rows, count(distinct {key}) as distinct_keys,
  (select count(*) from {staged}) as staged_rows, count(*) - (select count(*) from {staged}) as rows_removed,
  (select count(*) from {staged}) - count(distinct {key}) as grain_gap,
  count(distinct source_file) as source_files, count(distinct batch_id) as batches from {log}"""


@query(
    "reconcile_rows",
    with_(
        STG_REPORTS + "," + STUDIES + "," + APPLICATIONS + "," + VOCABULARY,
        "\nunion all ".join(
            [
                _reconcile_sql("ctgov", "study_log", "nct_id", "studies"),
                _reconcile_sql("faers", "case_log", "id", "reports"),
                _reconcile_sql("drugsfda", "application_log", "application_number", "applications"),
                _reconcile_sql("mesh", "vocabulary_log", "descriptor_ui", "vocabulary"),
            ]
        ),
    ),
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    studies, reports = study_log(spark, sf_dir), case_log(spark, sf_dir)  # each reader makes the columns it reads
    applications, descriptors = landed_applications(spark, sf_dir), save(vocabulary_log(spark, sf_dir), "vocabulary")
    return profiles.reconcile_rows(
        {
            "ctgov": (studies, stage_studies(studies), "protocolSection.identificationModule.nctId"),
            "faers": (reports, stage_reports(reports), "safetyreportid"),
            "drugsfda": (applications, stage_applications(applications), "application_number"),
            "mesh": (descriptors, stage_descriptors(descriptors), "descriptor_ui"),
        }
    )


