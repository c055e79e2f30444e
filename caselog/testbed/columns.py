"""Queries for the column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog import functions as fn
from caselog.plans.intermediate import suspects_of
from caselog.plans.staging import STUDY_PATHS, project, project_reports
from caselog.testbed.adapters import case_headers, case_log, lines_with_parts, study_log, table
from caselog.testbed.registry import query
from caselog.testbed.sql import CASES, STUDIES, iso, key, with_


@query(
    "nested_project",
    with_(
        STUDIES,
        """
select nct_id, case when o_custkey % 4 = 0 then 'ACR' || (o_custkey % 50) end as acronym,
  'Study ' || o_orderkey as brief_title, o_orderpriority as official_title, 'S-' || o_custkey as org_study_id,
  'Org ' || (o_custkey % 100) as organization_name, 'INDUSTRY' as organization_class,
  'Org ' || (o_custkey % 100) as lead_sponsor_name, 'INDUSTRY' as lead_sponsor_class,
  case when o_orderstatus = 'O' then 'OBSERVATIONAL' else 'INTERVENTIONAL' end as study_type,
  (o_custkey % 1000)::bigint as enrollment_count, 'ESTIMATED' as enrollment_type, 'RANDOMIZED' as allocation,
  'PARALLEL' as intervention_model, 'TREATMENT' as primary_purpose,
  case when o_custkey % 2 = 0 then 'NONE' else 'DOUBLE' end as masking,
  o_orderstatus || v as overall_status, null::varchar as last_known_status,
  case when o_orderkey % 40 = 0 then 'funding' end as why_stopped,
  o_custkey % 11 = 0 as has_expanded_access,
  case when o_custkey % 11 = 0 then 'NCT' || o_custkey end as expanded_access_ref_nct_id, source_file
from study_log""",
    ),
)
def nested_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = {"nct_id_aliases", "collaborators", "phases", "conditions", "keywords", "arm_groups", "interventions"}
    paths = {n: p for n, p in STUDY_PATHS.items() if n not in arrays}
    return study_log(spark, sf_dir).select(*project(paths, "protocolSection."), F.col("_source_file").alias("source_file"))


@query(
    "partial_date",
    with_(
        STUDIES,
        """
select nct_id, source_file, start_text,
  coalesce(try_strptime(start_text, '%Y-%m-%d'), try_strptime(start_text, '%Y-%m'))::date::varchar as start_date,
  coalesce(try_strptime(completion_text, '%Y-%m-%d'), try_strptime(completion_text, '%Y-%m'))::date::varchar as completion_date
from study_log""",
    ),
)
def partial_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = "protocolSection.statusModule"
    return study_log(spark, sf_dir).select(
        F.col("protocolSection.identificationModule.nctId").alias("nct_id"),
        F.col("_source_file").alias("source_file"),
        F.col(f"{status}.startDateStruct.date").alias("start_text"),
        fn.partial_date(F.col(f"{status}.startDateStruct.date")).alias("start_date"),
        fn.partial_date(F.col(f"{status}.completionDateStruct.date")).alias("completion_date"),
    )


@query(
    "date_precision",
    with_(
        STUDIES,
        """
select coalesce(length(start_text), 0)::bigint as text_length,
  case when start_text is null then null when length(start_text) = 7 then 'month' else 'day' end as start_date_precision,
  case when primary_text is null then null when length(primary_text) = 7 then 'month' else 'day' end
    as primary_completion_date_precision,
  case when completion_text is null then null when length(completion_text) = 7 then 'month' else 'day' end
    as completion_date_precision,
  count(*) as n
from study_log group by all""",
    ),
)
def date_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("protocolSection.statusModule.startDateStruct.date")
    precisions = ["start_date_precision", "primary_completion_date_precision", "completion_date_precision"]
    staged = study_log(spark, sf_dir).select(
        F.coalesce(F.length(text), F.lit(0)).alias("text_length"),
        *[
            fn.date_precision(F.col(f"protocolSection.statusModule.{p}.date")).alias(n)
            for n, p in zip(
                precisions, ["startDateStruct", "primaryCompletionDateStruct", "completionDateStruct"], strict=True
            )
        ],
    )
    return staged.groupBy("text_length", *precisions).agg(F.count("*").alias("n"))


@query(
    "compact_date",
    """
with texts as (
  select o_orderkey, case when o_orderkey % 50 = 0 then strftime(o_orderdate, '%Y-%m-%d')
    when o_orderkey % 70 = 0 then strftime(o_orderdate, '%Y') || '0230' else strftime(o_orderdate, '%Y%m%d') end as t
  from orders)
select o_orderkey, t as date_text,
  case when length(t) = 8 then try_strptime(t, '%Y%m%d')::date::varchar end as parsed from texts""",
)
def compact_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        "case when o_orderkey % 50 = 0 then date_format(o_orderdate, 'yyyy-MM-dd')"
        " when o_orderkey % 70 = 0 then concat(year(o_orderdate), '0230')"
        " else date_format(o_orderdate, 'yyyyMMdd') end"
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("date_text"), fn.compact_date(text).alias("parsed")
    )


@query(
    "version_cast",
    with_(
        CASES,
        """select id as safety_report_id, max(version::varchar) as greatest_text,
max(version)::bigint as greatest_number from case_log group by 1""",
    ),
)
def version_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = fn.version_int(F.col("safetyreportversion"))
    return (
        case_headers(spark, sf_dir)
        .groupBy(F.col("safetyreportid").alias("safety_report_id"))
        .agg(F.max("safetyreportversion").alias("greatest_text"), F.max(version).alias("greatest_number"))
    )


@query(
    "pulled_at_cast",
    f"""
select event_id, {iso("date_trunc('second', ts) - interval 2 hour")} as pulled_at from events""",
)
def pulled_at_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return table(spark, sf_dir, "events").select("event_id", fn.pulled_at(text).alias("pulled_at"))


@query(
    "key_prefix",
    """
with numbers as (
  select s_suppkey, case when s_suppkey % 17 = 0 then '' when s_suppkey % 3 = 0 then 'NDA'
    when s_suppkey % 3 = 1 then 'ANDA' else 'BLA' end || lpad(s_suppkey::varchar, 9, '0') as n from supplier)
select n as application_number, regexp_extract(n, '^([A-Z]+)', 1) as application_type,
  count(l_orderkey) as n_lines
from numbers left join lineitem on l_suppkey = s_suppkey group by all""",
)
def key_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.expr(
        "concat(case when s_suppkey % 17 = 0 then '' when s_suppkey % 3 = 0 then 'NDA'"
        " when s_suppkey % 3 = 1 then 'ANDA' else 'BLA' end, lpad(cast(s_suppkey as string), 9, '0'))"
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n_lines"))
    suppliers = table(spark, sf_dir, "supplier").withColumn("application_number", number)
    return suppliers.join(lines, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        "application_number",
        fn.key_prefix(F.col("application_number")).alias("application_type"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
    )


TERM_SQL = "case when {k} % 13 = 0 then '   ' when {k} % 17 = 0 then null when {k} % 19 = 0 then chr(9) else '  ' || {t} || ' ' end"


@query(
    "normalise_term",
    f"""
with terms as (select {TERM_SQL.format(k="l_suppkey", t="p_name")} as raw_term
  from lineitem join part on l_partkey = p_partkey)
select raw_term, coalesce(nullif(upper(trim(raw_term)), ''), 'NOT STATED') as reaction_term, count(*) as n
from terms group by all""",
)
def normalise_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        "case when l_suppkey % 13 = 0 then '   ' when l_suppkey % 17 = 0 then null"
        " when l_suppkey % 19 = 0 then chr(9) else concat('  ', p_name, ' ') end"
    )
    return (
        lines_with_parts(spark, sf_dir)
        .groupBy(text.alias("raw_term"))
        .agg(F.count("*").alias("n"))
        .select("raw_term", fn.clean_text(F.col("raw_term"), "NOT STATED").alias("reaction_term"), "n")
    )


@query(
    "default_code",
    """
select coalesce(case when l_quantity::int % 8 between 1 and 6 then (l_quantity::int % 8)::varchar end, '-1') as outcome_code,
  count(*) as n from lineitem group by 1""",
)
def default_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.expr("if(cast(l_quantity as int) % 8 between 1 and 6, cast(cast(l_quantity as int) % 8 as string), null)")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(fn.default_code(code).alias("outcome_code"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "flag_decode",
    with_(
        CASES,
        """
select serious, death as seriousness_death, duplicate, coalesce(serious = '1', false) as is_serious,
  coalesce(death = '1', false) as is_report_death, coalesce(duplicate = '1', false) as is_probable_duplicate,
  count(*) as n from case_log group by all""",
    ),
)
def flag_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = project_reports(case_headers_with_empty_arrays(spark, sf_dir))
    return (
        staged.groupBy("serious", "seriousness_death", "duplicate")
        .agg(F.count("*").alias("n"))
        .select(
            "*",
            fn.flag(F.col("serious")).alias("is_serious"),
            fn.flag(F.col("seriousness_death")).alias("is_report_death"),
            fn.flag(F.col("duplicate")).alias("is_probable_duplicate"),
        )
    )


def case_headers_with_empty_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case headers under the full raw schema, for projections that name the arrays too."""
    headers = case_headers(spark, sf_dir)
    return headers.withColumn(
        "patient",
        F.col("patient").withField("drug", F.array()).withField("reaction", F.array()),
    )


@query(
    "surrogate_key",
    f"""
select l_orderkey, l_linenumber, {key("p_name")} as drug_key,
  {key("l_orderkey", "l_linenumber", "l_shipdate::date")} as event_key,
  {key("nullif(l_returnflag, 'N')", "l_linestatus")} as flag_key
from lineitem join part on l_partkey = p_partkey""",
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return lines.join(parts, "l_partkey").select(
        "l_orderkey",
        "l_linenumber",
        fn.surrogate_key("p_name").alias("drug_key"),
        fn.surrogate_key("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date")).alias("event_key"),
        fn.surrogate_key(F.nullif(F.col("l_returnflag"), F.lit("N")), F.col("l_linestatus")).alias("flag_key"),
    )


@query(
    "date_key",
    """select strftime(l_shipdate, '%Y%m%d')::bigint as ship_date_key, count(*) as n from lineitem group by 1""",
)
def date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(fn.date_key(F.col("l_shipdate").cast("date")).alias("ship_date_key"))
        .agg(F.count("*").alias("n"))
    )


CALENDAR_SQL = """strftime({d}, '%Y%m%d')::bigint as date_key, {d}::date::varchar as date_day,
  year({d})::bigint as year_number, quarter({d})::bigint as quarter_of_year, month({d})::bigint as month_of_year,
  monthname({d}) as month_name, year({d}) || '-Q' || quarter({d}) as year_quarter,
  (dayofweek({d}) + 1)::bigint as day_of_week, dayname({d}) as day_name, dayofweek({d}) in (0, 6) as is_weekend"""


@query(
    "calendar_parts",
    f"""with days as (select l_shipdate::date as d, count(*) as n from lineitem group by 1)
select {CALENDAR_SQL.format(d="d")}, n from days""",
)
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    return days.select(*fn.calendar_columns(F.col("day")), "n")


@query(
    "name_source",
    with_(
        CASES,
        """
select case when d.d is null then 'none' when d.d.generic is not null then 'openfda_generic' else 'medicinalproduct' end
    as drug_name_source, count(*) as n
from (select list_filter(drugs, lambda x: x.code = '1')[1] as d from case_log) d group by 1""",
    ),
)
def name_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    suspect = fn.first_item(suspects_of(F.col("patient.drug")))
    return (
        case_log(spark, sf_dir)
        .groupBy(fn.name_source(suspect).alias("drug_name_source"))
        .agg(F.count("*").alias("n"))
    )


# Arrays of a case whose drug list is missing altogether in some cases.
def _drug_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return case_log(spark, sf_dir).select(
        "safetyreportid",
        "safetyreportversion",
        F.when(F.col("companynumb") == "US-7", None).otherwise(F.col("patient.drug")).alias("drugs"),
    )


DRUG_LISTS = CASES + """,
drug_lists as (
  select id as safetyreportid, version::varchar as safetyreportversion,
    case when o_custkey <> 7 then drugs end as drugs from case_log
)"""


@query(
    "array_filter",
    with_(
        DRUG_LISTS,
        """select safetyreportid, safetyreportversion,
array_to_string(list_transform(list_filter(drugs, lambda d: d.code = '1'), lambda d: coalesce(d.product, '?')), '|') as suspects
from drug_lists""",
    ),
)
def array_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    suspects = fn.matching(F.col("drugs"), lambda d: d["drugcharacterization"] == "1")
    names = F.transform(suspects, lambda d: F.coalesce(d["medicinalproduct"], F.lit("?")))
    return _drug_lists(spark, sf_dir).select(
        "safetyreportid", "safetyreportversion", F.array_join(names, "|").alias("suspects")
    )


@query(
    "array_size",
    with_(DRUG_LISTS, "select len(drugs)::bigint as n_drugs, count(*) as n from drug_lists group by 1"),
)
def array_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _drug_lists(spark, sf_dir)
        .groupBy(fn.n_items(F.col("drugs")).cast("bigint").alias("n_drugs"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "first_match",
    with_(
        DRUG_LISTS,
        """select safetyreportid, safetyreportversion, list_filter(drugs, lambda d: d.code = '1')[1].product as product,
  len(list_filter(drugs, lambda d: d.code = '1')) > 0 as has_suspect from drug_lists""",
    ),
)
def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    suspects = suspects_of(F.col("drugs"))
    return _drug_lists(spark, sf_dir).select(
        "safetyreportid",
        "safetyreportversion",
        fn.first_item(suspects)["medicinalproduct"].alias("product"),
        (fn.n_items(suspects) > 0).alias("has_suspect"),
    )


@query(
    "shortest_variant",
    """
with variants as (
  select p_partkey, list_filter([p_name || ' ' || p_type, case when p_partkey % 4 <> 0 then p_name end, p_brand, p_type,
    case when p_partkey % 9 = 0 then '' end], lambda x: x is not null) as v from part)
select p_partkey, list_sort(list_transform(v, lambda x: {'l': length(x), 'v': x}))[1].v as shortest from variants""",
)
def shortest_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = F.expr(
        "array(concat(p_name, ' ', p_type), if(p_partkey % 4 <> 0, p_name, null), p_brand, p_type,"
        " if(p_partkey % 9 = 0, '', null))"
    )
    return table(spark, sf_dir, "part").select("p_partkey", fn.shortest_variant(variants).alias("shortest"))

