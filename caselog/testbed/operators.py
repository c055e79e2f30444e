"""Queries for the operators: current state, fan-out, joins, aggregates, reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog import functions as fn
from caselog.functions.text import DRUG_NAME_SOURCES
from caselog.operators import aggregates, current, fanout, joins
from caselog.plans.intermediate import reactions, reactions_of, resolve_reports, suspect_drugs, with_suspect
from caselog.plans.profiles import explode_counts
from caselog.plans.staging import project_reports, stage_descriptors, stage_reports
from caselog.plans.star import (
    dim_date,
    dim_drug,
    dim_outcome,
    dim_reaction,
    exclude_duplicates,
    fact_reactions,
    with_dimensions,
)
from caselog.sources.schemas import OUTCOME_CODES, OUTCOME_ROWS
from caselog.sources.storage import save
from caselog.testbed.adapters import (
    application_log,
    case_log,
    study_log,
    table,
    vocabulary_log,
)
from caselog.testbed.columns import DRUG_LISTS, case_headers_with_empty_arrays
from caselog.testbed.registry import query
from caselog.testbed.sql import (
    APPLICATIONS,
    DIMENSIONS,
    REACTIONS,
    STG_REPORTS,
    STUDIES,
    SUSPECTS,
    VOCABULARY,
    iso,
    with_,
)


def attributed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged reports, each attributed to its drug before the collapse, so that no drug list is shuffled."""
    return stage_reports(case_log(spark, sf_dir), derive=with_suspect)


def reactions_of_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reactions(attributed_cases(spark, sf_dir))


def outcome_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(OUTCOME_ROWS, OUTCOME_CODES)


# Current state


@query(
    "latest_per_key",
    f"""
select user_id, event_id, {iso("ts")} as ts, event_type, props from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "props")
    return current.latest_per_key(events, "user_id", [F.desc("ts"), F.desc("event_id")], content_tiebreak=True)


@query(
    "latest_version",
    with_(
        STG_REPORTS,
        f"""
select id as safety_report_id, version::bigint as safety_report_version, day::varchar as receive_date,
  {iso("pulled_at")} as pulled_at, source_file
from reports""",
    ),
)
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = project_reports(case_headers_with_empty_arrays(spark, sf_dir))
    order = [F.desc("safety_report_version"), F.desc("_pulled_at")]
    return current.latest_per_key(staged, "safety_report_id", order).select(
        "safety_report_id",
        "safety_report_version",
        "receive_date",
        F.col("_pulled_at").alias("pulled_at"),
        F.col("_source_file").alias("source_file"),
    )


@query(
    "newest_batch",
    with_(
        APPLICATIONS,
        """select application_number, sponsor_name, batch_id, source_file from application_log
where batch_id = (select max(batch_id) from application_log)""",
    ),
)
def newest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = save(application_log(spark, sf_dir), "applications", by=("_batch_id",))
    return current.newest_batch(log).select(
        "application_number",
        "sponsor_name",
        F.col("_batch_id").alias("batch_id"),
        F.col("_source_file").alias("source_file"),
    )


# Filters


@query(
    "no_children",
    with_(DRUG_LISTS, "select safetyreportid, safetyreportversion from drug_lists where drugs is null or len(drugs) = 0"),
)
def no_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = case_log(spark, sf_dir).select(
        "safetyreportid",
        "safetyreportversion",
        F.when(F.col("companynumb") == "US-7", None).otherwise(F.col("patient.drug")).alias("drugs"),
    )
    return cases.where(fn.has_no_items(F.col("drugs"))).select("safetyreportid", "safetyreportversion")


@query(
    "exclude_duplicates",
    with_(REACTIONS, "select id as safety_report_id, seq as reaction_seq, term as reaction_term from reactions where not is_probable_duplicate"),
)
def duplicates_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    react = exclude_duplicates(reactions_of_cases(spark, sf_dir))
    return react.select("safety_report_id", "reaction_seq", "reaction_term")


# Joins


@query(
    "inner_join",
    with_(
        REACTIONS,
        "select id as safety_report_id, seq as reaction_seq, drug_name, drug_name_source, n_suspect_drugs from reactions",
    ),
)
def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = resolve_reports(attributed_cases(spark, sf_dir))
    resolved = save(staged, "resolved")
    susp = resolved.select("safety_report_id", "n_suspect_drugs", "drug_name", "drug_name_source")
    seqs = fanout.fan_out(resolved.select("safety_report_id", "reactions"), "reactions", "reaction_seq", "reaction")
    return joins.attach(seqs.drop("reaction"), susp, "safety_report_id")


@query(
    "cross_join_scalars",
    """select (select count(*) from orders) as n_orders, (select count(distinct l_orderkey) from lineitem) as n_ordered,
  (select max(p_size) from part)::bigint as max_size""",
)
def cross_join_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.cross_join_scalars(
        [
            table(spark, sf_dir, "orders").agg(F.count("*").alias("n_orders")),
            table(spark, sf_dir, "lineitem").agg(F.countDistinct("l_orderkey").alias("n_ordered")),
            table(spark, sf_dir, "part").agg(F.max("p_size").alias("max_size")),
        ]
    )


@query(
    "anti_join",
    """select o_orderkey, o_custkey from orders o
where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)""",
)
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.missing_from(orders, table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


@query(
    "fk_by_hash",
    with_(
        DIMENSIONS,
        """select d.drug_name, d.n_reports, count(f.drug_key) as n_facts from dim_drug d left join fact f on f.drug_key = d.drug_key
group by all""",
    ),
)
def fk_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = save(resolve_reports(attributed_cases(spark, sf_dir)), "resolved")
    drugs = dim_drug(resolved)
    facts = fact_reactions(reactions_of(resolved)).groupBy("drug_key").agg(F.count("*").alias("n_facts"))
    return drugs.join(facts, "drug_key", "left").select(
        "drug_name", "n_reports", F.coalesce("n_facts", F.lit(0)).alias("n_facts")
    )


@query(
    "star_join",
    with_(
        DIMENSIONS,
        """, calendar as (
  select strftime(d, '%Y%m%d')::bigint as receive_date_key, year(d) || '-Q' || quarter(d) as year_quarter
  from generate_series(date '1960-01-01', date '2027-12-31', interval 1 day) as r(d)
)
select c.year_quarter, d.drug_name_source, o.outcome_label,
  count(*) as n_reactions, count(distinct f.safety_report_id) as n_cases, max(r.n_reactions) as max_term_size
from fact f left join calendar c using (receive_date_key)
left join dim_drug d using (drug_key) left join dim_reaction r using (reaction_key)
left join outcomes o on f.outcome_key = md5(o.outcome_code) where not f.is_probable_duplicate group by all""",
    ),
)
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = save(resolve_reports(attributed_cases(spark, sf_dir)), "resolved")
    react = reactions_of(resolved)
    joined = with_dimensions(
        exclude_duplicates(fact_reactions(react)),
        dim_date(spark),
        save(dim_drug(resolved), "dim_drug"),
        dim_outcome(outcome_seed(spark)),
        save(dim_reaction(react), "dim_reaction"),
    )
    return joined.groupBy("year_quarter", "drug_name_source", "outcome_label").agg(
        F.count("*").alias("n_reactions"),
        F.countDistinct("safety_report_id").alias("n_cases"),
        F.max("n_reactions").alias("max_term_size"),
    )


# Aggregates


@query("group_count", with_(SUSPECTS, "select drug_name, count(*) as n_reports from suspect_drugs group by 1"))
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suspect_drugs(attributed_cases(spark, sf_dir)).groupBy("drug_name").agg(
        F.count("*").alias("n_reports")
    )


@query(
    "count_distinct",
    with_(
        STUDIES,
        """select count(*) as landed_rows, count(distinct nct_id) as distinct_keys, count(distinct source_file) as source_files,
  count(distinct batch_id) as batches from study_log""",
    ),
)
def count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study_log(spark, sf_dir).agg(
        F.count("*").alias("landed_rows"),
        F.countDistinct("protocolSection.identificationModule.nctId").alias("distinct_keys"),
        F.countDistinct("_source_file").alias("source_files"),
        F.countDistinct("_batch_id").alias("batches"),
    )


@query(
    "conditional_distinct",
    with_(
        REACTIONS,
        """select drug_name_source, count(distinct case when not is_probable_duplicate then id end) as cases,
  count(distinct case when not is_probable_duplicate and outcome = '5' then id end) as fatal_cases
from reactions group by 1""",
    ),
)
def conditional_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ~F.col("is_probable_duplicate")
    report = F.col("safety_report_id")
    return aggregates.distinct_per_group(
        reactions_of_cases(spark, sf_dir),
        ["drug_name_source"],
        report,
        {"cases": kept, "fatal_cases": kept & (F.col("outcome_code") == "5")},
    )


@query(
    "count_if",
    with_(
        SUSPECTS,
        """select count_if(drug_name_source = 'openfda_generic')::bigint as from_openfda,
  count_if(drug_name_source = 'medicinalproduct')::bigint as from_verbatim, count_if(drug_name_source = 'none')::bigint as absent,
  count_if(n_suspect_drugs >= 2)::bigint as multi_suspect from suspect_drugs""",
    ),
)
def count_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.col("drug_name_source")
    return suspect_drugs(attributed_cases(spark, sf_dir)).agg(
        F.count_if(source == "openfda_generic").alias("from_openfda"),
        F.count_if(source == "medicinalproduct").alias("from_verbatim"),
        F.count_if(source == "none").alias("absent"),
        F.count_if(F.col("n_suspect_drugs") >= 2).alias("multi_suspect"),
    )


@query(
    "sum_max_size",
    with_(
        APPLICATIONS,
        """select batch_id, sum(n_products)::bigint as products_total, max(n_products)::bigint as max_products,
  count(n_products) as with_products from application_log group by 1""",
    ),
)
def sum_max_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = fn.n_items(F.col("products"))
    return (
        application_log(spark, sf_dir)
        .groupBy(F.col("_batch_id").alias("batch_id"))
        .agg(
            F.sum(size).alias("products_total"),
            F.max(size).alias("max_products"),
            F.count("products").alias("with_products"),
        )
    )


@query(
    "priority_label",
    with_(
        SUSPECTS,
        """select drug_name, case when bool_or(drug_name_source = 'openfda_generic') then 'openfda_generic'
  when bool_or(drug_name_source = 'medicinalproduct') then 'medicinalproduct' else 'none' end as drug_name_source,
  min(drug_name_source) as smallest_label from suspect_drugs group by 1""",
    ),
)
def priority_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.col("drug_name_source")
    return (
        suspect_drugs(attributed_cases(spark, sf_dir))
        .groupBy("drug_name")
        .agg(
            aggregates.priority_label(source, DRUG_NAME_SOURCES).alias("drug_name_source"),
            F.min(source).alias("smallest_label"),
        )
    )


# Set operations, generators, reshaping


@query(
    "union_all",
    """select 'orders' as source_name, o_orderkey as k, o_orderdate::date::varchar as day from orders
union all select 'lineitem', l_orderkey, l_shipdate::date::varchar from lineitem
union all select 'events', event_id, ts::date::varchar from events""",
)
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(name: str, k: str, day: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(name).alias("source_name"), F.col(k).alias("k"), F.col(day).cast("date").alias("day")
        )

    orders = part("orders", "o_orderkey", "o_orderdate")
    lines = part("lineitem", "l_orderkey", "l_shipdate")
    return orders.unionByName(lines).unionByName(part("events", "event_id", "ts"))


@query(
    "recursive_seq",
    """
with recursive seq(n) as (
  select 1 union all select n + 1 from seq where n < (select max(l_linenumber) from lineitem))
select n::bigint as n, count(l_linenumber) as n_lines from seq left join lineitem on l_linenumber = n group by n""",
)
def recursive_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(F.count("*").alias("n_lines"))
    last = counts.agg(F.max("l_linenumber")).first()[0]
    numbers = fanout.recursive_sequence(spark, last)
    return numbers.join(counts, F.col("n") == F.col("l_linenumber"), "left").select(
        "n", F.coalesce("n_lines", F.lit(0)).alias("n_lines")
    )


@query(
    "fan_out",
    with_(
        STG_REPORTS,
        """select id as safety_report_id, seq::bigint as reaction_seq, reactions[seq + 1].term as term,
  reactions[seq + 1].outcome as outcome
from (select id, reactions, generate_subscripts(reactions, 1) - 1 as seq from reports)""",
    ),
)
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = stage_reports(case_log(spark, sf_dir)).select("safety_report_id", "reactions")
    rows = fanout.fan_out(reports, "reactions", "reaction_seq", "reaction")
    return rows.select(
        "safety_report_id",
        "reaction_seq",
        F.col("reaction.reactionmeddrapt").alias("term"),
        F.col("reaction.reactionoutcome").alias("outcome"),
    )


@query(
    "fan_out_outer",
    with_(
        VOCABULARY,
        """select descriptor_ui, seq::bigint as seq, tree_numbers[seq + 1] as tree_number
from (select descriptor_ui, tree_numbers, generate_subscripts(tree_numbers, 1) - 1 as seq from vocabulary)
union all select descriptor_ui, null, null from vocabulary where len(tree_numbers) = 0""",
    ),
)
def fan_out_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_descriptors(vocabulary_log(spark, sf_dir)).select("descriptor_ui", "tree_numbers")
    return fanout.fan_out(staged, "tree_numbers", "seq", "tree_number", outer=True)


@query(
    "explode_counts",
    with_(
        VOCABULARY,
        """select count(t) as n_items, count(distinct t) as n_distinct from (select unnest(tree_numbers) as t from vocabulary_log)""",
    ),
)
def explode_counts_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_counts(vocabulary_log(spark, sf_dir), "tree_numbers")


@query(
    "date_spine",
    """
with b as (select min(o_orderdate)::date as d1, max(o_orderdate)::date as d2 from orders),
days as (select unnest(generate_series(d1, d2, interval 1 day))::date as day from b)
select day::varchar as date_day, count(o_orderkey) as n_orders from days left join orders on o_orderdate::date = day group by 1""",
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date_day"))
        .agg(F.count("*").alias("n_orders"))
    )
    day = F.col("o_orderdate").cast("date")
    ends = table(spark, sf_dir, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = fanout.days_between(ends, "first", "last")
    return days.join(per_day, "date_day", "left").select(
        "date_day", F.coalesce("n_orders", F.lit(0)).alias("n_orders")
    )


@query(
    "stack_long",
    """
with w as (select count(*) as n_lines, count_if(l_returnflag = 'R')::bigint as n_returned, max(l_linenumber)::bigint as max_line from lineitem)
select 'n_lines' as metric, n_lines as value, null::varchar as denominator from w
union all select 'n_returned', n_returned, 'n_lines' from w union all select 'max_line', max_line, null from w""",
)
def stack_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.max("l_linenumber").alias("max_line"),
    )
    return fanout.to_long(
        wide,
        {"n_lines": ("n_lines", None), "n_returned": ("n_returned", "n_lines"), "max_line": ("max_line", None)},
    )
