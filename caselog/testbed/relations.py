"""Queries for the relations between the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.plans import relations
from caselog.plans.intermediate import suspect_drugs
from caselog.plans.staging import stage_applications, stage_descriptors, stage_reports
from caselog.plans.star import dim_date, dim_drug
from caselog.sources.sinks import preview
from caselog.testbed.adapters import (
    application_log,
    case_log,
    registered_with_typos,
    reported_names,
    table,
    vocabulary_log,
)
from caselog.testbed.operators import attributed_cases
from caselog.testbed.registry import query
from caselog.testbed.sql import APPLICATIONS, DIMENSIONS, SUSPECTS, VOCABULARY, with_


@query(
    "suspect_bridge",
    with_(
        SUSPECTS,
        """, listed as (select id, suspects, generate_subscripts(suspects, 1) as i from first_suspects)
select id as safety_report_id, i - 1 as suspect_seq,
  coalesce(nullif(upper(trim(list_sort(list_transform(suspects[i].generic, lambda x: {'l': length(x), 'v': x}))[1].v)), ''),
    nullif(upper(trim(suspects[i].product)), ''), 'NO SUSPECT DRUG REPORTED') as drug_name,
  case when suspects[i].generic is not null then 'openfda_generic' else 'medicinalproduct' end as drug_name_source,
  1 / len(suspects) as weight from listed""",
    ),
)
def suspect_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.suspect_bridge(stage_reports(case_log(spark, sf_dir)))


@query(
    "drug_crosswalk",
    with_(
        DIMENSIONS + "," + APPLICATIONS,
        """, names as (
  select distinct application_number, 'DRUG ' || (s_suppkey + i) % 64 as drug_name
  from applications, range(4) as r(i) where i < n_products)
select drug_name, application_number from dim_drug left join names using (drug_name)""",
    ),
)
def drug_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    drugs = dim_drug(suspect_drugs(attributed_cases(spark, sf_dir)))
    return relations.drug_crosswalk(drugs, stage_applications(application_log(spark, sf_dir)))


_NEAREST = """pairs as (
  select n.drug_name, r.registered_name, levenshtein(n.drug_name, r.registered_name) as distance
  from names n join (select distinct drug_name as registered_name from registered) r
    on abs(length(n.drug_name) - length(r.registered_name)) <= least(2, length(n.drug_name) // 5)
  where levenshtein(n.drug_name, r.registered_name) <= least(2, length(n.drug_name) // 5)
  qualify rank() over (partition by n.drug_name order by distance) = 1),
links as (select p.drug_name, r.application_number, r.source, p.registered_name, p.distance from pairs p join registered r on r.drug_name = p.registered_name)
select n.drug_name, application_number, source, registered_name, distance::bigint as distance from names n left join links using (drug_name)"""


@query(
    "crosswalk_nearest",
    with_(
        DIMENSIONS + "," + APPLICATIONS,
        f""", names as (select distinct drug_name from dim_drug),
registered as (
  select distinct application_number, 'brand' as source, 'DRUG ' || (s_suppkey + i) % 64 as drug_name
  from applications, range(4) as r(i) where i < n_products
  union select application_number, 'harmonised', upper(s_name) from applications join supplier using (s_suppkey) where has_openfda),
{_NEAREST}""",
    ),
)
def crosswalk_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the drug dimension against all names of the applications."""
    drugs = dim_drug(suspect_drugs(attributed_cases(spark, sf_dir)))
    registered = relations.registered_names(stage_applications(application_log(spark, sf_dir)))
    return relations.nearest_crosswalk(drugs, registered)


@query(
    "crosswalk_typos",
    f"""with names as (select distinct upper(p_name || ' ' || p_partkey % 500) as drug_name from part),
registered as (
  select 'NDA' || p_partkey as application_number, ['brand', 'harmonised', 'ingredient'][p_partkey % 3 + 1] as source,
    case p_partkey % 4 when 0 then name when 1 then name[:2] || name[4:] when 2 then name[:1] || '?' || name[3:] || 'S'
      else upper(p_brand || ' ' || p_partkey) end as drug_name
  from (select *, upper(p_name || ' ' || p_partkey % 500) as name from part)),
{_NEAREST}""",
)
def crosswalk_typos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many names with segments that are shared by many, and typos in a half of them."""
    return relations.nearest_crosswalk(reported_names(spark, sf_dir), registered_with_typos(spark, sf_dir))


@query(
    "descriptor_hierarchy",
    with_(
        VOCABULARY,
        """, numbers as (select descriptor_ui, string_split(t, '.') as p from (select descriptor_ui, unnest(tree_numbers) as t from vocabulary)),
prefixes as (select descriptor_ui, array_to_string(p[1:d], '.') as ancestor_number, d as depth from (select *, generate_subscripts(p, 1) as d from numbers))
select ancestor_number, depth, count(distinct descriptor_ui) as n_descriptors from prefixes group by all""",
    ),
)
def descriptor_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.descriptor_hierarchy(stage_descriptors(vocabulary_log(spark, sf_dir)))


@query(
    "descriptor_edges",
    with_(
        VOCABULARY,
        """, listed as (select descriptor_ui, unnest(tree_numbers) as t from vocabulary),
numbers as (select descriptor_ui, t, string_split(t, '.') as p from vocabulary left join listed using (descriptor_ui)),
depths as (select *, unnest(case when t is null then [null] else range(1, len(p) + 1) end) as depth from numbers)
select case when depth is not null then array_to_string(p[1:depth], '.') end as ancestor_number,
  case when depth > 1 then array_to_string(p[1:depth - 1], '.') end as parent_number, depth, count(distinct descriptor_ui) as n_descriptors
from depths group by all""",
    ),
)
def descriptor_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.descriptor_edges(stage_descriptors(vocabulary_log(spark, sf_dir)))


@query(
    "snapshots",
    with_(
        APPLICATIONS,
        """, batches as (select batch_id, lead(batch_id) over (order by batch_id) as next from (select distinct batch_id from application_log)),
rows as (
  select application_number, sponsor_name, n_products, batch_id from application_log
  qualify row_number() over (partition by application_number, batch_id order by pulled_at desc, source_file desc) = 1),
marked as (
  select *, case when lag(sponsor_name) over k = sponsor_name and lag(n_products) over k is not distinct from n_products
    and lag(next) over k = batch_id then 0 else 1 end as new
  from rows join batches using (batch_id) window k as (partition by application_number order by batch_id)),
versions as (select *, sum(new) over (partition by application_number order by batch_id) as version from marked)
select application_number, min(sponsor_name) as sponsor_name, min(batch_id) as valid_from, last(next order by batch_id) as valid_to
from versions group by application_number, version""",
    ),
)
def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = application_log(spark, sf_dir).withColumn("n_products", F.size("products"))
    found = relations.snapshots(log, "application_number", ["sponsor_name", "n_products"])
    return found.select("application_number", "sponsor_name", "valid_from", "valid_to")


@query(
    "calendar_counts",
    """
with calendar as (select d::date as day from generate_series(date '1960-01-01', date '2027-12-31', interval 1 day) as r(d))
select strftime(day, '%Y%m%d')::bigint as date_key, count(o_orderkey) as n_orders
from calendar left join orders on o_orderdate::date = day group by all""",
)
def calendar_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on every day of the calendar dimension."""
    days = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMMdd").cast("bigint").alias("date_key"))
    counts = days.agg(F.count("*").alias("n"))
    joined = dim_date(spark).select(F.col("date_key").cast("bigint").alias("date_key")).join(counts, "date_key", "left")
    return joined.select("date_key", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("preview", "select least(count(*), 20)::bigint as n_rows, count(*) > 20 as has_more from orders")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preview's row limit is the feature; which rows it shows is not."""
    orders = table(spark, sf_dir, "orders")
    shown = preview(orders).agg(F.count("*").alias("n_rows"))
    return shown.withColumn("has_more", orders.agg((F.count("*") > 20).alias("more")).scalar())
