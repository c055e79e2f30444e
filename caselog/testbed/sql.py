"""The adapters once more, as SQL table expressions for the comparison queries.

Written for DuckDB. Each constant is a list of CTE definitions without the leading WITH.
"""

CASES = """
case_rows as (
  select l_orderkey || '/' || l_linenumber as id, l_orderkey as o_orderkey, l_partkey as o_custkey, l_suppkey,
    case l_returnflag when 'R' then 'F' when 'A' then 'P' else 'O' end as o_orderstatus,
    (l_linenumber % 5 + 1) || '-X' as o_orderpriority, l_quantity::int as qty,
    case when l_orderkey % 97 = 0 then null when l_orderkey % 89 = 0 then l_shipdate::date + 14610 else l_shipdate::date end as o_orderdate,
    round(l_extendedprice * 100)::bigint as cents,
    concat_ws('-', l_partkey, l_suppkey, l_quantity::int, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y%m%d')) as row_text
  from lineitem
),
case_log as (
  select id, cents + 1000000 * v as version,
    o_orderdate + 30 * v::int as day,
    case when substr(o_orderpriority, 1, 1) in ('1', '2') then '1' else '2' end as serious,
    case when o_orderstatus = 'F' then '1' end as death,
    case o_custkey % 5 when 0 then '1' when 1 then '2' end as duplicate,
    case when v = 0 then timestamp '2026-01-05 06:00:00' else timestamp '2026-04-05 06:00:00' end as pulled_at,
    case when v = 0 then 'part-a-' else 'part-b-' end || row_text as source_file,
    case when v = 0 then '20260105070000' else '20260405070000' end as batch_id,
    [{'code': ((qty + i) % 3 + 1)::varchar,
      'product': case when (o_custkey + 7 * i) % 11 = 0 then null when (o_custkey + 7 * i) % 7 = 0 then '  '
                      else ' drug ' || (o_custkey + 7 * i) % 64 || ' ' end,
      'generic': case when (o_custkey + 7 * i) % 33 = 0 then ['']
                      when (o_custkey + 7 * i) % 3 = 0 then ['drug ' || (o_custkey + 7 * i) % 64 || ' tablet',
                        'drug ' || (o_custkey + 7 * i) % 64, 'Brand#' || (o_custkey + 7 * i) % 25] end}
     for i in range(qty % 5)] as drugs,
    [{'term': case when (l_suppkey + i) % 13 = 0 then '' else 'term ' || (o_custkey + i) % 64 end,
      'outcome': case when (qty + i) % 8 between 1 and 6 then ((qty + i) % 8)::varchar end}
     for i in range((qty + 2) % 5)] as reactions,
    case when o_orderkey % 20 = 7 then '610' else '102' end as format,
    o_orderkey, o_custkey, o_orderstatus, o_orderpriority, v
  from case_rows cross join (values (0), (1)) as revisions(v)
  where v = 0 or o_orderkey % 10 = 0
)"""

STG_REPORTS = (
    CASES
    + """,
reports as (
  select * from case_log
  qualify row_number() over (partition by id order by version desc, pulled_at desc, source_file desc) = 1
)"""
)

SUSPECTS = (
    STG_REPORTS
    + """,
first_suspects as (
  select *, list_filter(drugs, lambda d: d.code = '1') as suspects, suspects[1] as suspect from reports
),
suspect_drugs as (
  select id, len(suspects)::bigint as n_suspect_drugs,
    coalesce(
      nullif(upper(trim(list_sort(list_transform(suspect.generic, lambda x: {'l': length(x), 'v': x}))[1].v)), ''),
      nullif(upper(trim(suspect.product)), ''),
      'NO SUSPECT DRUG REPORTED') as drug_name,
    case when len(suspects) = 0 then 'none'
         when suspect.generic is not null then 'openfda_generic'
         else 'medicinalproduct' end as drug_name_source
  from first_suspects
)"""
)

REACTIONS = (
    SUSPECTS
    + """,
exploded as (
  select id, day, serious, death, duplicate, generate_subscripts(reactions, 1) - 1 as seq, unnest(reactions) as reaction from reports
),
reactions as (
  select e.id, e.seq::bigint as seq, e.day,
    coalesce(nullif(upper(trim(e.reaction.term)), ''), 'NOT STATED') as term,
    coalesce(e.reaction.outcome, '-1') as outcome,
    coalesce(e.serious = '1', false) as is_serious,
    coalesce(e.death = '1', false) as is_report_death,
    coalesce(e.duplicate = '1', false) as is_probable_duplicate,
    s.drug_name, s.drug_name_source, s.n_suspect_drugs
  from exploded e join suspect_drugs s on e.id = s.id
)"""
)


def key(*cols: str) -> str:
    return "md5(concat_ws('||', " + ", ".join(f"coalesce({c}::varchar, '~null~')" for c in cols) + "))"


# The reaction outcome codes with the default row.
OUTCOMES = """
outcomes(outcome_code, outcome_label) as (values
  ('1', 'Recovered/resolved'), ('2', 'Recovering/resolving'), ('3', 'Not recovered/not resolved'),
  ('4', 'Recovered/resolved with sequelae'), ('5', 'Fatal'), ('6', 'Unknown'), ('-1', 'Not stated'))"""

DIMENSIONS = (
    REACTIONS
    + ","
    + OUTCOMES
    + f""",
dim_drug as (
  select {key("drug_name")} as drug_key, drug_name,
    case when bool_or(drug_name_source = 'openfda_generic') then 'openfda_generic'
         when bool_or(drug_name_source = 'medicinalproduct') then 'medicinalproduct'
         else 'none' end as drug_name_source,
    count(*) as n_reports
  from suspect_drugs group by drug_name
),
dim_reaction as (
  select {key("term")} as reaction_key, term as reaction_term, count(*) as n_reactions
  from reactions group by term
),
fact as (
  select {key("id", "seq")} as reaction_event_key, strftime(day, '%Y%m%d')::bigint as receive_date_key,
    {key("drug_name")} as drug_key, {key("outcome")} as outcome_key, {key("term")} as reaction_key,
    id as safety_report_id, day as receive_date, is_serious, is_report_death, is_probable_duplicate,
    n_suspect_drugs
  from reactions
)"""
)


def _study_date(shift: int) -> str:
    k = f"(o_orderkey + {shift})"
    day = f"(o_orderdate::date + {shift * 50})"
    return (
        f"case when {k} % 97 = 0 then null when {k} % 89 = 0 then strftime({day}, '%Y')"
        f" when {k} % 5 < 2 then strftime({day}, '%Y-%m') else strftime({day}, '%Y-%m-%d') end"
    )


STUDIES = f"""
study_log as (
  select 'NCT' || lpad(o_orderkey::varchar, 12, '0') as nct_id, v,
    {_study_date(0)} as start_text, {_study_date(1)} as primary_text, {_study_date(2)} as completion_text,
    case when v = 0 then timestamp '2026-01-05 06:00:00' else timestamp '2026-01-12 06:00:00' end as pulled_at,
    case v when 0 then 'pull-a' when 1 then 'pull-b' else 'pull-c' end as source_file,
    case when v = 0 then '20260105070000' else '20260112070000' end as batch_id,
    orders.*
  from orders cross join (values (0), (1), (2)) as pulls(v)
  where v = 0 or (v = 1 and o_orderkey % 10 = 0) or (v = 2 and o_orderkey % 50 = 0)
),
studies as (
  select * from study_log
  qualify row_number() over (partition by nct_id order by pulled_at desc, source_file desc) = 1
)"""

APPLICATIONS = """
application_log as (
  select case when s_suppkey % 17 = 0 then '' when s_suppkey % 3 = 0 then 'NDA'
              when s_suppkey % 3 = 1 then 'ANDA' else 'BLA' end
         || lpad(s_suppkey::varchar, 9, '0') as application_number,
    s_name || case when v = 2 then ' (corrected)' else '' end as sponsor_name,
    case when s_suppkey % 23 <> 0 then s_suppkey % 5 end as n_products,
    case when s_suppkey % 23 <> 0 then
      array_to_string(list_sort([(7 * s_suppkey + i)::varchar for i in range(s_suppkey % 5)]), ',') end as part_list,
    s_suppkey % 3 = 0 as has_openfda, s_suppkey,
    case v when 0 then timestamp '2026-02-01 06:00:00' when 1 then timestamp '2026-03-01 06:00:00'
           else timestamp '2026-03-02 06:00:00' end as pulled_at,
    case when v = 0 then 'bulk-a' else 'bulk-b' end as source_file,
    case when v = 0 then '20260201070000' else '20260302070000' end as batch_id
  from supplier cross join (values (0), (1), (2)) as batches(v)
  where v = 0 or (v = 1 and s_suppkey % 10 <> 0) or (v = 2 and s_suppkey % 10 <> 0 and s_suppkey % 20 = 1)
),
applications as (
  select * from application_log
  where batch_id = (select max(batch_id) from application_log)
  qualify row_number() over (partition by application_number order by pulled_at desc, source_file desc) = 1
)"""

VOCABULARY = """
vocabulary_log as (
  select 'D' || lpad(p_partkey::varchar, 9, '0') as descriptor_ui,
    p_name || case when v = 1 then ' (revised)' else '' end as descriptor_name,
    [concat_ws('.', p_type, p_brand, p_size + i) for i in range(p_size % 5)] as tree_numbers,
    case when v = 0 then timestamp '2025-11-20 06:00:00' else timestamp '2026-11-20 06:00:00' end as pulled_at,
    case when v = 0 then 'desc-a' else 'desc-b' end as source_file,
    case when v = 0 then '20251120070000' else '20261120070000' end as batch_id
  from part cross join (values (0), (1)) as files(v)
  where v = 0 or substr(md5(p_partkey::varchar), 2, 1) < '8'
),
vocabulary as (
  select * from vocabulary_log
  qualify row_number() over (partition by descriptor_ui order by pulled_at desc, source_file desc) = 1
)"""

PART_FILES = """
part_files as (
  select o_orderkey, o_orderdate::date as day, o_orderstatus,
    case when month(o_orderdate) % 3 = 0 and o_orderstatus = 'P' then '/drug/event/all_other/part-00.json'
         else printf('/drug/event/%dq%d/part-%02d.json', year(o_orderdate), quarter(o_orderdate), month(o_orderdate))
    end as file
  from orders
),
part_index as (
  select file, count(*) as records,
    try_cast(regexp_extract(file, '/(\\d{4})q(\\d)/', 1) as bigint) as year,
    try_cast(regexp_extract(file, '/(\\d{4})q(\\d)/', 2) as bigint) as quarter
  from part_files group by file
)"""


def iso(c: str) -> str:
    """A timestamp as the text the registered queries give."""
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def with_(ctes: str, select: str) -> str:
    return f"with {ctes.strip()}\n{select.strip()}"
