"""Reshape the relational test tables into raw logs of nested records.

Every record is made of one row's own columns, its arrays too: nothing is grouped, joined or counted, no
row is dropped, and a record is the same at any size of the tables. A line that occurs again under its
order and number is a re-publication of its case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("qty"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        "l_returnflag",
    )


def with_parts(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_brand"
    )
    return rows.join(parts, "l_partkey")


def lines_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_parts(lines(spark, sf_dir), spark, sf_dir)


# A line's columns under the names of the record they make. The version is the price in cents, so a line
# published again has another one; lines that agree even there differ in the file. Some cases have no date,
# and some one after the calendar's end.
CASE_ROWS = """
    concat(l_orderkey, '/', l_linenumber) as id, l_orderkey as o_orderkey, l_partkey as o_custkey, l_suppkey,
    case l_returnflag when 'R' then 'F' when 'A' then 'P' else 'O' end as o_orderstatus,
    concat(l_linenumber % 5 + 1, '-X') as o_orderpriority,
    case when l_orderkey % 97 = 0 then null when l_orderkey % 89 = 0 then date_add(l_shipdate, 14610)
         else cast(l_shipdate as date) end as o_orderdate,
    cast(l_quantity as int) as qty, cast(round(l_extendedprice * 100) as bigint) as cents,
    concat_ws('-', l_partkey, l_suppkey, cast(l_quantity as int), l_returnflag, l_linestatus,
              date_format(l_shipdate, 'yyyyMMdd')) as row_text"""


def case_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_split(CASE_ROWS))


def _split(columns: str) -> list[str]:
    """Column expressions of a list, whose commas outside brackets separate them."""
    parts, depth = [""], 0
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return parts


# Drugs and reactions of a case, none to four, by the line's quantity.
_DRUGS = """transform(filter(sequence(0, 3), i -> i < qty % 5), i -> named_struct(
    'drugcharacterization', cast((qty + i) % 3 + 1 as string),
    'medicinalproduct', case when (o_custkey + 7 * i) % 11 = 0 then null when (o_custkey + 7 * i) % 7 = 0 then '  '
        else concat(' drug ', (o_custkey + 7 * i) % 64, ' ') end,
    'openfda', case when (o_custkey + 7 * i) % 3 = 0 then named_struct('generic_name',
        case when (o_custkey + 7 * i) % 33 = 0 then array('')
             else array(concat('drug ', (o_custkey + 7 * i) % 64, ' tablet'), concat('drug ', (o_custkey + 7 * i) % 64),
                        concat('Brand#', (o_custkey + 7 * i) % 25)) end) end))"""
_REACTIONS = """transform(filter(sequence(0, 3), i -> i < (qty + 2) % 5), i -> named_struct(
    'reactionmeddrapt', if((l_suppkey + i) % 13 = 0, '', concat('term ', (o_custkey + i) % 64)),
    'reactionoutcome', if((qty + i) % 8 between 1 and 6, cast((qty + i) % 8 as string), null)))"""


def _report_columns() -> dict[str, str]:
    """Raw scalar fields of a case report, as expressions over case rows and the revision `v`."""
    day = "date_format(date_add(cast(o_orderdate as date), 30 * v), 'yyyyMMdd')"
    return {
        "safetyreportversion": "cast(cents + 1000000 * v as string)",
        "companynumb": "concat('US-', o_custkey)",
        "authoritynumb": "cast(null as string)",
        "duplicate": "case o_custkey % 5 when 0 then '1' when 1 then '2' end",
        "reportduplicate": "if(o_custkey % 5 = 0, concat('of-', o_custkey), null)",
        "reporttype": "cast(o_custkey % 4 + 1 as string)",
        "serious": "if(substr(o_orderpriority, 1, 1) in ('1', '2'), '1', '2')",
        "seriousnessdeath": "if(o_orderstatus = 'F', '1', null)",
        "seriousnesshospitalization": "if(o_custkey % 3 = 0, '1', null)",
        "seriousnesslifethreatening": "cast(null as string)",
        "seriousnessdisabling": "if(o_custkey % 7 = 0, '1', '2')",
        "seriousnesscongenitalanomali": "cast(null as string)",
        "seriousnessother": "if(substr(o_orderpriority, 1, 1) = '1', '1', null)",
        "fulfillexpeditecriteria": "if(o_orderstatus = 'P', '1', '2')",
        "occurcountry": "concat('C', o_custkey % 25)",
        "primarysourcecountry": "concat('C', (o_custkey + 1) % 25)",
        "primarysource": "named_struct('reportercountry', concat('C', o_custkey % 25),"
        " 'qualification', substr(o_orderpriority, 1, 1),"
        " 'literaturereference', if(o_orderkey % 50 = 0, concat('ref ', o_orderkey), null))",
        "sender": "named_struct('senderorganization', concat('ORG-', o_custkey % 7), 'sendertype', '2')",
        "receiver": "named_struct('receiverorganization', 'ORG-0', 'receivertype', '6')",
        "receiptdate": day,
        "receivedate": day,
        "transmissiondate": day,
        "receiptdateformat": "if(o_orderkey % 20 = 7, '610', '102')",
    }


_PATIENT = """named_struct(
    'patientsex', cast(o_custkey % 3 as string), 'patientagegroup', cast(null as string),
    'patientonsetage', cast(o_orderkey % 90 as string), 'patientonsetageunit', '801',
    'patientweight', cast(null as string),
    'summary', named_struct('narrativeincludeclinical',
                            if(o_orderkey % 4 = 0, concat('case ', o_orderkey), null)){children})"""

_REVISIONS = "explode(if(o_orderkey % 10 = 0, array(0, 1), array(0))) as v"


def _landed(pulled: str, source_file: str) -> list[Column]:
    """Load metadata, from expressions over the pull number `v`."""
    return [
        F.expr(f"concat({pulled}, 'T06:00:00+00:00')").alias("_pulled_at"),
        F.expr(f"cast(concat({pulled}, ' 07:00:00') as timestamp)").alias("_loaded_at"),
        F.expr(source_file).alias("_source_file"),
        F.expr(f"concat(replace({pulled}, '-', ''), '070000')").alias("_batch_id"),
    ]


def _report_landing() -> list[Column]:
    return _landed("if(v = 0, '2026-01-05', '2026-04-05')", "concat(if(v = 0, 'part-a-', 'part-b-'), row_text)")


def case_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw case log without its arrays."""
    return _case_log(spark, sf_dir, "")


def case_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw case log: one row per line, two for a revised one."""
    return _case_log(spark, sf_dir, f", 'drug', {_DRUGS}, 'reaction', {_REACTIONS}")


def _case_log(spark: SparkSession, sf_dir: str, children: str) -> DataFrame:
    return case_rows(spark, sf_dir).selectExpr("*", _REVISIONS).select(
        F.col("id").alias("safetyreportid"),
        *[F.expr(e).alias(c) for c, e in _report_columns().items()],
        F.expr(_PATIENT.format(children=children)).alias("patient"),
        *_report_landing(),
    )


def _study_date(shift: int) -> str:
    """Text of the order date plus days: missing, a year, a month or a day, by the key."""
    k = f"(o_orderkey + {shift})"
    day = f"date_add(cast(o_orderdate as date), {shift * 50})"
    return (
        f"case when {k} % 97 = 0 then null when {k} % 89 = 0 then date_format({day}, 'yyyy')"
        f" when {k} % 5 < 2 then date_format({day}, 'yyyy-MM') else date_format({day}, 'yyyy-MM-dd') end"
    )


def study_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw study log: one study per order, pulled again when it changed. Some studies come in
    two files with one and the same pull time."""
    pulls = "explode(case when o_orderkey % 50 = 0 then array(0, 1, 2) when o_orderkey % 10 = 0 then array(0, 1) else array(0) end) as v"
    day = "date_format(date_add(cast(o_orderdate as date), 20 * v), 'yyyy-MM-dd')"
    study = f"""named_struct(
      'identificationModule', named_struct(
        'nctId', concat('NCT', lpad(cast(o_orderkey as string), 12, '0')),
        'acronym', if(o_custkey % 4 = 0, concat('ACR', o_custkey % 50), null),
        'briefTitle', concat('Study ', o_orderkey), 'officialTitle', o_orderpriority,
        'orgStudyIdInfo', named_struct('id', concat('S-', o_custkey)),
        'organization', named_struct('fullName', concat('Org ', o_custkey % 100), 'class', 'INDUSTRY'),
        'nctIdAliases', if(o_orderkey % 30 = 0, array(concat('OLD', o_orderkey)), null)),
      'sponsorCollaboratorsModule', named_struct(
        'leadSponsor', named_struct('name', concat('Org ', o_custkey % 100), 'class', 'INDUSTRY'),
        'collaborators', array(named_struct('name', concat('Col ', o_custkey % 9), 'class', 'OTHER'))),
      'designModule', named_struct(
        'studyType', if(o_orderstatus = 'O', 'OBSERVATIONAL', 'INTERVENTIONAL'),
        'phases', case substr(o_orderpriority, 1, 1) when '1' then array('PHASE1')
            when '2' then array('PHASE2') when '3' then array('PHASE3')
            when '4' then array('PHASE2', 'PHASE3') else null end,
        'enrollmentInfo', named_struct('count', o_custkey % 1000, 'type', 'ESTIMATED'),
        'designInfo', named_struct('allocation', 'RANDOMIZED', 'interventionModel', 'PARALLEL',
            'primaryPurpose', 'TREATMENT',
            'maskingInfo', named_struct('masking', if(o_custkey % 2 = 0, 'NONE', 'DOUBLE')))),
      'conditionsModule', named_struct(
        'conditions', array(if(o_custkey % 3 = 0, 'Lung Cancer', 'Asthma'), concat('Cond ', o_custkey % 20)),
        'keywords', if(o_custkey % 2 = 0, array('kw'), null)),
      'armsInterventionsModule', named_struct(
        'armGroups', array(named_struct('label', 'A', 'type', 'EXPERIMENTAL')),
        'interventions', array(named_struct('type', 'DRUG', 'name', concat('Drug ', o_custkey % 60)))),
      'statusModule', named_struct(
        'overallStatus', concat(o_orderstatus, v), 'lastKnownStatus', cast(null as string),
        'whyStopped', if(o_orderkey % 40 = 0, 'funding', null),
        'expandedAccessInfo', named_struct('hasExpandedAccess', o_custkey % 11 = 0,
            'nctId', if(o_custkey % 11 = 0, concat('NCT', o_custkey), null)),
        'startDateStruct', named_struct('date', {_study_date(0)}, 'type', 'ACTUAL'),
        'primaryCompletionDateStruct', named_struct('date', {_study_date(1)}, 'type', 'ESTIMATED'),
        'completionDateStruct', named_struct('date', {_study_date(2)}, 'type', 'ESTIMATED'),
        'studyFirstPostDateStruct', named_struct('date', date_format(o_orderdate, 'yyyy-MM-dd')),
        'lastUpdatePostDateStruct', named_struct('date', {day}),
        'resultsFirstPostDateStruct', named_struct('date', if(o_custkey % 2 = 0, null, {day}))))"""
    return table(spark, sf_dir, "orders").selectExpr("*", pulls).select(
        F.expr(study).alias("protocolSection"),
        *_landed("if(v = 0, '2026-01-05', '2026-01-12')", "element_at(array('pull-a', 'pull-b', 'pull-c'), v + 1)"),
    )


def application_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw application log: the whole catalogue twice, one application per supplier with none to four
    products. A tenth of the suppliers is withdrawn from the second batch; some are in it twice."""
    batches = "explode(case when s_suppkey % 10 = 0 then array(0) when s_suppkey % 20 = 1 then array(0, 1, 2) else array(0, 1) end) as v"
    number = "lpad(cast(s_suppkey as string), 9, '0')"
    products = """if(s_suppkey % 23 = 0, null, transform(filter(sequence(0, 3), i -> i < s_suppkey % 5), i -> named_struct(
        'product_number', cast(7 * s_suppkey + i as string), 'brand_name', concat('drug ', (s_suppkey + i) % 64))))"""
    return table(spark, sf_dir, "supplier").selectExpr("*", batches).select(
        F.expr(
            f"case when s_suppkey % 17 = 0 then {number} else"
            f" concat(element_at(array('NDA', 'ANDA', 'BLA'), cast(s_suppkey % 3 as int) + 1), {number}) end"
        ).alias("application_number"),
        F.expr("concat(s_name, if(v = 2, ' (corrected)', ''))").alias("sponsor_name"),
        F.expr(products).alias("products"),
        F.expr("array(named_struct('submission_type', 'ORIG', 'submission_number', '1'))").alias("submissions"),
        F.expr(
            "if(s_suppkey % 3 = 0, named_struct('application_number', array(s_name), 'brand_name', array(s_name)), null)"
        ).alias("openfda"),
        *_landed_application(),
    )


def reported_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.expr("upper(concat(p_name, ' ', p_partkey % 500))").alias("drug_name"))


def registered_with_typos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name for each part, as reported, with a letter dropped, with two letters wrong, or another one."""
    name = "upper(concat(p_name, ' ', p_partkey % 500))"
    return table(spark, sf_dir, "part").select(
        F.expr("concat('NDA', p_partkey)").alias("application_number"),
        F.expr("element_at(array('brand', 'harmonised', 'ingredient'), cast(p_partkey % 3 as int) + 1)").alias("source"),
        F.expr(
            f"case p_partkey % 4 when 0 then {name} when 1 then concat(left({name}, 2), substr({name}, 4))"
            f" when 2 then concat(left({name}, 1), '?', substr({name}, 3), 'S') else upper(concat(p_brand, ' ', p_partkey)) end"
        ).alias("drug_name"),
    )


def catalogue_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application log, narrow, and a third batch: some numbers are gone, some have come back, and some have
    another sponsor."""
    columns = ["application_number", "sponsor_name", "n_products", "_pulled_at", "_source_file", "_batch_id"]
    log = application_log(spark, sf_dir).withColumn("n_products", F.size("products"))
    third = log.where("_source_file = 'bulk-a'").withColumn("key", F.expr("cast(right(application_number, 9) as bigint)"))
    third = third.where("key % 7 <> 0").withColumn(
        "sponsor_name",
        F.expr("concat(sponsor_name, case when key % 20 = 1 then ' (corrected)' when key % 4 = 0 then ' (third)' else '' end)"),
    )
    stamps = {"_pulled_at": "2026-04-01T06:00:00+00:00", "_source_file": "bulk-c", "_batch_id": "20260401070000"}
    third = third.withColumns({c: F.lit(v) for c, v in stamps.items()})
    return log.select(*columns).unionByName(third.select(*columns))


def _landed_application() -> list[Column]:
    pulled, loaded, source, batch = _landed(
        "element_at(array('2026-02-01', '2026-03-01', '2026-03-02'), v + 1)", "if(v = 0, 'bulk-a', 'bulk-b')"
    )
    loaded = F.expr("cast(if(v = 0, '2026-02-01 07:00:00', '2026-03-02 07:00:00') as timestamp)")
    batch = F.expr("if(v = 0, '20260201070000', '20260302070000')")
    return [pulled, loaded.alias("_loaded_at"), source, batch.alias("_batch_id")]


def vocabulary_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw vocabulary log: a descriptor per part with none to four tree numbers. Some are in a
    second annual file under a revised name."""
    parts = table(spark, sf_dir, "part").selectExpr("*", "md5(cast(p_partkey as string)) as digest")
    years = "explode(if(substr(digest, 2, 1) < '8', array(0, 1), array(0))) as v"
    trees = "transform(filter(sequence(0, 3), i -> i < p_size % 5), i -> concat_ws('.', p_type, p_brand, p_size + i))"
    return parts.selectExpr("*", years).select(
        F.expr("concat('D', lpad(cast(p_partkey as string), 9, '0'))").alias("descriptor_ui"),
        F.expr("concat(p_name, if(v = 1, ' (revised)', ''))").alias("descriptor_name"),
        F.expr(trees).alias("tree_numbers"),
        *_landed("if(v = 0, '2025-11-20', '2026-11-20')", "if(v = 0, 'desc-a', 'desc-b')"),
    )


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the published file that holds it: a file per month, in a folder per
    quarter. Orders of the status P in every third month are in no dated folder."""
    day = F.to_date("o_orderdate")
    dated = F.format_string("/drug/event/%dq%d/part-%02d.json", F.year(day), F.quarter(day), F.month(day))
    undated = (F.month(day) % 3 == 0) & (F.col("o_orderstatus") == "P")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("day"),
        "o_orderstatus",
        F.when(undated, "/drug/event/all_other/part-00.json").otherwise(dated).alias("file"),
    )


def partition_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published index: file, declared records, size as text."""
    return (
        part_files(spark, sf_dir)
        .groupBy("file")
        .agg(F.count("*").alias("records"), F.count("*").cast("string").alias("size_mb"))
    )


def landed_part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that landed, against the index: one file is short and one is missing."""
    lost = (F.date_format("day", "yyyy-MM") == "1996-03") & (F.col("o_orderstatus") == "O")
    missing = F.date_format("day", "yyyy-MM") == "1997-05"
    return part_files(spark, sf_dir).where(~(lost | missing)).select("o_orderkey", F.col("file").alias("_source_file"))
