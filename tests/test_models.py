"""Staging, intermediate and star models on hand-written records."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caselog.operators import checks, current
from caselog.operators.current import latest_per_key, newest_batch
from caselog.operators.joins import Dimension, attach_dimension
from caselog.plans import profiles, relations
from caselog.plans.intermediate import reactions, suspect_drugs
from caselog.plans.staging import (
    stage_applications,
    stage_descriptors,
    stage_reports,
    stage_studies,
)
from caselog.plans.star import dim_date, dim_drug, dim_outcome, dim_reaction, fact_reactions
from caselog.plans.warehouse import Raw, all_checks, build, publish
from caselog.sources import schemas
from caselog.sources.storage import shared_root
from caselog.testbed import QUERIES


def raw(spark, records, schema, **meta):
    """Records as a landed table; a record may override the load metadata."""
    defaults = {"_loaded_at": "2026-01-01T00:00:00Z", "_source_file": "f1", "_batch_id": "1", **meta}
    full = StructType(list(schema.fields)).add("_loaded_at", "timestamp")
    full = full.add("_source_file", "string").add("_batch_id", "string")
    base = {"_pulled_at": "2026-01-01T00:00:00+00:00"}
    lines = [(json.dumps(base | defaults | r),) for r in records]
    texts = spark.createDataFrame(lines, "value string")
    return texts.select(F.from_json("value", full).alias("r")).select("r.*")


def report(id_, version="1", day="20240105", drugs=None, terms=None, **more):
    patient = {"drug": drugs, "reaction": terms}
    return {
        "safetyreportid": id_,
        "safetyreportversion": version,
        "receivedate": day,
        "receiptdate": day,
        "transmissiondate": day,
        "patient": patient,
        **more,
    }


def drug(code, product=None, generic=None):
    d = {"drugcharacterization": code, "medicinalproduct": product}
    if generic is not None:
        d["openfda"] = {"generic_name": generic}
    return d


def test_packed_rows_come_back_whole(spark):
    schema = "k string, n int, t string, e string, i bigint, b boolean, s struct<x: string, y: struct<z: int>>, a array<struct<x: string, l: array<string>>>"
    rows = [
        ("a", 1, "old", None, 1, True, None, None),
        ("a", 2, "q\"\\ \n\t\u0001é😀 {}", "", -(2**63), False, (None, None), [("x", ["", None, "y"]), (None, None), None]),
        ("b", 1, None, None, None, None, ("1", (7,)), []),
        (None, 1, "null key", " ", 2**63 - 1, None, ("", (None,)), [("", [])]),
    ]
    df = spark.createDataFrame(rows, schema)
    plain = latest_per_key(df, "k", [F.desc("n")])
    packed = latest_per_key(df, "k", [F.desc("n")], packed=("t", "e", "i", "b", "s", "a"))
    assert packed.columns == df.columns and [f.dataType for f in packed.schema] == [f.dataType for f in df.schema]
    physical = packed._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert sorted(map(str, packed.collect())) == sorted(map(str, plain.collect())) and packed.count() == 3
    assert physical.count("from_json") == 1 and physical.index("from_json") < physical.index("WindowGroupLimit")


@pytest.mark.parametrize("words", [22, 6, 1])
def test_only_rows_of_repeated_keys_are_collapsed(spark, monkeypatch, words):
    monkeypatch.setattr(current, "_WORDS", words)
    many = [(f"k{i % 700}", i % 3 if i % 5 else None, i, f"t{i}") for i in range(1000)]
    hot = [("hot", 1, i, str(i)) for i in range(500)]
    df = spark.createDataFrame([*many, *hot, (None, 1, 1, "a"), (None, 1, 2, "b"), (None, None, 3, "c")], "k string, g int, n int, t string").repartition(5)
    for keys, packed in ((["k"], ()), (["k", "g"], ("t",))):
        plain = latest_per_key(df, keys, [F.desc("n")])
        apart = latest_per_key(df, keys, [F.desc("n")], packed=packed, apart=True)
        assert apart.columns == df.columns
        assert sorted(map(str, apart.collect())) == sorted(map(str, plain.collect()))
    plan = latest_per_key(df, "k", [F.desc("n")], apart=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and plan.index("LeftAnti") < plan.index("Window [") < plan.index("LeftSemi")


def test_packed_reports_are_the_same(spark):
    log = raw(spark, [report("1", "1"), report("1", "10", drugs=[drug("1", "x", ["a", None])]), report("2", terms=[{"reactionmeddrapt": "t"}])], schemas.REPORTS)
    assert sorted(map(str, stage_reports(log, packed=True).collect())) == sorted(map(str, stage_reports(log).collect()))


SUSPECT_CASES = {
    "two suspects": ([drug("2", "C"), drug("1", " first "), drug("1", "second")], 2, "FIRST", "medicinalproduct"),
    "shortest": (
        [drug("1", "brand", ["METHOTREXATE SODIUM", "methotrexate", "METHOTREXATE INJECTION"])],
        1,
        "METHOTREXATE",
        "openfda_generic",
    ),
    "tie": ([drug("1", None, ["bb", "aa"])], 1, "AA", "openfda_generic"),
    "blank generic wins": ([drug("1", "Brand", ["", "generic"])], 1, "BRAND", "openfda_generic"),
    "empty generics": ([drug("1", "Brand", [])], 1, "BRAND", "openfda_generic"),
    "nothing named": ([drug("1", "  ")], 1, "NO SUSPECT DRUG REPORTED", "medicinalproduct"),
    "no suspect": ([drug("2", "x"), drug(None, "y")], 0, "NO SUSPECT DRUG REPORTED", "none"),
    "empty": ([], 0, "NO SUSPECT DRUG REPORTED", "none"),
    "missing": (None, None, "NO SUSPECT DRUG REPORTED", "none"),
}


def test_suspect_drugs(spark):
    log = raw(spark, [report(k, drugs=v[0]) for k, v in SUSPECT_CASES.items()], schemas.REPORTS)
    got = {r.safety_report_id: tuple(r)[1:] for r in suspect_drugs(stage_reports(log)).collect()}
    assert got == {k: v[1:] for k, v in SUSPECT_CASES.items()}


def test_highest_version_wins(spark):
    log = raw(
        spark,
        [
            report("a", "9", "20240101", _pulled_at="2026-05-01T00:00:00+00:00"),
            report("a", "103", "20240301"),
            report("b", "2", "20240101", _source_file="f1"),
            report("b", "2", "20240202", _source_file="f2"),
            report("c", "1", "20240101", _pulled_at="2026-01-01T01:00:00+02:00"),
            report("c", "1", "20240303", _pulled_at="2026-01-01T00:00:00+00:00"),
        ],
        schemas.REPORTS,
    )
    got = {r.safety_report_id: r.receive_date.isoformat() for r in stage_reports(log).collect()}
    assert got == {"a": "2024-03-01", "b": "2024-02-02", "c": "2024-03-03"}


def test_null_keys_stay_visible_as_one_row(spark):
    log = raw(spark, [report(None), report(None, "2"), report("a")], schemas.REPORTS)
    staged = stage_reports(log)
    assert sorted(str(r[0]) for r in staged.select("safety_report_id").collect()) == ["None", "a"]
    assert checks.not_null(staged, ["safety_report_id"]).first().n_rows == 1


REACTION_LOG = [
    report("a", drugs=[drug("1", "x")], terms=[{"reactionmeddrapt": " Nausea "}, {"reactionmeddrapt": " ", "reactionoutcome": "5"}], serious="1", duplicate="1"),
    report("b", drugs=None, terms=[{"reactionmeddrapt": None, "reactionoutcome": "6"}], seriousnessdeath="1", duplicate="2"),
    report("c", drugs=[], terms=[]),
    report("d", drugs=[], terms=None),
    report(None, terms=[{"reactionmeddrapt": "lost"}]),
]


def test_reactions(spark):
    rows = reactions(stage_reports(raw(spark, REACTION_LOG, schemas.REPORTS)))
    got = sorted(
        (r.safety_report_id, r.reaction_seq, r.reaction_term, r.outcome_code, r.is_serious, r.is_report_death, r.is_probable_duplicate, r.drug_name)
        for r in rows.collect()
    )
    assert got == [
        ("a", 0, "NAUSEA", "-1", True, False, True, "X"),
        ("a", 1, "NOT STATED", "5", True, False, True, "X"),
        ("b", 0, "NOT STATED", "6", False, True, False, "NO SUSPECT DRUG REPORTED"),
    ]


def test_single_pass_equals_the_join(spark):
    from caselog.testbed.adapters import case_log

    logs = [raw(spark, REACTION_LOG, schemas.REPORTS), case_log(spark, "/root/testdata/sf0.001")]
    for log in logs:
        stg = stage_reports(log)
        single, joined = reactions(stg), reactions(stg, suspect_drugs(stg))
        assert single.columns == joined.columns
        assert single.exceptAll(joined).count() == 0 and joined.exceptAll(single).count() == 0


def test_headline_counts_cases_not_rows(spark):
    fatal = [{"reactionmeddrapt": "x", "reactionoutcome": "5"}] * 3
    log = raw(spark, [report("a", terms=fatal), report("b", terms=fatal, duplicate="1"), report("c", terms=[{"reactionmeddrapt": "y"}])], schemas.REPORTS)
    row = profiles.headline_outcomes(reactions(stage_reports(log))).first()
    assert (row.cases, row.reactions, row.fatal_cases) == (2, 4, 1)
    empty = profiles.headline_outcomes(reactions(stage_reports(log.where("false")))).first()
    assert (empty.cases, empty.reactions, empty.fatal_cases) == (0, 0, 0)


def test_studies(spark):
    def study(nct, start, status="x"):
        return {
            "protocolSection": {
                "identificationModule": {"nctId": nct},
                "statusModule": {"overallStatus": status, "startDateStruct": {"date": start, "type": "ACTUAL"}},
            }
        }

    log = raw(
        spark,
        [
            study("a", "2024-03", "old"),
            study("a", "2024-03-09", "new") | {"_pulled_at": "2026-02-01T00:00:00+00:00"},
            study("b", "2024"),
            study("c", None, "f1"),
            study("c", None, "f2") | {"_source_file": "f2"},
        ],
        schemas.STUDIES,
    )
    got = {r.nct_id: (r.overall_status, str(r.start_date), r.start_date_precision, r.start_date_type) for r in stage_studies(log).collect()}
    assert got == {
        "a": ("new", "2024-03-09", "day", "ACTUAL"),
        "b": ("x", "None", "day", "ACTUAL"),
        "c": ("f2", "None", None, "ACTUAL"),
    }


def test_withdrawn_applications_vanish(spark):
    log = raw(
        spark,
        [
            {"application_number": "NDA1", "products": None, "_batch_id": "20260101000000"},
            {"application_number": "BLA2", "products": [], "_batch_id": "20260101000000"},
            {"application_number": "BLA2", "products": [], "_batch_id": "20260201000000"},
            {"application_number": "77", "products": None, "_batch_id": "20260201000000"},
        ],
        schemas.APPLICATIONS,
    )
    staged = stage_applications(log)
    assert {r.application_number: r.application_type for r in staged.collect()} == {"BLA2": "BLA", "77": ""}
    assert newest_batch(log.where("false")).count() == 0
    assert newest_batch(log.withColumn("_batch_id", F.lit(None).cast("string"))).count() == 0
    profile = {r.metric: (r.value, r.denominator) for r in profiles.profile_applications(log, staged).collect()}
    assert len(profile) == 8
    assert profile["applications_no_products"] == (2, "staged_applications")
    assert profile["raw_batches"] == (2, None)
    assert profile["max_products_per_application"] == (0, None)


def test_vocabulary_profile(spark):
    log = raw(
        spark,
        [
            {"descriptor_ui": "D1", "descriptor_name": "n", "tree_numbers": ["C01", "C02.1"]},
            {"descriptor_ui": "D2", "descriptor_name": "n", "tree_numbers": ["C01"]},
            {"descriptor_ui": "D3", "descriptor_name": "n", "tree_numbers": []},
        ],
        schemas.DESCRIPTORS,
    )
    got = {r.metric: r.value for r in profiles.profile_vocabulary(log, stage_descriptors(log)).collect()}
    assert got == {
        "raw_rows": 3,
        "raw_distinct_descriptors": 3,
        "staged_descriptors": 3,
        "descriptors_multi_tree": 1,
        "descriptors_no_tree": 1,
        "max_tree_numbers_per_descriptor": 2,
        "tree_numbers_total": 3,
        "tree_numbers_distinct": 2,
    }


def test_calendar_span(spark):
    days = dim_date(spark)
    assert days.count() == 24837
    ends = days.agg(F.min("date_key"), F.max("date_key")).first()
    assert tuple(ends) == (19600101, 20271231)


def test_drug_dimension_prefers_the_harmonised_label(spark):
    susp = spark.createDataFrame(
        [("A", "medicinalproduct"), ("A", "openfda_generic"), ("B", "none"), ("B", "medicinalproduct"), ("C", "none")],
        "drug_name string, drug_name_source string",
    )
    got = {r.drug_name: (r.drug_name_source, r.n_reports) for r in dim_drug(susp).collect()}
    assert got == {"A": ("openfda_generic", 2), "B": ("medicinalproduct", 2), "C": ("none", 1)}


def test_latest_per_key_content_tiebreak_is_stable(spark):
    rows = [("k", 1, f"v{i}") for i in range(50)]
    winners = set()
    for shuffled in (rows, rows[::-1]):
        df = spark.createDataFrame(shuffled, "k string, t int, v string").repartition(4)
        winners.add(latest_per_key(df, "k", [F.desc("t")], content_tiebreak=True).first().v)
    assert len(winners) == 1


def test_every_fact_keeps_its_row_whatever_the_size_of_the_dimension(spark):
    fact = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 9 > 0, F.col("id") % 8).alias("fk"))
    dim = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("label"))
    small = attach_dimension(fact, Dimension(dim, "fk", "k"))
    large = attach_dimension(fact, Dimension(dim, "fk", "k"), max_rows=3)
    assert small.count() == large.count() == 1000 and set(small.columns) == set(large.columns)
    assert small.select("id", "label").exceptAll(large.select("id", "label")).count() == 0
    assert small.where("label is null").count() == fact.where("fk is null or fk > 6").count() > 0


@pytest.fixture(scope="module")
def seed(spark):
    return spark.createDataFrame(schemas.OUTCOME_ROWS, schemas.OUTCOME_CODES)


def small_raw(spark, reports):
    return Raw(
        studies=raw(spark, [{"protocolSection": {"identificationModule": {"nctId": "N1"}}}], schemas.STUDIES),
        reports=raw(spark, reports, schemas.REPORTS),
        applications=raw(spark, [{"application_number": "NDA1"}], schemas.APPLICATIONS),
        descriptors=raw(spark, [{"descriptor_ui": "D1", "descriptor_name": "n", "tree_numbers": []}], schemas.DESCRIPTORS),
    )


GOOD = [report("a", drugs=[drug("1", "x")], terms=[{"reactionmeddrapt": "t", "reactionoutcome": "1"}]), report("b", terms=[{"reactionmeddrapt": "u"}])]


def violations(raw_tables, warehouse, seed):
    return {r.check_name: r.n_violations for r in all_checks(raw_tables, warehouse, seed).collect()}


def test_all_checks_pass_on_good_input(spark, seed):
    tables = small_raw(spark, GOOD)
    found = violations(tables, build(tables, seed), seed)
    assert len(found) == 54
    kinds = [name.split()[0] for name in found]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 11, "not_null": 33, "accepted": 3, "relationship": 4, "complete": 1, "children": 1, "grain": 1,
    }
    assert set(found.values()) == {0}


def test_publish_names_every_relation(spark, seed, tmp_path):
    raw_tables = small_raw(spark, GOOD)
    names = publish(build(raw_tables, seed, str(tmp_path)))
    assert len(names) == 11
    assert spark.table("stg_reports").columns == stage_reports(raw_tables.reports).columns
    assert len(spark.table("stg_reports").columns) == 39
    assert spark.table("fact_reactions").count() == 2
    assert spark.read.parquet(f"{tmp_path}/dim_outcome").count() == 7
    joined = spark.sql("select drug_name from fact_reactions join dim_drug using (drug_key) order by 1")
    assert [r[0] for r in joined.collect()] == ["NO SUSPECT DRUG REPORTED", "X"]


def test_checks_report_broken_input(spark, seed):
    tables = small_raw(
        spark,
        [
            *GOOD,
            report("c", day="2024-01-05", terms=[{"reactionmeddrapt": "t", "reactionoutcome": "9"}]),
            report("d", day="20300101", terms=[{"reactionmeddrapt": "t"}]),
            report("e", terms=[]),
        ],
    )
    found = {k: v for k, v in violations(tables, build(tables, seed), seed).items() if v}
    assert found == {
        "not_null stg_reports.receipt_date": 1,
        "not_null stg_reports.receive_date": 1,
        "not_null stg_reports.transmission_date": 1,
        "not_null fact_reactions.receive_date_key": 1,
        "accepted int_reactions.outcome_code": 1,
        "relationship receive_date_key": 1,
        "relationship outcome_key": 1,
        "complete reports reach the fact": 1,
        "children reports have reactions": 1,
    }


def test_checks_report_broken_tables(spark, seed):
    from dataclasses import replace

    tables = small_raw(spark, GOOD)
    good = build(tables, seed)
    broken = replace(
        good,
        studies=good.studies.unionByName(good.studies),
        fact=good.fact.unionByName(good.fact),
        drugs=good.drugs.limit(1).withColumn("drug_name_source", F.lit("?")),
        outcomes=dim_outcome(seed).where("outcome_code <> '-1'"),
        terms=dim_reaction(good.reactions).withColumn("reaction_key", F.lit(None).cast("string")),
        reactions=good.reactions.unionByName(good.reactions),
        descriptors=good.descriptors.withColumn("descriptor_name", F.lit(None).cast("string")),
    )
    found = {k: v for k, v in violations(tables, broken, seed).items() if v}
    assert found == {
        "unique stg_studies.nct_id": 1,
        "unique fact_reactions.reaction_event_key": 2,
        "accepted dim_drug.drug_name_source": 1,
        "relationship drug_key": 1,
        "relationship outcome_key": 1,
        "relationship reaction_key": 2,
        "grain int_reactions": 2,
        "not_null stg_descriptors.descriptor_name": 1,
        "not_null dim_reaction.reaction_key": 2,
    }


def test_checks_scan_the_fact_once_and_fan_nothing_out(spark, seed, tmp_path):
    """Counts are taken while the tables are written; the same 54 results as by scanning all of them."""
    from dataclasses import replace

    tables = small_raw(spark, [*GOOD, report("c", day="2024-01-05", terms=[{"reactionmeddrapt": "t"}]), report("e", terms=[])])
    made = build(tables, seed, str(tmp_path))
    found = all_checks(tables, made, seed)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    executed = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Relation [reaction_event_key#") == 1
    assert "posexplode" not in plan and "reactions:array" not in executed
    scanned = all_checks(tables, replace(made, observed={}), seed)
    assert scanned._jdf.queryExecution().optimizedPlan().toString().count("posexplode") >= 2
    assert "reactions:array" in scanned._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, scanned.collect()))
    assert made.counts("reports")["not_null stg_reports.receive_date"] == 1 and made.counts("fact", "drugs") is not None
    assert replace(made, fact=made.fact.limit(1)).counts("fact") is None


def test_keys_are_checked_as_bytes_that_differ(spark):
    # hashes, their upper-case form, the text of their bytes, and texts one byte longer
    keys = ["61" * 16, "a" * 16, "a" * 16 + "\0", "ab" * 16, "AB" * 16, "g" * 32, "", "a" * 15, "a" * 15 + "\0"]
    child = spark.createDataFrame([*[(k, k, k) for k in keys], ("g" * 32, "cd" * 16, "61" * 16), (None, None, None)], "u string, fk string, c string")
    parent = spark.createDataFrame([(k,) for k in keys], "p string")
    row = lambda *missing: {"fk": ("fk", parent.where(~F.col("p").isin(*missing)), "p")}
    found = checks.key_checks(child, row("61" * 16, ""), "u", {"all": ("c", parent.unionByName(spark.createDataFrame([("6161",)], "p string")).withColumnRenamed("p", "c"))})
    assert dict(map(tuple, found.collect())) == {"fk": 3, "all": 1, "unique": 1}
    assert "check#" in (plan := found._jdf.queryExecution().optimizedPlan().toString()) and "unhex" in plan


def test_the_star_is_written_once_and_dense(spark, tmp_path):
    at = lambda name: str(tmp_path / f"{name}.parquet")
    spark.range(60).selectExpr(
        "id % 40 as l_orderkey", "id as l_partkey", "id % 7 as l_suppkey", "1 as l_linenumber", "double(id) as l_quantity", "double(100 + id) as l_extendedprice",
        "'N' as l_returnflag", "'O' as l_linestatus", "timestamp '1996-01-02 00:00:00' as l_shipdate",
    ).write.parquet(at("lineitem"))
    spark.range(20).selectExpr("id as o_orderkey", "id as o_custkey", "'O' as o_orderstatus", "'1-X' as o_orderpriority", "timestamp '1996-01-02 00:00:00' as o_orderdate").write.parquet(at("orders"))
    spark.range(5).selectExpr("id as s_suppkey", "concat('s', id) as s_name").write.parquet(at("supplier"))
    spark.range(5).selectExpr("id as p_partkey", "concat('p', id) as p_name", "'b' as p_brand", "'t' as p_type", "int(id) as p_size").write.parquet(at("part"))
    root = f"{shared_root(spark).removeprefix('file:')}/caselog"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    found = {r.kind: r.n_checks for r in QUERIES["star_checks"](spark, str(tmp_path)).collect()}
    assert found == {"unique": 11, "not_null": 33, "accepted": 3, "relationship": 4, "complete": 1, "children": 1, "grain": 1}
    made = {re.sub("-.*", "", d): d for d in set(os.listdir(root)) - before}
    assert sorted(made) == ["applications", "reports", "star", "stg_reports", "vocabulary"]
    for path in (made["stg_reports"], made["reports"], f"{made['star']}/fact_reactions"):
        assert any(f.endswith(".zstd.parquet") for f in os.listdir(f"{root}/{path}"))


def test_reports_logged_once_are_not_shuffled(spark, seed):
    tables = small_raw(spark, [*GOOD, report("a", "2")])
    plan = stage_reports(tables.reports, packed=True, apart=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and plan.index("LeftAnti") < plan.index("Window [") < plan.index("LeftSemi")
    assert sorted(map(str, build(tables, seed).staged.collect())) == sorted(map(str, stage_reports(tables.reports).collect()))


def test_reconcile_rows(spark):
    log = raw(
        spark,
        [{"application_number": "A1", "_batch_id": "1"}, {"application_number": "A2", "_batch_id": "1"}, {"application_number": "A1", "_batch_id": "2"}],
        schemas.APPLICATIONS,
    )
    row = profiles.reconcile_rows({"drugsfda": (log, stage_applications(log), "application_number")}).first()
    assert tuple(row) == ("drugsfda", 3, 2, 1, 2, -1, 1, 2)


def test_fact_and_dimensions_share_keys(spark, seed):
    react = reactions(stage_reports(raw(spark, GOOD, schemas.REPORTS)))
    fact = fact_reactions(react)
    assert checks.relationship(fact, "reaction_key", dim_reaction(react), "reaction_key").count() == 0
    assert checks.relationship(fact, "outcome_key", dim_outcome(seed), "outcome_key").count() == 0


def test_descriptors_without_position_stay(spark):
    rows = [("a", ["A01.10", "B"]), ("b", []), ("c", None), ("d", ["A01"])]
    df = spark.createDataFrame(rows, "descriptor_ui string, tree_numbers array<string>")
    got = {tuple(r) for r in relations.descriptor_ancestors(df).collect()}
    assert got == {
        ("a", "A01.10", "A01", 1, None), ("a", "A01.10", "A01.10", 2, "A01"), ("a", "B", "B", 1, None),
        ("b", None, None, None, None), ("c", None, None, None, None), ("d", "A01", "A01", 1, None),
    }
    counts = {(r["ancestor_number"], r["parent_number"]): r["n_descriptors"] for r in relations.descriptor_edges(df).collect()}
    assert counts == {("A01", None): 2, ("A01.10", "A01"): 1, ("B", None): 1, (None, None): 2}
    assert {r["ancestor_number"]: r["n_descriptors"] for r in relations.descriptor_hierarchy(df).collect()} == {"A01": 2, "A01.10": 1, "B": 1}
