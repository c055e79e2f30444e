"""Manifest, selection, freshness and single checks, and the shape of plans."""

import pytest
from pyspark.sql import functions as F

from caselog.operators import aggregates, checks, fanout, joins
from caselog.operators.freshness import freshness, threshold_frame
from caselog.operators.joins import missing_from
from caselog.plans.intermediate import reactions, with_suspect
from caselog.plans.profiles import headline_outcomes
from caselog.plans.staging import stage_applications, stage_reports
from caselog.session import configure, in_bytes
from caselog.sources import manifest
from caselog.sources.selection import change_window, cohort


@pytest.fixture(scope="module")
def index(spark):
    files = [("2025q4", 1, 10), ("2025q4", 2, 20), ("2026q1", 1, 30), ("2026q2", 1, 40), ("2026q2", 2, 50), ("2026q2", 3, 60), ("2026q2", 4, 70)]
    rows = [(f"https://host/drug/event/{q}/part-{n:04d}.json.zip", r, "1.5") for q, n, r in files]
    rows.append(("https://host/drug/event/all_other/part-1.json.zip", 999, "9.0"))
    return spark.createDataFrame(rows, "file string, records bigint, size_mb string")


def test_plan_takes_the_newest_quarters(index):
    plan = manifest.plan_parts(index).collect()
    assert sorted((r.year, r.quarter, r.part_no, r.records) for r in plan) == [
        (2026, 1, 1, 30),
        (2026, 2, 1, 40),
        (2026, 2, 2, 50),
        (2026, 2, 3, 60),
    ]
    total = manifest.plan_totals(manifest.plan_parts(index)).first()
    assert tuple(total) == (4, 180, 6.0)
    assert [r.records for r in manifest.undated_parts(index).collect()] == [999]


def test_plan_takes_listed_quarters(index):
    assert {r.records for r in manifest.plan_parts(index, [(2025, 4)], parts=1).collect()} == {10}
    with pytest.raises(ValueError, match="2020q1"):
        manifest.plan_parts(index, [(2020, 1), (2025, 4)])


def test_reconcile(spark, index):
    plan = manifest.plan_parts(index)
    names = {r.records: r.file for r in plan.collect()}
    landed = spark.createDataFrame([(names[30],)] * 30 + [(names[40],)] * 39 + [("stray",)], "_source_file string")
    present = spark.createDataFrame([(names[50],)], "file string")
    result = manifest.reconcile_parts(plan, landed, present)
    assert {(r.records, r.written, r.status) for r in result.collect()} == {
        (30, 30, "ok"),
        (40, 39, "MISMATCH"),
        (50, None, "already present"),
        (60, 0, "MISMATCH"),
        (None, 1, "MISMATCH"),
    }
    assert tuple(manifest.reconcile_totals(result).first()) == (70, 50, 180, 3)


def test_change_window(spark):
    df = spark.createDataFrame([("2026-01-01",), ("2026-01-07",), ("2026-01-08",), (None,)], "t string").select(F.col("t").cast("date").alias("d"))
    assert change_window(df, "d", "2026-01-01", "2026-01-07").count() == 2
    assert change_window(df, "d", "2026-01-07").count() == 2
    assert change_window(df, "d", "2026-01-07", "MAX").count() == 2
    recent = spark.range(20).select(F.date_sub(F.current_date(), F.col("id").cast("int")).alias("d"))
    assert change_window(recent, "d").count() in (8, 9)


def test_cohort(spark):
    rows = [
        ("INTERVENTIONAL", ["PHASE2"], ["Lung Cancer"]),
        ("INTERVENTIONAL", ["PHASE1", "PHASE3"], ["x", "cancer of y"]),
        ("INTERVENTIONAL", ["PHASE1"], ["cancer"]),
        ("INTERVENTIONAL", None, ["cancer"]),
        ("OBSERVATIONAL", ["PHASE2"], ["cancer"]),
        ("INTERVENTIONAL", ["PHASE2"], ["asthma"]),
    ]
    df = spark.createDataFrame(rows, "study_type string, phases array<string>, conditions array<string>")
    assert cohort(df, "INTERVENTIONAL", ["PHASE2", "PHASE3"], "cancer").count() == 2


def test_freshness_levels(spark):
    def loaded(t):
        return spark.createDataFrame([(t,), ("2020-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("_loaded_at"))

    now = "2026-02-01 00:00:00"
    sources = {
        ("ctgov", "studies"): loaded("2026-01-31 11:00:00"),
        ("ctgov", "other"): loaded("2026-01-31 11:00:00"),
        ("faers", "events"): loaded("2025-01-01 00:00:00"),
        ("drugsfda", "applications"): loaded("2026-01-31 00:00:00").where("false"),
        ("mesh", "descriptors"): loaded("2000-01-01 00:00:00"),
    }
    got = {(r.source_name, r.table_name): r.status for r in freshness(sources, threshold_frame(spark), now).collect()}
    # The table's own limits beat its source's; a source that opted out is not listed.
    assert got == {
        ("ctgov", "studies"): "warn",
        ("ctgov", "other"): "pass",
        ("faers", "events"): "error",
        ("drugsfda", "applications"): "error",
    }


def test_single_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2)], "k string, n int")
    assert [tuple(r) for r in checks.unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in checks.not_null(df, ["k", "n"]).collect()] == [("k", 2)]
    assert [tuple(r) for r in checks.accepted_values(df, "k", ["b"]).collect()] == [("a", 2)]
    assert checks.accepted_values(df, "k", ["a"]).count() == 0
    assert checks.grain(df, ["k", "n"]).count() == 2
    parent = spark.createDataFrame([("b",)], "k string")
    assert [tuple(r) for r in checks.relationship(df, "k", parent, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in checks.completeness(parent, df, "k").collect()] == [("b",)]
    assert missing_from(parent, spark.createDataFrame([(None,)], "k string"), "k").count() == 1


def test_fan_out(spark):
    df = spark.createDataFrame([(1, ["x", None]), (2, []), (3, None)], "id int, a array<string>")
    assert {tuple(r) for r in fanout.fan_out(df, "a", "seq", "item").collect()} == {(1, 0, "x"), (1, 1, None)}
    outer = {tuple(r) for r in fanout.fan_out(df, "a", "seq", "item", outer=True).collect()}
    assert outer == {(1, 0, "x"), (1, 1, None), (2, None, None), (3, None, None)}


def test_recursive_sequence(spark):
    assert [r.n for r in fanout.recursive_sequence(spark, 5).orderBy("n").collect()] == [1, 2, 3, 4, 5]
    assert fanout.recursive_sequence(spark, 200).count() == 200


def test_distinct_per_group_counts_values_once_and_no_nulls(spark):
    rows = [("g", "a", True, False), ("g", "a", True, None), ("g", "b", None, None), ("g", None, True, True), ("h", "a", False, True), (None, "a", True, True)]
    df = spark.createDataFrame(rows, "g string, v string, x boolean, y boolean")
    got = aggregates.distinct_per_group(df, ["g"], F.col("v"), {"nx": F.col("x"), "ny": F.col("y")})
    assert {tuple(r) for r in got.collect()} == {("g", 1, 0), ("h", 0, 1), (None, 1, 1)}
    each = df.groupBy("g").agg(*[aggregates.distinct_when(F.col("v"), F.col(c)).alias(f"n{c}") for c in "xy"])
    assert {tuple(r) for r in each.collect()} == {tuple(r) for r in got.collect()}


# Plans, over raw logs at rest.


@pytest.fixture(scope="module")
def at_rest(spark, tmp_path_factory):
    from caselog.testbed.adapters import application_log, case_log

    root = tmp_path_factory.mktemp("rest")
    case_log(spark, "/root/testdata/sf0.001").write.parquet(str(root / "cases"))
    application_log(spark, "/root/testdata/sf0.001").write.partitionBy("_batch_id").parquet(str(root / "apps"))
    return str(root)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_headline_plan(spark, at_rest):
    plan = plan_of(headline_outcomes(reactions(stage_reports(spark.read.parquet(f"{at_rest}/cases")))))
    physical = plan[plan.index("== Physical Plan ==") :]
    # One scan of the fields in use, one shuffle by report, and one of the final row.
    assert physical.count("FileScan") == 1
    assert physical.count("Exchange hashpartitioning") == 1
    assert physical.count("Exchange SinglePartition") == 1
    assert physical.count("WindowGroupLimit") == 2
    assert "Cartesian" not in physical and "NestedLoop" not in physical
    assert "duplicate:string,patient:struct<reaction:" in physical


def test_attributed_reports_shuffle_no_drugs(spark, at_rest):
    log = spark.read.parquet(f"{at_rest}/cases")
    late, early = (reactions(stage_reports(log, derive=d)) for d in (None, with_suspect))
    physical = plan_of(early).split("== Physical Plan ==")[1]
    assert sorted(map(str, late.collect())) == sorted(map(str, early.collect()))
    assert physical.count("Exchange hashpartitioning") == 1
    # the drugs are used by the first projection above the scan, and by nothing after it
    sorted_rows = physical.index("WindowGroupLimit")
    assert "suspects" not in physical[:sorted_rows] and "drugcharacterization" not in physical[:sorted_rows]


def test_distinct_cases_copy_no_rows(spark, at_rest):
    react = reactions(stage_reports(spark.read.parquet(f"{at_rest}/cases"), derive=with_suspect))
    conditions = {"cases": ~F.col("is_probable_duplicate"), "fatal_cases": F.col("outcome_code") == "5"}
    plan = plan_of(aggregates.distinct_per_group(react, ["drug_name_source"], F.col("safety_report_id"), conditions))
    physical = plan.split("== Physical Plan ==")[1]
    assert "Expand" not in physical and physical.count("Exchange hashpartitioning") == 2


def test_splits_are_small_unless_set_smaller(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for given, want in (("128MB", 16 << 20), ("134217728b", 16 << 20), ("16m", 16 << 20), ("1m", 1 << 20), ("5000", 5000)):
            spark.conf.set(key, given)
            configure(spark)
            assert in_bytes(spark.conf.get(key)) == want
    finally:
        spark.conf.set(key, before)


def test_newest_batch_prunes_partitions(spark, at_rest):
    plan = plan_of(stage_applications(spark.read.parquet(f"{at_rest}/apps")))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "PartitionFilters: [isnotnull(_batch_id" in physical and "Subquery" in physical


def test_key_filter_reaches_the_scan(spark, at_rest):
    staged = stage_reports(spark.read.parquet(f"{at_rest}/cases")).where("safety_report_id = '7'")
    assert "EqualTo(safetyreportid,7)" in plan_of(staged.select("receive_date"))


def test_dimensions_are_broadcast_by_rows_and_bytes(spark):
    """Few rows may be wide: 300 of 400 kB are beyond the bound in bytes."""
    fact = spark.range(300).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    wide = spark.range(300).select(F.col("id").alias("k"), F.repeat(F.lit("é"), 200_000).alias("text"), F.array(F.col("id")).alias("ids"))
    narrow = wide.select("k", F.lit(None).cast("string").alias("text"))
    (rows, size), (_, little), (_, nested) = joins.sizes([wide, narrow, wide.select("ids")])
    assert rows == 300 and size > 300 * 400_000 and little == 300 * 24 and nested > 300 * 16
    assert joins.sizes([wide.limit(0)]) == [(0, 0)]
    assert not joins.is_small(wide) and joins.is_small(narrow) and not joins.is_small(narrow, max_rows=299)
    for dim, broadcast in ((wide, False), (narrow, True)):
        joined = joins.star_join(fact, [joins.Dimension(dim, "k", "k")])
        assert ("broadcast" in joined._jdf.queryExecution().optimizedPlan().toString()) == broadcast
        assert joined.count() == 300
