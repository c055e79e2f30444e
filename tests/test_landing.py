"""Landing, readers and sinks on files in a temporary folder."""

import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from caselog.operators.joins import is_small
from caselog.sources import readers, sinks, storage
from caselog.sources.schemas import DESCRIPTOR_XML, shape
from caselog.streaming.landing import land, landed
from caselog.testbed import landing as testbed_landing

SCHEMA = shape({"id": LongType(), "name": StringType()})


def write_gz(path, lines):
    path.parent.mkdir(exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


@pytest.fixture
def place(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")


def run(spark, place, run_id, **options):
    source, out, checkpoint = place
    land(spark, str(source), SCHEMA, out, checkpoint, glob="*.ndjson.gz", run_id=run_id, **options)
    return {(r.id, r._batch_id) for r in landed(spark, out, SCHEMA).collect()}


def test_each_file_lands_once(spark, place):
    source, out, _ = place
    write_gz(source / "a.ndjson.gz", [{"id": 1}, {"id": 2}])
    write_gz(source / "skipped.json.gz", [{"id": 99}])
    first = run(spark, place, "r1")
    assert first == {(1, "r1"), (2, "r1")}
    assert run(spark, place, "r2") == first
    # A late file, and one whose age is far beyond the newest seen.
    write_gz(source / "b.ndjson.gz", [{"id": 3}])
    write_gz(source / "old.ndjson.gz", [{"id": 4}])
    month_ago = time.time() - 30 * 86_400
    os.utime(source / "old.ndjson.gz", (month_ago, month_ago))
    assert run(spark, place, "r3") == first | {(3, "r3"), (4, "r3")}
    # A file rewritten in place keeps its path, and so is not read again.
    write_gz(source / "a.ndjson.gz", [{"id": 100}])
    assert run(spark, place, "r4") == first | {(3, "r3"), (4, "r3")}


def test_stamps_are_constant_over_the_batches_of_a_load(spark, place):
    source, out, _ = place
    for i in range(4):
        write_gz(source / f"f{i}.ndjson.gz", [{"id": i}])
    run(spark, place, None, files_per_batch=1)
    table = landed(spark, out, SCHEMA)
    row = table.agg(
        F.count("*"), F.countDistinct("_batch_id"), F.countDistinct("_loaded_at"), F.countDistinct("_source_file")
    ).first()
    assert tuple(row) == (4, 1, 1, 4)
    stamp = table.first()
    assert len(stamp._batch_id) == 14 and stamp._batch_id == table.select(F.date_format("_loaded_at", "yyyyMMddHHmmss")).first()[0]
    assert stamp._source_file.startswith("file:")


def test_corrupt_lines_land_as_flagged_rows(spark, place):
    source, out, _ = place
    write_gz(source / "a.ndjson.gz", [{"id": 1}, '{"id": 2', {"id": 3}])
    write_gz(source / "b.ndjson.gz", [{"id": 4}])
    run(spark, place, "r1")
    counts = readers.corrupt_rows(landed(spark, out, SCHEMA)).collect()
    assert sorted((os.path.basename(r._source_file), r.n_rows, r.n_corrupt) for r in counts) == [
        ("a.ndjson.gz", 3, 1),
        ("b.ndjson.gz", 1, 0),
    ]


def test_a_grown_schema_lands_in_the_same_table(spark, place):
    source, out, checkpoint = place
    write_gz(source / "a.ndjson.gz", [{"id": 1, "name": "n"}])
    run(spark, place, "r1")
    grown = shape({"id": LongType(), "name": StringType(), "tags": [StringType()]})
    write_gz(source / "b.ndjson.gz", [{"id": 2, "tags": ["t"]}])
    land(spark, str(source), grown, out, checkpoint, glob="*.ndjson.gz", run_id="r2")
    rows = landed(spark, out, grown).collect()
    assert {(r.id, r.name, tuple(r.tags or ()), r._batch_id) for r in rows} == {(1, "n", (), "r1"), (2, None, ("t",), "r2")}


def test_parquet_lands_under_its_declared_schema(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    spark.createDataFrame([(1, "a", 0.5)], "id bigint, name string, more double").write.parquet(source)
    for run_id in ("r1", "r2"):
        land(spark, source, SCHEMA, out, checkpoint, fmt="parquet", glob="*.parquet", run_id=run_id)
    table = landed(spark, out, SCHEMA, "parquet")
    assert [tuple(r) for r in table.select("id", "name", "_batch_id").collect()] == [(1, "a", "r1")]


def test_scan_keeps_undeclared_fields_out_and_missing_ones_null(spark, tmp_path):
    write_gz(tmp_path / "a.ndjson.gz", [{"id": 1, "extra": {"x": 1}}, {"name": "n"}])
    rows = readers.scan_ndjson(spark, str(tmp_path), SCHEMA).drop("_corrupt_record").collect()
    assert {tuple(r) for r in rows} == {(1, None), (None, "n")}


def test_schema_drift(spark, tmp_path):
    write_gz(tmp_path / "a.ndjson.gz", [{"id": 1}])
    write_gz(tmp_path / "b.ndjson.gz", [{"id": 1, "tags": [{"k": "v"}]}])
    drift = readers.schema_drift(spark, str(tmp_path), SCHEMA).collect()
    assert {tuple(r) for r in drift} == {("name", "string", None), ("tags[].k", None, "string")}


def test_schema_drift_of_parquet(spark, tmp_path):
    spark.range(1).select("id").write.mode("append").parquet(str(tmp_path / "p"))
    spark.range(1).select("id", F.lit("x").alias("more")).write.mode("append").parquet(str(tmp_path / "p"))
    drift = readers.schema_drift(spark, str(tmp_path / "p"), SCHEMA, "parquet")
    assert {tuple(r) for r in drift.collect()} == {("name", "string", None), ("more", None, "string")}


def test_seed_keeps_declared_types(spark, tmp_path):
    (tmp_path / "seed.csv").write_text('code,label\n1,"a, b"\n02,c\n')
    seed = readers.read_seed(spark, str(tmp_path / "seed.csv"), shape(("code", "label")))
    assert {tuple(r) for r in seed.collect()} == {("1", "a, b"), ("02", "c")}


def test_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"meta": {}, "results": [{"id": 1}, {"id": 2}]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"meta": {}, "results": []}))
    rows = readers.explode_envelope(spark, str(tmp_path), SCHEMA, "2026-01-01T00:00:00+00:00").collect()
    assert {(r.id, r._pulled_at) for r in rows} == {(1, "2026-01-01T00:00:00+00:00"), (2, "2026-01-01T00:00:00+00:00")}


def test_xml_without_a_list_gives_an_empty_array(spark, tmp_path):
    (tmp_path / "d.xml").write_text(
        """<?xml version="1.0"?><DescriptorRecordSet>
        <DescriptorRecord DescriptorClass="1"><DescriptorUI>D1</DescriptorUI>
          <DescriptorName><String>One</String></DescriptorName>
          <TreeNumberList><TreeNumber>C04.588</TreeNumber><TreeNumber>C04</TreeNumber></TreeNumberList>
          <ConceptList><Concept><ConceptName><String>not this</String></ConceptName></Concept></ConceptList>
        </DescriptorRecord>
        <DescriptorRecord><DescriptorUI>D2</DescriptorUI><DescriptorName><String>Two</String></DescriptorName>
        </DescriptorRecord></DescriptorRecordSet>"""
    )
    rows = readers.descriptors_from_xml(spark, str(tmp_path / "d.xml"), DESCRIPTOR_XML, "t").collect()
    assert {(r.descriptor_ui, r.descriptor_name, tuple(r.tree_numbers)) for r in rows} == {
        ("D1", "One", ("C04.588", "C04")),
        ("D2", "Two", ()),
    }


def test_partition_overwrite_is_null_safe(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, part string")
    sinks.overwrite_partitions(first, path, ["part"])
    second = spark.createDataFrame([(20, None), (10, "x")], "id int, part string")
    rows = sinks.overwrite_partitions(second, path, ["part"]).collect()
    assert {tuple(r) for r in rows} == {(10, "x"), (20, None), (3, "y")}


def test_clustered_files_hold_narrow_ranges(spark, tmp_path):
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 50)).alias("drug"))
    back = sinks.write_clustered(df, str(tmp_path / "c"), ["drug"], 8)
    files = back.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("drug").alias("lo"), F.max("drug").alias("hi"), F.count("*").alias("n")
    )
    spans = sorted((r.lo, r.hi, r.n) for r in files.collect())
    assert sum(s[2] for s in spans) == 4000
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    # Half of the rows have one value, which is cut over several files.
    assert len([s for s in spans if s[0] <= "hot" <= s[1]]) >= 3


def test_sinks_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b'), (2, None), (3, " s "), (4, "two\nlines")], "id int, t string")
    for write, name in ((sinks.write_csv, "csv"), (sinks.write_ndjson, "json"), (sinks.write_parquet, "pq")):
        assert {tuple(r) for r in write(df, str(tmp_path / name)).collect()} == {tuple(r) for r in df.collect()}
    assert sinks.preview(df, 2).count() == 2
    view = sinks.materialise(df, "v1")
    assert sinks.materialise(view, "t1", "table", str(tmp_path / "t1")).count() == 4
    with pytest.raises(ValueError, match="path"):
        sinks.materialise(df, "t2", "table")


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    root = storage.shared_root(spark)
    assert storage.shared_root(spark) == root
    path = storage.new_folder(spark, "x")
    assert path.startswith(root) and path != storage.new_folder(spark, "x")


def test_size_check(spark):
    assert is_small(spark.range(10), 10) and not is_small(spark.range(11), 10)


def test_xml_files_are_bounded(spark, tmp_path, monkeypatch):
    rows = [(k, f"name {k}", "TYPE", "Brand#1", k % 50) for k in range(1, 101)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_type string, p_brand string, p_size int").coalesce(1).write.parquet(
        str(tmp_path / "part.parquet")
    )
    folders = []
    monkeypatch.setattr(testbed_landing, "XML_RECORDS", 30)
    monkeypatch.setattr(testbed_landing, "new_folder", lambda spark, name: folders.append(str(tmp_path / f"{name}-{len(folders)}")) or folders[-1])
    got = testbed_landing.xml_records(spark, str(tmp_path)).collect()
    assert {r.descriptor_ui for r in got if r.pulled_at < "2026"} == {f"D{k:09d}" for k in range(1, 101)}
    counts = [f.read_text().count("<DescriptorRecord>") for f in (tmp_path / "xml-0").glob("part-*")]
    assert sum(counts) == 100 and max(counts) <= 30
