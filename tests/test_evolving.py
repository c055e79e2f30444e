"""Landing into a growing table: its schema's versions, values that don't fit, retries, counts and ties."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from caselog.plans.staging import stage_descriptors
from caselog.sources.schemas import TEXT, shape
from caselog.streaming import evolving
from caselog.streaming.evolving import fields_of, grown, land_evolving, landed_evolving, recorded_counts, schema_versions
from caselog.streaming.landing import land, landed

DECLARED = shape({"id": TEXT, "n": LongType(), "parts": [("a",)]})


def lines(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))


def test_types_of_undeclared_fields(spark):
    records = [
        {"id": "a", "x": 1, "y": {"b c": [{"e": 1.5}], "OBJECT": None}, "z": [], "big": 10**30, "odd": 1},
        {"id": "b", "x": 2, "y": {"k": True}, "z": ["s"], "odd": "text"},
        "{broken",
    ]
    df = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")
    found = fields_of(df)
    want = "big string, id string, odd string, x bigint, y struct<`b c`: array<struct<e: double>>, k: boolean>, z array<string>"
    assert {f.name: f.dataType for f in found} == {f.name: f.dataType for f in StructType.fromDDL(want)}
    assert fields_of(df.limit(0)) == StructType() == fields_of(df.where("value = '{broken'"))


def test_known_fields_keep_their_types(spark):
    found = StructType.fromDDL("n string, parts array<struct<b bigint, a bigint>>, ID bigint, more double")
    assert grown(DECLARED, found) == StructType.fromDDL("id string, n bigint, parts array<struct<a string, b bigint>>, more double")


def test_rows_of_all_loads_under_the_newest_schema(spark, tmp_path):
    source, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    lines(tmp_path / "in", "a.json", {"id": "1", "n": 1, "parts": [{"a": "x"}]}, "{broken", {"id": "2", "n": "no number"}, "")
    land_evolving(spark, source, DECLARED, out, ck, run_id="r1")
    assert len(schema_versions(spark, ck)) == 1
    lines(tmp_path / "in", "b.json", {"id": "3", "parts": [{"a": "y", "b": 2}], "extra": {"k": 1}})
    lines(tmp_path / "in", "c.json", {"id": "4", "extra": {"k": 2, "l": ["m"]}})
    for run in ("r2", "r3"):
        land_evolving(spark, source, DECLARED, out, ck, run_id=run)
    lines(tmp_path / "in", "d.json", {"id": "5", "extra": {"k": "text"}})
    land_evolving(spark, source, DECLARED, out, ck, run_id="r4")
    rows = landed_evolving(spark, out, ck)
    got = {r.id or "broken": r.asDict(recursive=True) for r in rows.collect()}
    assert got["1"]["parts"] == [{"a": "x", "b": None}] and got["1"]["extra"] is None
    assert got["3"]["parts"] == [{"a": "y", "b": 2}] and got["3"]["extra"] == {"k": 1, "l": None}
    assert got["4"]["extra"] == {"k": 2, "l": ["m"]} and got["4"]["_corrupt_record"] is None
    assert got["broken"]["_corrupt_record"] == "{broken" and got["2"]["_corrupt_record"] == json.dumps({"id": "2", "n": "no number"})
    assert json.loads(got["5"]["_corrupt_record"])["extra"] == {"k": "text"}
    assert [len(v.fields) for v in schema_versions(spark, ck)] == [3, 4]
    assert "from_json" not in rows._jdf.queryExecution().toString()
    counts = {r[0].rsplit("/", 1)[1]: r[1] for r in recorded_counts(spark, out).collect()}
    assert counts == {"a.json": 3, "b.json": 1, "c.json": 1, "d.json": 1}
    scanned = rows.groupBy("_source_file").count()
    assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, recorded_counts(spark, out).collect()))


def test_a_batch_that_failed_is_landed_once(spark, tmp_path, monkeypatch):
    source, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    lines(tmp_path / "in", "a.json", {"id": "1", "new": 1}, {"id": "2"})
    rows_of = evolving._json_rows

    def broken(session, batch, checkpoint):
        rows_of(session, batch, checkpoint).write.mode("append").parquet(f"{out}/rows/_load=0")  # half a load
        raise RuntimeError("lost")

    monkeypatch.setattr(evolving, "_json_rows", broken)
    with pytest.raises(Exception, match="lost"):
        land_evolving(spark, source, DECLARED, out, ck)
    monkeypatch.undo()
    land_evolving(spark, source, DECLARED, out, ck)
    assert sorted((r.id, r.new) for r in landed_evolving(spark, out, ck).collect()) == [("1", 1), ("2", None)]
    assert len(schema_versions(spark, ck)) == 2


def test_parquet_is_landed_whole(spark, tmp_path):
    source, out, ck = (str(tmp_path / n) for n in ("in [1] {x}", "out", "ck"))
    declared = StructType.fromDDL("id bigint, n int")
    frames = [
        spark.createDataFrame([(1, 1), (2, None)], "id bigint, n int"),
        spark.createDataFrame([(3, "7", {"k": 1}), (4, "many", None)], "id bigint, n string, extra map<string, int>"),
        spark.createDataFrame([(5, 1 << 40, [(1, "a")])], "id bigint, n bigint, pairs array<struct<x int, y string>>"),
    ]
    escaped = source.replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}")
    for i, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(source)
        land_evolving(spark, escaped, declared, out, ck, "parquet", glob="*.parquet", run_id=str(i))
    rows = landed_evolving(spark, out, ck, "parquet").select("id", "n", "extra", "pairs", F.to_json("_rest").alias("rest"))
    assert sorted(map(tuple, rows.collect())) == [
        (1, 1, None, None, None),
        (2, None, None, None, None),
        (3, 7, {"k": 1}, None, None),
        (4, None, None, None, '{"n":"many"}'),
        (5, None, None, [(1, "a")], f'{{"n":{1 << 40}}}'),
    ]
    assert recorded_counts(spark, out).agg(F.sum("records")).first()[0] == 5


@pytest.mark.parametrize("grows", [False, True])
def test_ties_go_to_one_record_however_the_rows_lie(spark, tmp_path, grows):
    """Records of one key, pull time and file: the digest decides, and is the one column more that is read."""
    source, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = shape({"descriptor_ui": TEXT, "descriptor_name": TEXT, "tree_numbers": [TEXT], "_pulled_at": TEXT})
    same = {"descriptor_ui": "D1", "_pulled_at": "2026-01-05T06:00:00+00:00"}
    lines(tmp_path / "in", "a.json", *[same | {"descriptor_name": f"name {i}"} for i in range(20)])
    if grows:
        land_evolving(spark, source, schema, out, ck)
        raw = landed_evolving(spark, out, ck)
    else:
        land(spark, source, schema, out, ck)
        raw = landed(spark, out, schema)
    chosen = {stage_descriptors(raw.repartition(n, *by)).first().descriptor_name for n in (1, 3, 8) for by in ([], ["descriptor_name"])}
    turned = raw.orderBy(F.desc("descriptor_name")).coalesce(1)
    assert len(chosen | {stage_descriptors(turned).first().descriptor_name}) == 1
    plan = stage_descriptors(raw).select("descriptor_ui")._jdf.queryExecution().executedPlan().toString()
    read = plan.split("ReadSchema: ")[1]
    assert "_digest" in read and "tree_numbers" not in read and "descriptor_name" not in read
