"""Names within a bounded edit distance against all pairs, and the sizes of their blocks."""

import random

import pytest
from pyspark.sql import functions as F

from caselog.operators.similar import BLOCK, allowed_edits, registered_blocks, shared, within_edits
from caselog.plans.relations import NAME_PATHS, nearest_crosswalk, registered_names


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


@pytest.mark.parametrize("share", [2, 1000])
@pytest.mark.parametrize("most", [1, 2, 3])
def test_no_pair_is_lost(spark, share, most):
    rng = random.Random(most)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randrange(16)))
    left, right = {word() for _ in range(60)}, {word() for _ in range(60)} | {"é😀ab" * 3, "é😀a" * 3}
    left |= {"é😀ab" * 2 + "é😀a", ""}
    got = within_edits(frame(spark, left), frame(spark, right), allowed_edits(F.col("name"), 4, most), most, share)
    want = {(a, b, d) for a in left for b in right if 1 <= (d := distance(a, b)) <= min(most, len(a) // 4)}
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_crowded_blocks_are_split(spark):
    """A segment that all names share."""
    names = [f"HYDROCHLORIDE {i:05d}" for i in range(3000)]
    blocks = registered_blocks(frame(spark, names))
    crowded = shared(blocks, 100)
    assert crowded.agg(F.max("shares")).first()[0] >= 30
    one = F.coalesce("shares", F.lit(1))
    sizes = blocks.join(crowded, BLOCK, "left").groupBy(*BLOCK, F.pmod(F.xxhash64("name"), one)).count()
    assert sizes.agg(F.max("count")).first()[0] < 200
    got = within_edits(frame(spark, ["HYDROCHLORID 00007"]), frame(spark, names), share=100)
    assert {r.other for r in got.collect() if r.distance == 1} == {"HYDROCHLORIDE 00007"}


def test_names_of_applications(spark):
    schema = (
        "application_number string, products array<struct<brand_name string, active_ingredients array<struct<name string>>>>,"
        " openfda struct<brand_name array<string>, generic_name array<string>>"
    )
    rows = [
        ("A1", [(" brand one", [("salt",), (None,)]), ("Brand One ", [("SALT",)])], (["harm"], None)),
        ("A2", None, None),
        ("A3", [], ([], ["generic", ""])),
    ]
    df = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, registered_names(df).collect())) == [
        ("A1", "brand", "BRAND ONE"), ("A1", "harmonised", "HARM"), ("A1", "ingredient", "SALT"), ("A3", "harmonised", "GENERIC"),
    ]
    assert {r.source for r in registered_names(df.drop("openfda")).collect()} == {"brand", "ingredient"}
    assert set(NAME_PATHS.values()) == {"brand", "harmonised", "ingredient"}


def test_nearest_names_only_and_all_of_them(spark):
    names = spark.createDataFrame([("ASPIRIN PLUS",), ("ASPIRIN PLUS",), ("ASPIRIM PLUS",), ("NOTHING ALIKE",), (None,), ("AB",)], "drug_name string")
    registered = spark.createDataFrame(
        [("1", "brand", "ASPIRIN PLUS"), ("2", "ingredient", "ASPIRIN PLUS"), ("3", "brand", "ASPIRIN PLU"), ("4", "brand", "AC")],
        "application_number string, source string, drug_name string",
    )
    got = {(r.drug_name, r.application_number, r.distance) for r in nearest_crosswalk(names, registered).collect()}
    assert got == {
        ("ASPIRIN PLUS", "1", 0), ("ASPIRIN PLUS", "2", 0), ("ASPIRIM PLUS", "1", 1), ("ASPIRIM PLUS", "2", 1),
        ("NOTHING ALIKE", None, None), ("AB", None, None),
    }
