import hashlib
import random

import pytest
from pyspark.sql import functions as F

from caselog import functions as fn


def values(spark, column, inputs, type_="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, c {type_}")
    return [r[1] for r in df.select("i", column(F.col("c")).alias("v")).orderBy("i").collect()]


def text(dates):
    return [None if d is None else d.isoformat() for d in dates]


def test_partial_date(spark):
    got = values(
        spark,
        fn.partial_date,
        ["2024-03-05", "2024-03", "2024", None, "", "2024-02-30", "2024-13", "2024-3-5", " 2024-03", "2024-03-05T00"],
    )
    assert text(got) == ["2024-03-05", "2024-03-01", None, None, None, None, None, None, None, None]


def test_date_parsing_equals_the_formats(spark):
    rng = random.Random(1)
    pieces = ["2024", "1999", "0000", "0001", "-", "03", "12", "13", "3", "00", "31", "30", "+", " ", "T", "x", "\n", "٣"]
    inputs = ["".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(4000)]
    inputs += [f"{y:04d}-{m:02d}-{d:02d}" for y in (0, 1, 1500, 1582, 1900, 2024) for m in (1, 2, 10) for d in (1, 4, 10, 29, 31)]
    inputs += [f"{y:04d}{m:02d}{d:02d}" for y in (0, 1, 1500, 1582, 1900, 2024) for m in (1, 2, 10) for d in (1, 4, 10, 29, 31)]
    inputs += ["2024-03\n", "2024-03-05\n", "20240305\n", "+12024-03-05"]
    df = spark.createDataFrame([(x,) for x in inputs], "c string")
    c = F.col("c")
    by_format = F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "yyyy-MM"))
    wrong = df.select(
        c,
        fn.partial_date(c).cast("string").alias("p"),
        by_format.cast("string").alias("q"),
        fn.compact_date(c).cast("string").alias("r"),
        F.try_to_date(c, "yyyyMMdd").cast("string").alias("s"),
    ).where("not (p <=> q) or not (r <=> s)")
    assert wrong.collect() == []


def test_date_precision_describes_the_text(spark):
    assert values(spark, fn.date_precision, ["2024-03-05", "2024-03", "2024", None, ""]) == [
        "day",
        "month",
        "day",
        None,
        "day",
    ]


def test_compact_date(spark):
    got = values(spark, fn.compact_date, ["20240305", "20240230", "2024-03-05", "202403", None])
    assert text(got) == ["2024-03-05", None, None, None, None]


def test_version_is_a_number(spark):
    assert values(spark, fn.version_int, ["9", "103", None]) == [9, 103, None]
    assert values(spark, lambda c: fn.version_int(c, strict=False), ["9x"]) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, fn.version_int, ["9x"])


def test_pulled_at_is_utc(spark):
    df = spark.createDataFrame([("2026-01-05T06:00:00+02:00",)], "c string")
    assert df.select(fn.pulled_at(F.col("c")).cast("string")).first()[0] == "2026-01-05 04:00:00"


def test_texts(spark):
    assert values(spark, fn.key_prefix, ["NDA012", "012", "nda1", None]) == ["NDA", "", "", None]
    assert values(spark, lambda c: fn.clean_text(c, "X"), [" a b ", "   ", None, "\t"]) == ["A B", "X", "X", "\t"]
    assert values(spark, fn.clean_text, ["  "]) == [None]
    assert values(spark, fn.default_code, ["5", None, ""]) == ["5", "-1", ""]
    assert values(spark, fn.flag, ["1", "2", None]) == [True, False, False]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("~null~", 2), ("a||1", None)], "s string, n int")
    keys = [r[0] for r in df.select(fn.surrogate_key("s", "n")).collect()]
    assert keys[0] == hashlib.md5(b"a||1").hexdigest()
    # A missing value and its marker are one and the same key; the marker is part of the format.
    assert keys[1] == keys[2]
    assert keys[3] == hashlib.md5(b"a||1||~null~").hexdigest()


def test_calendar(spark):
    df = spark.createDataFrame([("2024-03-02",)], "d string").select(F.col("d").cast("date").alias("d"))
    row = df.select(*fn.calendar_columns(F.col("d"))).first().asDict()
    row["date_day"] = row["date_day"].isoformat()
    assert row == {
        "date_key": 20240302,
        "date_day": "2024-03-02",
        "year_number": 2024,
        "quarter_of_year": 1,
        "month_of_year": 3,
        "month_name": "March",
        "year_quarter": "2024-Q1",
        "day_of_week": 7,
        "day_name": "Saturday",
        "is_weekend": True,
    }


def test_arrays(spark):
    arrays = [["bb", "a", "c"], [], None, ["", "a"], ["bb", None, "a"], [None], [" x", "yy"]]
    assert values(spark, fn.shortest_variant, arrays, "array<string>") == ["a", None, None, "", "a", None, " x"]
    assert values(spark, fn.n_items, arrays[:3], "array<string>") == [3, 0, None]
    assert values(spark, fn.first_item, arrays[:3], "array<string>") == ["bb", None, None]
    assert values(spark, fn.has_no_items, arrays[:3], "array<string>") == [False, True, True]
    matched = values(spark, lambda c: fn.matching(c, lambda x: x == "a"), arrays[:5], "array<string>")
    assert matched == [["a"], [], None, ["a"], ["a"]]


def test_shortest_variant_equals_a_sort(spark):
    rng = random.Random(2)
    arrays = [["".join(rng.choices("ab ", k=rng.randint(0, 4))) for _ in range(rng.randint(0, 6))] for _ in range(2000)]
    expected = [min(a, key=lambda x: (len(x), x)) if a else None for a in arrays]
    assert values(spark, fn.shortest_variant, arrays, "array<string>") == expected
