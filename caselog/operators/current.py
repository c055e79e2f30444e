"""From an append-only log to current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(
    df: DataFrame,
    keys: str | list[str],
    order: list[Column],
    tiebreak: tuple[str, ...] = ("_source_file", "_digest"),
    content_tiebreak: bool = False,
    packed: tuple[str, ...] = (),
    apart: bool = False,
) -> DataFrame:
    """One row per key: the first by `order`, then by the tiebreak columns descending.

    Filtering the row number lets Spark keep only the first row per key in every map task before
    the shuffle, so a key with very many log rows costs one row per task.

    Landing stores a digest of each record, so rows that agree in the order and in the file are told apart
    by one narrow column. Rows without a digest can be told apart by content_tiebreak, a hash of the whole
    row. It is off by default, since it makes every column needed and so undoes column pruning.

    packed names columns that neither the keys nor the order use. They are sorted and shuffled as one JSON
    text, half as large as many small columns are. It makes all of them needed too, so it is for wide rows
    that are used as a whole. Their types may be text, integers and booleans, and arrays and structs of them.

    apart leaves rows whose key occurs once where they are: only rows of repeated keys are sorted and shuffled. The
    frame is read three times, once for its keys only, so it is for wide rows at rest.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if apart:
        marks = repeated_keys(df, keys)
        rest = latest_per_key(of_marked_keys(df, keys, marks), keys, order, tiebreak, content_tiebreak, packed)
        return of_marked_keys(df, keys, marks, marked=False).unionByName(rest)
    sort = list(order) + [F.col(c).desc() for c in tiebreak if c in df.columns]
    if content_tiebreak:
        sort.append(F.xxhash64(*[F.col(c) for c in df.columns]).desc())
    if packed:
        return _unpacked(latest_per_key(_packed(df, packed), keys, order, tiebreak, content_tiebreak), df.schema, packed)
    window = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


# A key's mark are three bits of one of 2^22 words, in rows of 64 words: 32 MB at most, however many keys there are.
_WORDS, _ROW_WORDS = 22, 6


def _shift(how: str, value: Column, n: Column | int) -> Column:
    return F.call_function(how, value, F.lit(n) if isinstance(n, int) else n)


def _low(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")).cast("int")


def _word_and_bits(key: Column) -> tuple[Column, Column]:
    bits = [_shift("shiftleft", F.lit(1).cast("bigint"), _low(_shift("shiftrightunsigned", key, i), 6)) for i in (0, 6, 12)]
    return _shift("shiftrightunsigned", key, 64 - _WORDS), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Marks of the keys with more than one row, NULL keys among them, as rows of `_words`. Another key may have the
    marks of repeated ones, so they tell for certain only which keys occur once. Keys are shuffled as hashes."""
    hashes = df.select(F.xxhash64(*keys).alias("hash")).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    word, bits = _word_and_bits(F.col("hash"))
    words = hashes.groupBy(word.alias("word")).agg(F.bit_or(bits).alias("bits"))
    rows = words.groupBy(_shift("shiftright", F.col("word"), _ROW_WORDS).alias("_row"))
    found = rows.agg(F.map_from_entries(F.collect_list(F.struct(_low(F.col("word"), _ROW_WORDS), "bits"))).alias("found"))
    every = F.sequence(F.lit(0), F.lit((1 << _ROW_WORDS) - 1))
    return found.select("_row", F.transform(every, lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0).cast("bigint"))).alias("_words"))


def of_marked_keys(df: DataFrame, keys: list[str], marks: DataFrame, marked: bool = True) -> DataFrame:
    """The rows whose keys have a mark of `repeated_keys`, or the others. The marks are broadcast."""
    word, bits = _word_and_bits(F.xxhash64(*keys))
    found = F.get("_words", _low(word, _ROW_WORDS)).bitwiseAND(bits) == bits
    same_row = _shift("shiftright", word, _ROW_WORDS) == F.col("_row")
    return df.join(F.broadcast(marks), same_row & found, "left_semi" if marked else "left_anti")


def _shortened(t: T.DataType) -> T.DataType:
    """The type with fields named by their places, all of which may be NULL."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f"{i:x}", _shortened(f.dataType)) for i, f in enumerate(t.fields)])
    return T.ArrayType(_shortened(t.elementType)) if isinstance(t, T.ArrayType) else t


def _nullable(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in t.fields])
    return T.ArrayType(_nullable(t.elementType)) if isinstance(t, T.ArrayType) else t


def _text_type(schema: T.StructType, names: tuple[str, ...]) -> T.StructType:
    return _shortened(T.StructType([schema[c] for c in names]))


def _packed(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    text = _text_type(df.schema, names)
    values = [F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(names, text.fields, strict=True)]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names], F.to_json(F.struct(*values)).alias("_packed"))


def _unpacked(df: DataFrame, schema: T.StructType, names: tuple[str, ...]) -> DataFrame:
    """The columns of the schema again. A generator parses the text once per row, whatever is selected of it."""
    rest = [c for c in df.columns if c != "_packed"]
    text = _text_type(schema, names)
    parsed = F.inline(F.array(F.from_json("_packed", text, {"mode": "FAILFAST"})))
    rows = df.select(*[F.col(f"`{c}`") for c in rest], parsed.alias(*[f"_packed_{f.name}" for f in text.fields]))
    place = {c: f"_packed_{f.name}" for c, f in zip(names, text.fields, strict=True)}
    return rows.select(
        *[F.col(f"`{f.name}`") if f.name in rest else F.col(place[f.name]).cast(_nullable(f.dataType)).alias(f.name) for f in schema.fields]
    )


def newest_batch(df: DataFrame, batch_col: str = "_batch_id") -> DataFrame:
    """Rows of the newest batch only, for a source that lands its whole catalogue every time.

    Keys missing from that batch have been withdrawn and vanish. Never use it on a source that
    lands changes only; that is what latest_per_key is for. The maximum is a scalar subquery over
    one column; on a table partitioned by the batch it also prunes the other partitions.
    """
    newest = df.select(F.col(batch_col).alias("_newest")).agg(F.max("_newest")).scalar()
    return df.where(F.col(batch_col) == newest)
