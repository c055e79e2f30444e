"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def attach(fact: DataFrame, other: DataFrame, key: str | list[str]) -> DataFrame:
    """Inner join, many rows to one. Rows with a NULL key have no partner and are dropped."""
    return fact.join(other, on=key, how="inner")


def missing_from(parent: DataFrame, child: DataFrame, key: str, child_key: str | None = None) -> DataFrame:
    """Parent rows whose key no child row has.

    The child is reduced to its distinct keys first, so that a key with very many child rows is
    collapsed before the shuffle.
    """
    keys = child.select(F.col(child_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return parent.join(keys, on=key, how="left_anti")


def _width(field: T.StructField) -> Column:
    """Bytes of a value: of text and bytes their own, of nested values those of their JSON, else eight."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16
    return F.lit(8)


def sizes(frames: list[DataFrame]) -> list[tuple[int, int]]:
    """(rows, bytes) of each frame, found by one job. Each task measures its own rows, so only sums move."""
    rows = []
    for i, df in enumerate(frames):
        width = sum((_width(f) for f in df.schema.fields), F.lit(0)).cast("bigint")
        rows.append(df.select(width.alias("w")).agg(F.lit(i).alias("i"), F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("b")))
    return [(r.n, r.b) for r in sorted(reduce(DataFrame.unionByName, rows).collect())]


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the frame is small enough to broadcast, by its rows and by its bytes in memory."""
    return _fits(*sizes([df])[0], max_rows, max_bytes)


def _fits(rows: int, size: int, max_rows: int, max_bytes: int) -> bool:
    return rows <= max_rows and size <= max_bytes


@dataclass(frozen=True)
class Dimension:
    """A dimension, the fact's column that points to it, and its key column."""

    frame: DataFrame
    fact_key: str
    key: str


def attach_dimension(
    fact: DataFrame, dim: Dimension, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every row of a fact with the attributes of its dimension, NULL where it has no partner."""
    return star_join(fact, [dim], max_rows, max_bytes)


def star_join(
    fact: DataFrame, dims: list[Dimension], max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """All rows of the fact with the attributes of its dimensions; key columns keep the fact's names.

    A dimension of checked size, in rows and bytes, is broadcast; one job measures them all. A larger one is
    joined by a shuffle on the key, whose crowded partitions adaptive execution splits on the fact's side:
    the dimension has unique keys, so no row is repeated for the keys that aren't crowded.
    """
    keyed = [d.frame.withColumnRenamed(d.key, d.fact_key) if d.key != d.fact_key else d.frame for d in dims]
    for dim, frame, size in zip(dims, keyed, sizes(keyed), strict=True):
        fact = fact.join(F.broadcast(frame) if _fits(*size, max_rows, max_bytes) else frame, on=dim.fact_key, how="left")
    return fact


def cross_join_scalars(frames: list[DataFrame]) -> DataFrame:
    """Side by side columns of frames that have one row each (ungrouped aggregates).

    Each further frame is one scalar subquery, so no join runs, and a frame with a second row is an
    error.
    """
    wide = frames[0]
    for i, frame in enumerate(frames[1:]):
        row = frame.select(F.struct(*[F.col(c) for c in frame.columns]).alias("row")).scalar()
        wide = wide.withColumn(f"_row{i}", row)
    fields = [F.col(f"_row{i}.{c}") for i, frame in enumerate(frames[1:]) for c in frame.columns]
    return wide.select(*[F.col(c) for c in frames[0].columns], *fields)
