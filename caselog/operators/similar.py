"""Pairs of names within a bounded edit distance, by segments they share.

A name is cut into one segment more than edits are allowed. Edits change all segments but one at most, so
the other name has that one unchanged, shifted by no more than the number of edits. Segments are the blocks:
names meet by a join on equal segments, and only those that meet are compared. A block that many names
share is split into shares of bounded expected size; nothing is left out for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_EDITS = 2
SHARE = 200
#: What tells a block: the edits allowed, the registered name's length, which segment, and its text.
BLOCK = ["edits", "length", "part", "segment"]


def allowed_edits(name: Column, per_characters: int = 5, most: int = MAX_EDITS) -> Column:
    """One edit for so many characters, so short names must be equal."""
    return F.least(F.lit(most), F.floor(F.length(name) / per_characters)).cast("int")


def _start(length: Column, part: Column, parts: Column) -> Column:
    return F.floor(part * length / parts).cast("int")


def registered_blocks(names: DataFrame, most: int = MAX_EDITS) -> DataFrame:
    """(BLOCK, name): the segments of every name, for each number of edits."""
    edits = names.select("name", F.length("name").alias("length"), F.explode(F.sequence(F.lit(1), F.lit(most))).alias("edits"))
    parts = edits.select("*", F.explode(F.sequence(F.lit(0), F.col("edits"))).alias("part"))
    start = _start(F.col("length"), F.col("part"), F.col("edits") + 1)
    end = _start(F.col("length"), F.col("part") + 1, F.col("edits") + 1)
    return parts.select("edits", "length", "part", F.col("name").substr(start + 1, end - start).alias("segment"), "name")


def wanted_blocks(names: DataFrame, edits: Column) -> DataFrame:
    """(BLOCK, name): the substrings of every name that may be a segment of a name within its edits."""
    rows = names.select("name", edits.alias("edits")).where("edits > 0")
    near = F.sequence(F.greatest(F.lit(1), F.length("name") - F.col("edits")), F.length("name") + F.col("edits"))
    rows = rows.select("*", F.explode(near).alias("length"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("edits"))).alias("part"))
    start = _start(F.col("length"), F.col("part"), F.col("edits") + 1)
    size = _start(F.col("length"), F.col("part") + 1, F.col("edits") + 1) - start
    shifts = F.transform(F.sequence(-F.col("edits"), F.col("edits")), lambda s: start + s)
    fits = F.filter(shifts, lambda at: (at >= 0) & (at + size <= F.length("name")))
    texts = F.array_distinct(F.transform(fits, lambda at: F.col("name").substr(at + 1, size)))
    return rows.select("edits", "length", "part", F.explode(texts).alias("segment"), "name")


def shared(registered: DataFrame, share: int = SHARE) -> DataFrame:
    """(BLOCK, shares) of the blocks with more names than a share has."""
    return registered.groupBy(*BLOCK).count().where(F.col("count") > share).select(*BLOCK, F.ceil(F.col("count") / share).cast("int").alias("shares"))


def within_edits(left: DataFrame, right: DataFrame, edits: Column | None = None, most: int = MAX_EDITS, share: int = SHARE) -> DataFrame:
    """(name, other, distance): pairs of a left and a right name whose distance is one or more, and at most the
    left one's allowed edits. Both sides are distinct names; NULL matches nothing."""
    edits = allowed_edits(F.col("name"), most=most) if edits is None else edits
    here, there = wanted_blocks(left, edits), registered_blocks(right, most)
    crowded = shared(there, share)
    one = F.coalesce("shares", F.lit(1))
    here = here.join(crowded, BLOCK, "left").select(*BLOCK, "name", F.explode(F.sequence(F.lit(0), one - 1)).alias("share"))
    there = there.join(crowded, BLOCK, "left").select(
        *BLOCK, F.col("name").alias("other"), F.pmod(F.xxhash64("name"), one).cast("int").alias("share")
    )
    met = here.join(there, [*BLOCK, "share"]).where("name <> other")
    # a negative distance is one beyond the bound
    compared = met.withColumn("distance", F.when(F.col("edits") == 1, F.levenshtein("name", "other", 1)).otherwise(F.levenshtein("name", "other", most)))
    return compared.where("distance between 1 and edits").select("name", "other", "distance").distinct()
