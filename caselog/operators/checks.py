"""Data checks. Each returns its violations as rows; no rows means the check passed.

Every check first reduces the data per key (partial aggregation runs before the shuffle), so that
one value holding a large share of the rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselog.functions import has_no_items
from caselog.operators.joins import missing_from


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    value = F.col(col)
    return (
        df.where(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count("*").alias("n_rows"))
        .where("n_rows > 1")
    )


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns that hold NULLs, with the number of rows. One scan for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    cells: list[Column] = []
    for i, c in enumerate(cols):
        cells += [F.lit(c), F.col(f"n{i}")]
    return counts.select(F.stack(F.lit(len(cols)), *cells).alias("column_name", "n_rows")).where("n_rows > 0")


def accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Values outside the accepted list, with the number of rows; NULLs are left to not_null."""
    value = F.col(col)
    return (
        df.where(value.isNotNull() & ~value.isin(values))
        .groupBy(value.alias("value"))
        .agg(F.count("*").alias("n_rows"))
    )


def relationship(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a parent row, with the number of child rows."""
    used = (
        child.where(F.col(fk).isNotNull())
        .groupBy(F.col(fk).alias("value"))
        .agg(F.count("*").alias("n_rows"))
    )
    return missing_from(used, parent, "value", key)


def grain(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def completeness(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Parent keys that never reach the child."""
    return missing_from(parent.select(key), child, key)


def has_children(df: DataFrame, key: str, arr: str) -> DataFrame:
    """Keys of the rows whose array is NULL or empty."""
    return df.where(has_no_items(F.col(arr))).select(key)


def column_checks(df: DataFrame, key: str | None, cols: list[str], table: str) -> DataFrame:
    """not_null of the columns, and unique of the key if one is given, in a single pass: as
    (check_name, n_violations) rows.

    The rows are summed per key, then over keys; the fresh result of latest_per_key needs no
    further shuffle for that.
    """
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    if key is None:
        counts = df.agg(*nulls)
        cells: list[Column] = []
    else:
        per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), *nulls)
        repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1))
        sums = [F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(cols))]
        counts = per_key.agg(repeated.alias("n_repeated"), *sums)
        cells = [F.lit(f"unique {table}.{key}"), F.col("n_repeated")]
    for i, c in enumerate(cols):
        cells += [F.lit(f"not_null {table}.{c}"), F.col(f"n{i}")]
    return counts.select(F.stack(F.lit(len(cells) // 2), *cells).alias("check_name", "n_violations"))


def null_counts(table: str, cols: list[str]) -> dict[str, Column]:
    """The not_null checks of a table as aggregates, to be observed while it is written."""
    return {f"not_null {table}.{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in cols}


def unaccepted(col: str, values: list[str]) -> Column:
    """Rows whose value is outside the accepted list; none means that accepted_values finds nothing."""
    return F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(values))


def _dense(key: Column) -> Column:
    """Text as bytes that differ for different texts: a hash in lower-case hexadecimal takes 16 bytes, not 32."""
    text, plain, digest = key.cast("string"), key.cast("string").cast("binary"), F.unhex(key.cast("string"))
    is_hash = (F.octet_length(text) == 32) & (F.lower(F.hex(digest)) == text)
    # other texts never have 16 bytes
    longer = F.when(F.octet_length(text) < 16, plain).otherwise(F.concat(plain, F.lit(b"\0")))
    return F.when(is_hash, digest).otherwise(longer)


def key_checks(
    child: DataFrame, parents: dict[str, tuple[str, DataFrame, str]], unique_key: str, complete: dict[str, tuple[str, DataFrame]]
) -> DataFrame:
    """`relationship`, `unique` and `completeness` of one table in a single scan of it, as (check_name,
    n_violations) rows.

    parents: by check name the foreign key, its parent and the parent's key. complete: by check name the key
    and the parent all of whose keys must occur. All keys of the table are counted side by side, combined
    in the map tasks, and meet the parents' keys in one join. Keys are shuffled as bytes, hashes as half as many.
    """
    used = {**{name: fk for name, (fk, _, _) in parents.items()}, **{name: key for name, (key, _) in complete.items()}, "unique": unique_key}
    cells: list[Column] = []
    for name, col in used.items():
        cells += [F.lit(name), _dense(F.col(col))]
    keys = child.select(F.stack(F.lit(len(used)), *cells).alias("check", "key")).where("key is not null")
    counted = keys.groupBy("check", "key").agg(F.count("*").alias("n"))
    known = [df.select(F.lit(name).alias("check"), _dense(F.col(key)).alias("key")) for name, (_, df, key) in parents.items()]
    known += [df.select(F.lit(name).alias("check"), _dense(F.col(key)).alias("key")) for name, (key, df) in complete.items()]
    met = counted.join(union_all(known).withColumn("_parent", F.lit(True)), ["check", "key"], "full")
    alone = F.col("_parent").isNull()
    found = [F.count_if((F.col("check") == name) & alone) for name in parents]
    found += [F.count_if((F.col("check") == name) & F.col("n").isNull()) for name in complete]
    found.append(F.count_if((F.col("check") == "unique") & (F.col("n") > 1)))
    row = met.agg(*[c.alias(f"n{i}") for i, c in enumerate(found)])
    cells = []
    for i, name in enumerate([*parents, *complete, "unique"]):
        cells += [F.lit(name), F.col(f"n{i}")]
    return row.select(F.stack(F.lit(len(found)), *cells).alias("check_name", "n_violations"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union in halves: a chain of unions is analysed anew at each link."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionByName(union_all(frames[middle:]))


def summarise(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check: its name, and how many violations it found."""
    return union_all(
        [
            violations.agg(F.count("*").alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations")
            for name, violations in checks.items()
        ]
    )
