"""Regular-expression matches with their places, as Spark expressions.

Spark returns matches and the pieces between them, but no positions. Positions in code points are the
running sums of the lengths of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselog.llm.common import running_sum, staged

FOUND = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"


def add_matches(df: DataFrame, name: str, pattern: str, guard: Column | None = None, text: str = "_t", around: int = 24) -> DataFrame:
    """Add the leftmost non-overlapping matches as an array column: place, text, and up to `around`
    characters of the unmatched text on either side. Rows that fail the guard are not searched."""
    m, p, s = f"_{name}_m", f"_{name}_p", f"_{name}_s"
    t = F.col(text)
    none = F.expr("cast(array() as array<string>)")
    found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    return staged(
        df,
        {m: found if guard is None else F.when(guard, found).otherwise(none)},
        {p: F.when(F.size(m) > 0, F.split(t, pattern)).otherwise(none)},
        {s: running_sum(F.transform(m, lambda x, i: (F.length(F.get(p, i)) + F.length(x)).cast("bigint")))},
        {
            name: F.transform(
                m,
                lambda x, i: F.struct(
                    (F.get(s, i) + F.length(F.get(p, i))).alias("start"),
                    F.get(s, i + 1).alias("end"),
                    x.alias("match"),
                    F.right(F.get(p, i), F.lit(around)).alias("before"),
                    F.left(F.get(p, i + 1), F.lit(around)).alias("after"),
                ),
            ).cast(FOUND)
        },
    ).drop(m, p, s)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """The text with each run of overlapping spans replaced by the mark. `spans` are sorted by start."""
    merged = F.aggregate(
        spans,
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] < F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
        lambda acc: F.concat(
            F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"))),
            acc,
            F.array(F.struct(F.length(text).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"))),
        ),
    )
    kept = F.aggregate(
        F.array(merged),
        F.expr("cast(array() as array<string>)"),
        lambda _, spans: F.transform(
            F.slice(spans, F.lit(2), F.size(spans) - 1),
            lambda x, i: F.substring(text, (F.get(spans, i)["end"] + 1).cast("int"), (x["start"] - F.get(spans, i)["end"]).cast("int")),
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.array_join(kept, mark))
