"""Quality rules: a table of thresholds compiled into one projection.

The measures are Spark expressions over the text; each rule is a measure with the range it must lie
in. Nothing is shuffled and no user function runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, sealed, staged, table, words

SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the four languages of the texts.
STOP_WORDS = (
    "the be to of and that have with is in it for "
    "der die das und ist nicht von mit den ein zu im "
    "le la les et est de des que un une en du "
    "el los las es del que por con una para y se"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if `low <= measure <= high`; a missing bound always holds."""

    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("n_words", low=50),
    Rule("100 * n_repeat_words / greatest(n_words, 1)", high=50),
    Rule("word_chars / greatest(n_words, 1)", low=2, high=14),
    Rule("n_symbols / greatest(n_words, 1)", high=0.1),
    Rule("n_shouts / greatest(n_words, 1)", high=0.3),
    Rule("n_stop_words / greatest(n_words, 1)", low=0.02),
    Rule("n_dup_lines / greatest(n_lines, 1)", high=0.5),
    Rule("n_bullet_lines / greatest(n_lines, 1)", high=0.9),
    Rule("n_ellipsis_lines / greatest(n_lines, 1)", high=0.3),
)

BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


PAIR = "struct<h:bigint,i:int>"


def repeated_at(hashes: Column, repeated: Column) -> Column:
    """Positions, in order, of those hashes that are in the list of repeated ones.

    A short list is searched for each position. For a long one, equal hashes are put side by side by
    a sort of (hash, position); the neighbours are compared through shifted copies. Both give the
    same positions.
    """
    searched = F.filter(
        F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i)), lambda i: i.isNotNull()
    )
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    neighbours = lambda p: F.zip_with(
        p,
        F.zip_with(
            F.concat(F.array(F.lit(None).cast(PAIR)), p),
            F.concat(F.slice(p, F.lit(2), F.size(p)), F.array(F.lit(None).cast(PAIR))),
            lambda before, after: F.struct(before["h"].alias("before"), after["h"].alias("after")),
        ),
        lambda x, n: F.when(F.equal_null(x["h"], n["before"]) | F.equal_null(x["h"], n["after"]), x["i"]),
    )
    sorted_at = F.aggregate(
        F.array(pairs),
        F.expr("cast(array() as array<int>)"),
        lambda _, p: F.sort_array(F.filter(neighbours(p), lambda i: i.isNotNull())),
    )
    return (
        F.when(F.size(repeated) == 0, F.expr("cast(array() as array<int>)"))
        .when(F.size(repeated) <= 32, searched)
        .otherwise(sorted_at)
    )


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures to the frame's rows; a null text has no words."""
    count = lambda array, test: F.size(F.filter(array, test)).cast("bigint")
    size = lambda array: F.size(array).cast("bigint")
    t = F.col("_t")
    df = staged(
        df,
        {"_t": or_empty(F.col(text))},
        {
            "_w": words(t),
            "_l": F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint"),
            "n_shouts": F.regexp_count(t, F.lit("!")).cast("bigint"),
        },
        {
            "n_words": size(F.col("_w")),
            "word_chars": F.length(F.array_join("_w", "")).cast("bigint"),
            "n_stop_words": count("_w", lambda w: F.lower(w).isin(STOP_WORDS)),
            "n_lines": size(F.col("_l")),
            "n_dup_lines": size(F.col("_l")) - size(F.array_distinct("_l")),
            "n_bullet_lines": count("_l", lambda x: F.ltrim(x).rlike(r"^[-*•]")),
            "n_ellipsis_lines": count("_l", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")),
            "_h": F.when(
                F.size("_w") >= 3,
                F.transform(
                    F.sequence(F.lit(0), F.size("_w") - 3),
                    lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)),
                ),
            ).otherwise(F.expr("cast(array() as array<bigint>)")),
        },
        {"_s": F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array("_h")).otherwise(F.expr("cast(array() as array<bigint>)"))},
        {
            "_r": F.array_distinct(
                F.filter(F.transform("_s", lambda h, i: F.when(h == F.get("_s", i - 1), h)), lambda h: h.isNotNull())
            )
        },
        {"_at": repeated_at(F.col("_h"), F.col("_r"))},
        {
            "n_repeat_words": F.aggregate(
                F.transform("_at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_at", i + 1) - p, F.lit(3)))),
                F.lit(0).cast("bigint"),
                lambda acc, x: acc + x,
            )
        },
    )
    return df.drop("_t", "_w", "_l", "_h", "_s", "_r", "_at")


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules as one condition over the measures."""
    parts = ["true"]
    for r in rules:
        parts += [f"{r.measure} >= {r.low}"] if r.low is not None else []
        parts += [f"{r.measure} <= {r.high}"] if r.high is not None else []
    return F.expr(" and ".join(f"({p})" for p in parts))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures and verdict of each row of (doc_id, text).

    Null and empty texts have no words and fail. Every row is judged by itself, so repeated rows and
    ids give repeated results; other columns of the input are ignored.
    """
    rows = measures(docs.select("doc_id", "text"))
    judged = rows.drop("text").withColumns({"base_failed": F.expr(BASE_FAILED)})
    return sealed(judged.withColumn("kept", ~F.col("base_failed") & compiled(rules)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))


def _condition() -> str:
    parts = []
    for r in RULES:
        parts += [f"({r.measure} >= {r.low})"] if r.low is not None else []
        parts += [f"({r.measure} <= {r.high})"] if r.high is not None else []
    return " and ".join(parts)


ORACLE = rf"""
with t as (
  select doc_id, coalesce(text, '') as t from documents
), w as (
  select doc_id, t,
    [x for x in string_split_regex(t, '[\x20\x09-\x0D]+') if x <> ''] as ws,
    [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls
  from t
), g as (
  select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as gram
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as n from g) where n > 1
), covered as (
  select doc_id, count(distinct i + k) as n from twice, range(3) as r(k) group by doc_id
), m as (
  select w.doc_id,
    len(ws) as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    length(t) - length(replace(t, '!', '')) as n_shouts,
    len([x for x in ws if lower(x) in ({", ".join(f"'{w}'" for w in STOP_WORDS)})]) as n_stop_words,
    len(ls) as n_lines,
    len(ls) - len(list_distinct(ls)) as n_dup_lines,
    len([x for x in ls if regexp_matches(ltrim(x, ' '), '^[-*\x{{2022}}]')]) as n_bullet_lines,
    len([x for x in ls if rtrim(x, ' ') like '%...' or rtrim(x, ' ') like '%' || chr(8230)]) as n_ellipsis_lines,
    coalesce(c.n, 0) as n_repeat_words
  from w left join covered c using (doc_id)
)
select *, {BASE_FAILED} as base_failed, not ({BASE_FAILED}) and {_condition()} as kept from m
"""
