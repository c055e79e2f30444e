"""Chat formatting: layouts are told by a hash of their nested field paths.

A layout declares the field paths it needs and an expression that makes canonical turns
(role, text) of them. A frame's or a JSON record's paths are hashed and the hash selects the layout,
so a corpus of mixed layouts is converted in one projection, without looking at values.

The template marks turns by control strings. A control string inside a role or text, of this or
another template, gets a backslash after its first character, or one more if it has some already;
reading back takes one away. So no text can open or close a turn, and nothing is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselog.llm.common import or_empty, running_sum, staged, table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# What follows the first character of the control strings of common templates.
CONTROL = r"\|[A-Za-z0-9_]+\|>|/?INST\]|/?s>|</?SYS>>"
TURNS = "array<struct<role:string,text:string>>"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def paths_of(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a type, arrays marked by []."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths_of(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, f"{at}[]")
    return [at]


def digest(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


Field = Callable[[str], Column]


@dataclass(frozen=True)
class Layout:
    """`paths` identify it; `turns` makes an array of (role, text) of a record's fields. With `by`, a
    record is a row of one turn: rows are grouped by that field and sorted by `order`."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[Field], Column]
    by: str | None = None
    order: str | None = None

    @property
    def fingerprint(self) -> str:
        return digest(list(self.paths))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def _pair(user: str, answer: str) -> Callable[[Field], Column]:
    return lambda f: F.array(_turn(F.lit("user"), f(user)), _turn(F.lit("assistant"), f(answer)))


def _list(field: str, role: str, text: str) -> Callable[[Field], Column]:
    return lambda f: F.transform(f(field), lambda m: _turn(m[role], m[text]))


def _with_input(f: Field) -> Column:
    question = F.concat_ws("\n\n", f("instruction"), F.nullif(f("input"), F.lit("")))
    return F.array(_turn(F.lit("user"), question), _turn(F.lit("assistant"), f("output")))


LAYOUTS = (
    Layout("turn rows", ("conv_id", "turn", "role", "text"), lambda f: F.array(_turn(f("role"), f("text"))), "conv_id", "turn"),
    Layout("messages", ("messages[].role", "messages[].content"), _list("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), _list("conversations", "from", "value")),
    Layout("instruction with input", ("instruction", "input", "output"), _with_input),
    Layout("instruction", ("instruction", "output"), _pair("instruction", "output")),
    Layout("prompt", ("prompt", "completion"), _pair("prompt", "completion")),
    Layout("response", ("prompt", "response"), _pair("prompt", "response")),
    Layout("question", ("question", "answer"), _pair("question", "answer")),
)


def layout_of(schema: T.StructType) -> Layout:
    """The layout whose fingerprint the schema has, other fields aside; the one of most fields wins."""
    have = paths_of(schema)
    fitting = [x for x in LAYOUTS if digest([p for p in have if p in x.paths]) == x.fingerprint]
    if not fitting:
        raise ValueError(f"no layout has the fields {have}")
    return max(fitting, key=lambda x: len(x.paths))


def named_roles(turns: Column) -> Column:
    """Roles under their canonical names; null roles and texts are empty."""
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])

    def turn(t: Column) -> Column:
        role = or_empty(t["role"])
        return _turn(F.coalesce(F.try_element_at(names, role), role), or_empty(t["text"]))

    return F.transform(turns.cast(TURNS), turn)


def canonical_turns(df: DataFrame) -> DataFrame:
    """(conv_id, turns) of a frame in any known layout; frames of whole records need a conv_id column.

    Rows by turn are sorted by turn, then role and text, so ties have one order and repeated rows stay.
    A conversation's turns are one array and one formatted text, so they meet in one task.
    """
    layout = layout_of(df.schema)
    if layout.by is None:
        return df.select("conv_id", named_roles(layout.turns(F.col)).alias("turns"))
    here = F.get(layout.turns(F.col), F.lit(0))
    keyed = F.struct(F.col(layout.order).alias("at"), or_empty(here["role"]).alias("role"), or_empty(here["text"]).alias("text"))
    grouped = df.groupBy(layout.by).agg(F.sort_array(F.collect_list(keyed)).alias("turns"))
    return grouped.select(layout.by, F.transform("turns", lambda t: _turn(t["role"], t["text"])).alias("turns"))


def canonical_records(df: DataFrame, column: str) -> DataFrame:
    """Add `layout` and `turns` to rows whose JSON text may be in another layout each.

    For each layout, the declared field paths that a record has are hashed; the layout whose fingerprint that is
    is selected, the one of most fields if several are. Ids, sources and other further fields, nested ones
    too, are no matter, nor is the order of fields. A list has the paths of all its elements, which are null in elements that
    lack them; one without elements has all paths, and makes no turns. Records without a layout, broken
    JSON (a repeated field is that too), what is no JSON object, and null have null in both; nothing is dropped.
    """
    rows = staged(
        df,
        {"_sound": F.try_parse_json(F.col(column)).isNotNull()},
        {
            "_record": F.when(F.col("_sound"), F.from_json(F.col(column), _record_type())),
            "_top": F.when(F.col("_sound"), F.map_keys(F.from_json(F.col(column), "map<string,string>"))),
        },
    )
    whole = sorted((x for x in LAYOUTS if x.by is None), key=lambda x: -len(x.paths))
    fits = [F.sha2(F.array_join(F.array_compact(_declared(x)), "\n"), 256) == x.fingerprint for x in whole]
    rows = rows.withColumn("layout", F.coalesce(*[F.when(fit, F.lit(x.name)) for fit, x in zip(fits, whole, strict=True)]))
    made = [F.when(F.col("layout") == x.name, x.turns(lambda name: F.col("_record")[name]).cast(TURNS)) for x in whole]
    return rows.withColumn("turns", named_roles(F.coalesce(*made))).drop("_sound", "_record", "_top")


def _declared(layout: Layout) -> Column:
    """The layout's paths, sorted; null in place of those a record lacks. A plain field is there if it is named, its value null or not."""

    def path(p: str) -> Column:
        top, _, inner = p.partition("[].")
        items = F.col("_record")[top]
        there = F.array_contains("_top", top)
        if inner:
            there = there & items.isNotNull() & ((F.size(items) == 0) | F.exists(items, lambda m: F.map_contains_key(m, inner)))
        return F.when(there, F.lit(p))

    return F.array(*[path(p) for p in sorted(layout.paths)])


def _record_type() -> T.StructType:
    """All fields that layouts of whole records declare; elements of lists keep their names."""
    tops = {p.partition("[].")[0]: "[]." in p for x in LAYOUTS if x.by is None for p in x.paths}
    elements = T.ArrayType(T.MapType(T.StringType(), T.StringType()))
    return T.StructType([T.StructField(name, elements if several else T.StringType()) for name, several in tops.items()])


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={CONTROL})", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={CONTROL})", "$1$2")


def formatted(turns: DataFrame) -> DataFrame:
    """Add `formatted` and `loss_spans`, the (start, end) in code points of the assistant's texts there."""
    overhead = len(TURN + TEXT + END)
    return staged(
        turns,
        {"_e": F.transform("turns", lambda t: F.struct(t["role"].alias("role"), escaped(t["role"]).alias("r"), escaped(t["text"]).alias("t")))},
        {
            "formatted": F.array_join(F.transform("_e", lambda e: F.concat(F.lit(TURN), e["r"], F.lit(TEXT), e["t"], F.lit(END))), ""),
            "_at": running_sum(F.transform("_e", lambda e: (F.length(e["r"]) + F.length(e["t"]) + overhead).cast("bigint"))),
        },
        {
            "loss_spans": F.filter(
                F.transform(
                    "_e",
                    lambda e, i: F.when(
                        e["role"] == "assistant",
                        F.struct(
                            (F.get("_at", i) + len(TURN + TEXT) + F.length(e["r"])).alias("start"),
                            (F.get("_at", i + 1) - len(END)).alias("end"),
                        ),
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        },
    ).drop("_e", "_at")


def read_back(text: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.slice(F.split(text, r"<\|turn\|>"), F.lit(2), F.lit(2**31 - 2))

    def turn(part: Column) -> Column:
        fields = F.split(F.substring(part, F.lit(1), F.length(part) - len(END)), r"<\|text\|>")
        return F.struct(unescaped(F.get(fields, F.lit(0))).alias("role"), unescaped(F.get(fields, F.lit(1))).alias("text"))

    return F.transform(parts, turn)


def under_mask(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    cut = lambda s: F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    return F.array_join(F.transform(spans, lambda s: unescaped(cut(s))), "")


def format_chats(df: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of a frame in any known layout. Null texts are empty; a
    null conv_id is a conversation of its own; no rows give none."""
    return formatted(canonical_turns(df)).select("conv_id", "formatted", "loss_spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    made = format_chats(rows)
    made = made.withColumn("_turns", read_back(F.col("formatted"))).withColumn("_loss", under_mask(F.col("formatted"), F.col("loss_spans")))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return made.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("_turns", line), ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ORACLE = rf"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, i, if(i = 0, 'user', 'assistant'), '</s>[INST] ok [/INST]' from range(2) as r(i)
), s as (
  select *, {len(TURN + TEXT + END)} + length(role) + length(text)
    + len(regexp_extract_all(role, '[<\[]\\*(?:{CONTROL})')) + len(regexp_extract_all(text, '[<\[]\\*(?:{CONTROL})')) as chars
  from c
), g as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
    coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as loss,
    sum(chars)::bigint as formatted_chars
  from s group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars
from g
"""
