"""Personal data by candidate gradient boosting.

Generators of high recall propose spans that may overlap: the base patterns, and looser forms of each
kind. Boosted trees judge a candidate by its format (digits, groups, length) and its context (the
characters around it, words such as "phone" or "order" before it).

There are no labels. The base spans, whose checks are strict, are the positives. Candidates that no address, card or
number of their kind can be, such as dates, failed checksums or a clock time, are the negatives. All others are
unlabelled: they train nothing, and are what the model is there to judge. Features are masked, so that a loose form
compares with the base form it stands for: "(at)" counts as "@", a plus sign with its country code and the checksum
aren't looked at, and addresses of either version are alike. A threshold by kind is calibrated on held-out documents to a given precision.
Base spans always stay; candidates that fail their check never pass.

The texts are read once; candidates are kept in a table without texts, and training reads counts of
feature vectors. No row is shuffled but those counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.boosting import fit, thresholds
from caselog.llm.common import or_empty, remainder, table
from caselog.llm.spans import add_matches, joined
from caselog.sources.storage import save

# The kinds in their order, with the base patterns. A base match starts where a run of its
# characters starts or the match before it ended, so no run is searched from each of its characters.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Looser forms.
AT = r"(?:\x20?(?:\(at\)|\[at\]|\{at\}|@)\x20?|\x20at\x20)"
DOT = r"(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)"
LOOSE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,8}}",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}::?){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])\(?[0-9][0-9\x20()./-]{5,18}[0-9](?![0-9])",
}
# Words before a candidate that speak for its kind, and those that speak for something else.
CUES = {
    "email": r"(?i)(?:mail|contact|write|reach)",
    "ip": r"(?i)(?:host|server|addr|ip|gateway|dns)",
    "card": r"(?i)(?:card|visa|credit|pay|master|amex)",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|dial|cell)",
}
CONTRARY = r"(?i)(?:order|isbn|issn|invoice|serial|ref|version|sku|item|doi|total|page|pages|year|id|no\.?|number|[$€£#_])[\x20:#.]{0,3}$"
# Runs of digits that are no phone numbers: dates, spans of years, decimals, dotted versions, fractions, ISBNs.
NO_PHONE = (
    r"^(?:[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{4}|[0-9]{2}))(?![0-9])",
    r"^[0-9]{4}\x20?[/-]\x20?[0-9]{4}$",
    r"^[0-9]+\.[0-9]+$",
    r"^[0-9]{1,3}(?:\.[0-9]{1,3}){2,3}$",
    r"^[1-9][0-9]*/[0-9]+$",
    r"^97[89][\x20-]?[0-9]",
    r"[\x20()./-][0-9](?:[\x20()./-]|$)",
    r"[\x20./-]{3}",
)
COUNTRY = r"^\+(?:[0-9]{1,3}(?=[^0-9])[^0-9]*)?"
PRECISION = 0.95
ROUNDS = 8
HELD_OUT = 5
SPAN = "struct<ord:int,start:bigint,end:bigint,kind:string>"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    places = F.sequence(F.lit(1), F.length(digits))
    backwards = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.transform(places, value), F.lit(0), lambda acc, x: acc + x) % 10 == 0


def strict(kind: str) -> Callable[[Column], Column]:
    """The base check of a kind, for a match."""
    return lambda x: valid(kind, x["match"])


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        short = lambda p: F.regexp_replace(p, "^0+", "")
        small = lambda p: (F.length(short(p)) < 3) | ((F.length(short(p)) == 3) & (short(p) <= "255"))
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def plausible(kind: str, x: Column) -> Column:
    """Whether a loose match can be of its kind at all. What can't is a negative."""
    match, before = x["match"], x["before"]
    count = lambda pattern: F.size(F.regexp_extract_all(match, F.lit(pattern), F.lit(0)))
    if kind == "email":
        words = match.rlike(r"^[^@(\[{]*\x20at\x20") & ~match.rlike(r"[\x20(\[{]dot[\x20)\]}]")
        return match.rlike("[A-Za-z]{2,24}$") & match.rlike("^[A-Za-z0-9]") & ~words
    if kind == "ip":
        groups, gaps = count("[0-9A-Fa-f]+"), count("::")
        return match.rlike("[0-9]") & (((gaps == 0) & (groups == 8)) | ((gaps == 1) & groups.between(3, 7)))
    if kind == "card":
        return F.when(F.length(_digits(match)).between(13, 19), luhn(_digits(match))).otherwise(False)
    cued = before.rlike(CUES["phone"])
    shaped = F.length(_digits(match)).between(7, 15) & (count(r"\(") == count(r"\)")) & (count("[0-9]+") <= 6)
    other = before.rlike(r"[\p{L}0-9]$") | before.rlike(CONTRARY) | x["after"].rlike(r"^(?:%|[0-9A-Za-z_])")
    return shaped & ~F.exists(F.array(*map(F.lit, NO_PHONE)), lambda p: F.regexp_like(match, p)) & (cued | ~(other | match.rlike("^[0-9]+$")))


def _class(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike("[0-9]"), 2).when(c.rlike(r"\p{L}"), 3).otherwise(4)


def _up_to(c: Column, *edges: int) -> Column:
    """Number of edges that the value reaches."""
    return sum(((c >= e).cast("int") for e in edges), F.lit(0))


def features(ord: int, x: Column) -> Column:
    """Small integers for the format and the context of a match, those of the format masked by kind."""
    kind, before, none = KINDS[ord], x["before"], F.lit(0)
    others = "|".join(c.removeprefix("(?i)") for k, c in CUES.items() if k != kind)
    cue = F.when(before.rlike(CUES[kind]), 1).when(before.rlike(CONTRARY), 3).when(before.rlike(f"(?i){others}"), 2).otherwise(0)
    form = [none, none, none, none]
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(x["match"], AT, "@"), DOT, ".")
        name, domain = F.substring_index(plain, "@", 1), F.substring_index(plain, "@", -1)
        top = F.substring_index(domain, ".", -1)
        form = [_up_to(F.length(name), 2, 4, 8, 16), _up_to(F.length(_digits(domain)), 1, 4), F.when(top.rlike("^[A-Za-z]{2,}$"), 1).otherwise(0), none]
    elif kind in ("card", "phone"):
        match = F.regexp_replace(x["match"], COUNTRY, "")
        groups = F.filter(F.split(match, "[^0-9]+"), lambda g: g != "")
        form = [
            _up_to(F.length(_digits(match)), 7, 9, 10, 11, 12, 13, 16, 17),
            _up_to(F.size(groups), 2, 3, 4, 5, 6),
            _up_to(F.length(F.element_at(groups, -1)), 2, 3, 4, 5),
            _up_to(F.array_max(F.transform(groups, F.length)), 3, 4, 5, 8),
        ]
    after, last = _class(F.left(x["after"], F.lit(1))), _class(F.right(F.regexp_replace(before, r"\+$", ""), F.lit(1)))
    return F.array(F.lit(ord), *form, last, after, cue)


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns, `base` (the base spans by kind and place) and `others`, the candidates that
    touch no base span of their kind; each with its features `bins` and `ok`, whether it can be of its kind.

    Base matches that fail their check, and what touches a base span of another kind, are among the others, not ok."""
    df = docs.select(*keep, or_empty(F.col("text")).alias("_t"))
    t = F.col("_t")
    digits = t.rlike("[0-9]")
    guards = {"email": t.contains("@"), "ip": t.rlike(r"[0-9]\.[0-9]"), "card": digits, "phone": t.contains("+")}
    loose_guards = {"email": t.rlike(r"@|[(\[{]at[)\]}]|\x20dot\x20"), "ip": t.rlike("[0-9A-Fa-f]::?[0-9A-Fa-f]"), "card": digits, "phone": digits}
    for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True):
        df = add_matches(df, kind, pattern, guards[kind])
        df = add_matches(df, f"{kind}_loose", LOOSE[kind], loose_guards[kind])
    df = df.drop("_t")
    some = f"array<struct<{SPAN[7:-1]},bins:array<int>,ok:boolean>>"
    none = F.expr(f"cast(array() as {some})")

    def spans(ord: int, column: str, ok) -> Column:
        found = F.col(column)
        place = lambda x: (F.lit(ord).alias("ord"), x["start"].alias("start"), x["end"].alias("end"))
        kind = F.lit(KINDS[ord]).alias("kind")
        made = F.transform(found, lambda x: F.struct(*place(x), kind, features(ord, x).alias("bins"), ok(x).alias("ok")))
        return F.when(F.size(found) == 0, none).otherwise(made.cast(some))

    plain = F.concat(*[spans(i, k, strict(k)) for i, k in enumerate(KINDS)])
    loose = F.concat(*[spans(i, f"{k}_loose", partial(plausible, k)) for i, k in enumerate(KINDS)])
    df = df.select(*keep, plain.alias("_plain"), loose.alias("_loose"))
    failed = F.filter("_plain", lambda x: ~x["ok"])
    df = df.select(*keep, F.filter("_plain", lambda x: x["ok"]).alias("base"), F.concat(failed, "_loose").alias("_others"))
    meets = lambda a, b: (b["start"] < a["end"]) & (a["start"] < b["end"])
    same = lambda a: F.exists("base", lambda b: (b["ord"] == a["ord"]) & meets(a, b))
    foreign = lambda a: F.exists("base", lambda b: (b["ord"] != a["ord"]) & meets(a, b))
    others = F.transform(F.filter("_others", lambda a: ~same(a)), lambda a: a.withField("ok", a["ok"] & ~foreign(a)))
    return df.select(*keep, "base", others.alias("others"))


def trained(rows: DataFrame) -> tuple:
    """The model and the thresholds by kind, from a table of candidates with their `_fold`; candidates
    that may be of their kind have no label and aren't read."""
    one = lambda c, label: F.transform(c, lambda x: F.struct(x["bins"].alias("bins"), F.lit(label).alias("label")))
    negative = F.filter("others", lambda x: ~x["ok"])
    seen = rows.select("_fold", F.explode(F.concat(one("base", 1), one(negative, 0))).alias("x"))
    counted = save(seen.groupBy("_fold", "x.bins", "x.label").agg(F.count("*").alias("n")), "pii-counts")
    model = fit(counted.where("_fold <> 0"), ROUNDS)
    return model, thresholds(counted.where("_fold = 0"), model, F.get("bins", F.lit(0)), PRECISION)


def find(docs: DataFrame) -> DataFrame:
    """A row for each row of (doc_id, text): doc_id, `base` and `spans`, sorted by kind and place.

    Null texts are empty; rows are searched each by itself, so repeated rows and null ids are no matter.
    A kind without base spans among the held-out documents has no threshold, and nothing is added to it.
    """
    fold = remainder(F.col("doc_id"), HELD_OUT).alias("_fold")
    rows = save(candidates(docs.select("doc_id", "text", fold), "doc_id", "_fold"), "pii-candidates")
    model, cuts = trained(rows)
    return rows.select("doc_id", *judged(model, cuts))


def judged(model, cuts: dict) -> list[Column]:
    score = lambda x: model.score(x["bins"])
    cut = lambda x: F.coalesce(*[F.when(x["ord"] == k, F.lit(v)) for k, v in sorted(cuts.items())], F.lit(2.0))
    added = F.filter("others", lambda x: x["ok"] & (F.round(score(x), 3) >= cut(x)))
    place = lambda x: F.struct(*(x[f].alias(f) for f in ("ord", "start", "end", "kind")))
    plain = lambda c: F.transform(c, place)
    return [plain("base").alias("base"), F.array_sort(plain(F.concat("base", added))).alias("spans")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
