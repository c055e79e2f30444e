"""Secret scans by corpus-wide ownership frequency.

High-recall patterns propose candidates. Each candidate's value is hashed, and the hash is counted over
the whole corpus: in how many repositories and of how many owners it occurs. A value that many share is
an example copied around; one that few owners have, and that looks random, is a live credential. In how
many of an owner's repositories it stands says nothing against it, as copies of a text do too. Base
spans stay whatever the verdict; candidates of the other patterns are added where they are live.

The first pass keeps candidates only, not texts; what is shuffled are hashes, pre-aggregated in the
map tasks, and hot hashes are looked up through a broadcast of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, row_key, sealed, table
from caselog.llm.shuffles import lookup
from caselog.llm.spans import add_matches, joined, redacted
from caselog.sources.storage import save

# The base kinds in their order, with their patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGNED = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{24,}+"
# Prefixes that common services give their keys, and the shapes of other credentials.
KEYED = r"(?<![A-Za-z0-9])(?:ghp_|gho_|ghs_|glpat-|xox[abprs]-|sk-|sk_live_|rk_live_|AIza|hf_|npm_)[A-Za-z0-9_-]{16,}+"
SIGNED = r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
LOGIN = r"(?<=://)[^\s:/@]{1,64}:[^\s/@]{6,64}(?=@)"
RANDOM = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}+={0,2}"
KINDS = ("assign", "access", "hex", "keyed", "signed", "login", "random")
BASE = 3

LIVE_OWNERS = 2
SPAN = "array<struct<start:bigint,ord:int,kind:string,end:bigint,value:string>>"


def looks_random(value: Column) -> Column:
    """Long, of at least two kinds of characters, and of many different ones for its length."""
    kinds = sum((value.rlike(c).cast("int") for c in ("[0-9]", "[a-z]", "[A-Z]")), F.lit(0))
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= 12) & (kinds >= 2) & (distinct >= F.least(F.length(value) / 3, F.lit(10)))


def candidates(docs: DataFrame, repository: str, owner: str) -> DataFrame:
    """A row for each document row: keys, repository, owner, and `spans`, its candidates in order."""
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    df = docs.select(
        "doc_id",
        k1.alias("k1"),
        k2.alias("k2"),
        or_empty(F.col(repository)).alias("repository"),
        or_empty(F.col(owner)).alias("owner"),
        or_empty(F.col("text")).alias("_t"),
    )
    t = F.col("_t")
    df = add_matches(df, "assign", ASSIGN, t.rlike(r"(?i)(?:passw|secret|token|api_?key)"))
    df = add_matches(df, "access", ACCESS, t.contains("AKIA"))
    df = add_matches(df, "hex", HEX, t.rlike("[0-9][0-9a-f]|[0-9a-f]{24}"))
    df = add_matches(df, "keyed", KEYED, t.rlike("_|-|AIza"))
    df = add_matches(df, "signed", SIGNED, t.contains("eyJ"))
    df = add_matches(df, "login", LOGIN, t.contains("://"))
    df = add_matches(df, "random", RANDOM)
    df = df.drop("_t")

    def spans(ord: int, kind: str) -> Column:
        found = F.col(kind)
        value = (lambda x: F.regexp_extract(x["match"], ASSIGNED, 1)) if kind == "assign" else (lambda x: x["match"])
        keep = {
            "assign": lambda x: F.length(x["value"]) >= 6,
            "access": lambda x: F.length(x["value"]) >= 20,
            "hex": lambda x: F.length(x["value"]) >= 24,
        }.get(kind, lambda x: looks_random(x["value"]))
        made = F.transform(
            found,
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(ord).alias("ord"), F.lit(kind).alias("kind"), x["end"].alias("end"), value(x).alias("value")
            ),
        ).cast(SPAN)
        return F.when(F.size(found) == 0, F.expr(f"cast(array() as {SPAN})")).otherwise(F.filter(made, keep))

    return df.select(
        "doc_id", "k1", "k2", "repository", "owner",
        F.sort_array(F.concat(*[spans(i, k) for i, k in enumerate(KINDS)])).alias("spans"),
    )


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners) over the candidates (hash, repository, owner), counted in steps
    that combine in the map tasks, so that a hash all documents share costs no more than others."""
    pairs = spans.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = pairs.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return owners.groupBy("hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """A row for each row of the documents: doc_id, k1, k2, `base` and `spans` in order, each span with
    n_repositories, n_owners and `live`; `spans` are the base ones and the live ones of other kinds.

    Null texts are empty; null repositories and owners are one of their own. Repeated rows count once in
    the frequencies and get the same result each.
    """
    rows = save(candidates(docs, repository, owner), "secret-candidates")
    values = rows.select("k1", "k2", "repository", "owner", F.explode("spans").alias("span"))
    values = save(values.withColumn("hash", F.sha2("span.value", 256)).withColumn("random", looks_random(F.col("span.value"))), "secret-values")
    seen = save(ownership(values), "secret-owners")
    known = lookup(values.distinct(), seen, "hash")
    live = (F.col("n_owners") <= LIVE_OWNERS) & F.col("random")
    judged = F.struct("span.start", "span.ord", "span.kind", "span.end", "n_repositories", "n_owners", live.alias("live"))
    by_row = known.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(judged)).alias("judged"))
    joined_rows = rows.select("doc_id", "k1", "k2").join(by_row, ["k1", "k2"], "left")
    empty = F.array().cast(by_row.schema["judged"].dataType)
    all_spans = joined_rows.withColumn("judged", F.coalesce("judged", empty))
    return all_spans.select(
        "doc_id", "k1", "k2",
        F.filter("judged", lambda x: x["ord"] < BASE).alias("base"),
        F.filter("judged", lambda x: (x["ord"] < BASE) | x["live"]).alias("spans"),
    )


def redact(docs: DataFrame, repository: str = "doc_id", owner: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """The documents with all their columns, every span in `text` replaced by the mark, and n_chars, if
    there is such a column, counted anew for the changed rows. No row is dropped."""
    found = scan(docs, repository, owner).select("k1", "k2", "spans").where(F.size("spans") > 0).dropDuplicates(["k1", "k2"])
    found = save(found, "secret-spans")
    k1, k2 = row_key(F.col("doc_id"), F.col("text"))
    columns = docs.columns
    rows = docs.select(F.struct("*").alias("_row"), k1.alias("k1"), k2.alias("k2")).join(found, ["k1", "k2"], "left")
    text = F.when(F.col("spans").isNull(), F.col("_row.text")).otherwise(redacted(F.col("_row.text"), F.col("spans"), mark))
    rows = sealed(rows.select("_row", "spans", text.alias("_text")))
    changed = {"text": F.col("_text")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("spans").isNull(), F.col("_row.n_chars")).otherwise(F.length("_text").cast(kind))
    return rows.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:BASE]],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["live"])).cast("bigint").alias("n_live"),
    )
