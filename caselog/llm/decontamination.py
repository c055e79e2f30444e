"""Benchmark decontamination by winnowing.

For windows of n words, k-grams of k = (n + 1) // 2 words are hashed, and each run of n - k + 1
consecutive k-grams keeps its least hash. A run spans n words, so texts that share n words share a
kept hash. The documents' kept hashes are joined with those of the test items; every hit is extended
word by word to both sides, and counts if it reaches n words, which also rules out hash collisions.
Items of fewer than `window` words are windows by themselves: each such length has its own n.

The items' hashes are broadcast if there are at most BROADCAST_HASHES of them, and the documents then
aren't shuffled; beyond that, hashes are joined by a shuffle and the documents that have a hit by
another. Everything is Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import LOWER, UPPER, ascii_lower, or_empty, row_key, table
from caselog.sources.storage import save

WINDOW = 13
BROADCAST_HASHES = 1_000_000
#: Runs of any characters but the ASCII ones that are neither letters nor digits. Those are listed one by one, as tasks
#: of one executor that search for negated ranges at the same time slow each other down, several times over.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
SHARE = 20


def shape(n: int) -> tuple[int, int]:
    """Words of a gram, and grams of which the least is kept, for windows of n words."""
    k = (n + 1) // 2
    return k, n - k + 1


def shifted(df: DataFrame, name: str, span: int, combine) -> DataFrame:
    """Replace an array by that of each `span` neighbours combined, doubling the span step by step."""
    done = 1
    while done < span:
        step = min(done, span - done)
        rest = F.greatest(F.size(name) - step, F.lit(0))
        df = df.withColumn(
            name, F.zip_with(F.slice(name, F.lit(1), rest), F.slice(name, F.lit(step + 1), rest), combine)
        )
        done += step
    return df


def winnowed(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add the words `_w`, per length n the gram hashes `_h{n}`, and `_runs` (n, start, end, hash): the
    windows from start to end whose least hash is that one.

    Explode `_runs` by the outer form only. For the inner one Spark would drop rows with empty arrays
    first, by a filter made of copies of all these expressions.
    """
    found = F.regexp_extract_all(or_empty(F.col("text")), F.lit(WORD), F.lit(0))
    df = df.withColumn("_found", found).withColumn("_w", F.transform("_found", ascii_lower)).drop("_found")
    df = df.withColumn("_g", F.transform("_w", lambda w: F.xxhash64(w)))
    for n in lengths:
        k, grams = shape(n)
        h, m, s = f"_h{n}", f"_m{n}", f"_s{n}"
        df = shifted(df.withColumn(h, F.col("_g")), h, k, lambda a, b: F.xxhash64(a, b))
        df = shifted(df.withColumn(m, F.col(h)), m, grams, lambda a, b: F.least(a, b))
        changes = F.transform(m, lambda x, i: F.when((i == 0) | (x != F.get(m, i - 1)), i))  # noqa: B023
        df = df.withColumn(s, F.filter(changes, lambda i: i.isNotNull()))
        df = df.withColumn(
            f"_r{n}",
            F.transform(
                s,
                lambda start, r: F.struct(
                    F.lit(n).alias("n"),  # noqa: B023
                    start.alias("start"),
                    (F.coalesce(F.get(s, r + 1), F.size(m)) - 1).alias("end"),  # noqa: B023
                    F.get(m, start).alias("hash"),  # noqa: B023
                ),
            ),
        ).drop(m, s)
    return df.withColumn("_runs", F.concat(*[F.col(f"_r{n}") for n in lengths])).drop("_g", *[f"_r{n}" for n in lengths])


def in_context(runs: DataFrame, lengths: list[int], *keep: str) -> DataFrame:
    """A row for each gram a run (n, start, end, hash) kept: its position, its words and those around
    it that a window can reach, the left ones backwards."""
    hashes = None
    for n in lengths:
        hashes = F.when(F.col("n") == n, F.col(f"_h{n}")) if hashes is None else hashes.when(F.col("n") == n, F.col(f"_h{n}"))
    runs = runs.withColumn("_h", hashes).withColumn("_k", ((F.col("n") + 1) / 2).cast("int"))
    runs = runs.withColumn("_reach", F.col("n") - F.col("_k"))
    positions = F.filter(
        F.sequence(F.col("start"), F.col("end") + F.col("_reach")), lambda p: F.get("_h", p) == F.col("hash")
    )
    at = runs.withColumn("pos", F.explode_outer(positions)).where("pos is not null")
    first = F.greatest(F.col("pos") - F.col("_reach"), F.lit(0))
    return at.select(
        *keep,
        "n",
        "hash",
        "pos",
        F.col("_k").alias("k"),
        F.reverse(F.slice("_w", first + 1, F.col("pos") - first)).alias("left"),
        F.slice("_w", F.col("pos") + 1, F.col("_k")).alias("gram"),
        F.slice("_w", F.col("pos") + F.col("_k") + 1, F.col("_reach")).alias("right"),
    )


def agreeing(a: Column, b: Column) -> Column:
    """Length of the common start of two short arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first_other = F.array_position(F.concat(same, F.array(F.lit(False))), F.lit(False))
    return (first_other - 1).cast("int")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k1, k2, n_hit, items): for the documents' rows, by `row_key`, that hold a window of an item, the
    number of words hit and the sorted ids, as text, of the items."""
    sized = items.select("item_id", "text", F.regexp_count(or_empty(F.col("text")), F.lit(WORD)).alias("_n"))
    sized = sized.where("_n > 0").withColumn("_n", F.least("_n", F.lit(window)))
    lengths = sorted(r[0] for r in sized.select("_n").distinct().collect())
    if not lengths:
        return docs.sparkSession.createDataFrame([], "k1 bigint, k2 bigint, n_hit bigint, items array<string>")
    runs = winnowed(sized, lengths).select("item_id", "_n", "_w", *[f"_h{n}" for n in lengths], F.inline_outer("_runs"))
    known = save(in_context(runs.where("n = _n"), lengths, "item_id"), "items")
    wanted = save(known.select("n", "hash").distinct(), "item-hashes")

    keys = row_key(F.col("doc_id"), F.col("text"))
    rows = docs.select(keys[0].alias("k1"), keys[1].alias("k2"), "text")

    def kept(source: DataFrame, *more: str) -> DataFrame:
        made = winnowed(source, lengths)
        return made.select("k1", "k2", "_w", *[f"_h{n}" for n in lengths], *more, F.inline_outer("_runs"))

    if wanted.count() <= BROADCAST_HASHES:
        found = kept(rows).join(F.broadcast(wanted), ["n", "hash"])
    else:
        met = kept(rows).select("k1", "k2", "n", "hash").join(wanted, ["n", "hash"])
        met = met.groupBy("k1", "k2").agg(F.collect_set(F.struct("n", "hash")).alias("_met"))
        again = rows.dropDuplicates(["k1", "k2"]).join(met, ["k1", "k2"])
        found = kept(again, "_met").where(F.array_contains("_met", F.struct("n", "hash")))
    here = in_context(found, lengths, "k1", "k2").distinct()
    there = known.select("item_id", "n", "hash", *[F.col(c).alias(f"_{c}") for c in ("left", "gram", "right")])
    reached = here.join(there, ["n", "hash"]).where("gram = _gram").select(
        "k1", "k2", "item_id", "n", "pos", "k",
        agreeing(F.col("left"), F.col("_left")).alias("l"),
        agreeing(F.col("right"), F.col("_right")).alias("r"),
    )
    span = F.struct((F.col("pos") - F.col("l")).alias("s"), F.expr("pos + k + r").alias("e"))
    item = F.col("item_id").cast("string").alias("item")
    spans = reached.where("l + k + r >= n").select("k1", "k2", item, span.alias("span"))
    merged = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["e"]).alias("end"),
            (acc["total"] + F.greatest(x["e"] - F.greatest(acc["end"], x["s"]), F.lit(0))).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    by_row = spans.groupBy("k1", "k2").agg(F.collect_set("span").alias("spans"), F.collect_set("item").alias("items"))
    return by_row.select("k1", "k2", merged.alias("n_hit"), F.sort_array("items").alias("items"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (n_hit * SHARE >= n_words)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hit words, items and verdict of each row of (doc_id, text), for items (item_id, text).

    Null and empty texts have no words and are never hit; items without words are no windows. Repeated
    rows get the same result each; items of equal text all count. Other columns play no part.
    """
    found = save(hits(docs, items, window), "hits")
    keys = row_key(F.col("doc_id"), F.col("text"))
    n_words = F.regexp_count(or_empty(F.col("text")), F.lit(WORD)).cast("bigint")
    rows = docs.select("doc_id", keys[0].alias("k1"), keys[1].alias("k2"), n_words.alias("n_words"))
    joined = rows.join(found, ["k1", "k2"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
    )
    return joined.withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows that aren't contaminated, with all their columns."""
    found = save(hits(docs, items, window).select("k1", "k2", "n_hit"), "hits")
    keys = row_key(F.col("doc_id"), F.col("text"))
    n_words = F.regexp_count(or_empty(F.col("text")), F.lit(WORD)).cast("bigint")
    rows = docs.select(F.struct("*").alias("_row"), keys[0].alias("k1"), keys[1].alias("k2"), n_words.alias("_n"))
    joined = rows.join(found, ["k1", "k2"], "left")
    clean = F.coalesce(~is_contaminated(F.col("n_hit"), F.col("_n")), F.lit(True))
    return joined.where(clean).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents
), b as (
  select item_id, ws, least({WINDOW}, len(ws)) as n
  from (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
        from benchmark)
  where len(ws) > 0
), bg as (
  select distinct item_id, n, array_to_string(ws[i:i + n - 1], ' ') as gram
  from (select item_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from b)
), dg as (
  select doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') as gram
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, (select distinct n from b))
), m as (
  select doc_id, item_id, n, i from dg join bg using (n, gram)
), h as (
  select doc_id, count(distinct i + k) as n_hit from m, range({WINDOW}) as r(k) where k < n group by doc_id
), t as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from m) group by doc_id
)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and {SHARE} * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""
