"""Ranked lexical search: bundles of items pass through the owners of their terms, one stage each.

1. Each document is tokenised once; its occurrences of the items' terms, its postings, are a table at rest.
2. The postings give each term's document frequency, weight and largest contribution to any score. Terms are
   dealt to OWNERS by weight, so that each owner has about as many postings, the first the rarest terms.
3. Documents are dealt to shards. A bundle of up to BUNDLE items visits every shard with an accumulator, the
   scores so far by item and document. At each stage it is cogrouped with the owner's postings of the shard,
   adds their contributions, and goes on to the next owner.
4. An accumulator stays sparse without loss: what the terms of later owners can still add to an item is known,
   so a document that can't reach the score of the TOP-th best of its shard any more is left out.
5. After the last owner the best of each shard and item are ranked.

Scores are whole numbers, so their order of addition doesn't matter.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, table
from caselog.sources.storage import save

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP, OWNERS = 50, 3
#: Items of a bundle, and documents of a shard, on average: together they bound a task's accumulators.
BUNDLE, SHARD = 256, 4096
#: Up to so many distinct terms of items go to the tokenising tasks; of more, all terms of documents are
#: kept and joined by a shuffle.
BROADCAST_TERMS, BROADCAST_BYTES = 100_000, 4_000_000
LENGTH_SHARE, FINE, TF = 50, 20, 1000
UNIT = 1_000_000_000

#: Bytes of terms as they are, A-Z in lower case, and all others as a space.
_TERMS = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of UTF-8 text, with repeats."""
    return text.translate(_TERMS).split()


def tokenised(docs: DataFrame, wanted: frozenset[bytes] | None) -> DataFrame:
    """(n, postings) beside the document's columns: its number of terms, and (term, tf) of each wanted one, of each if
    none are named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sizes, terms, counts = [], [0], [], []
            for value in b["text"].cast(pa.binary()):
                found = terms_of(value.as_py())
                n.append(len(found))
                tf = Counter(found)
                some = tf.keys() if wanted is None else tf.keys() & wanted
                terms += some
                counts += [tf[t] for t in some]
                sizes.append(len(terms))
            postings = pa.StructArray.from_arrays([pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["term", "tf"])
            arrays = [b["row"], b["doc_id"], pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), postings)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "n", "postings"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("row", "doc_id", "text").mapInArrow(run, f"row bigint, doc_id {kind}, n bigint, postings array<struct<term:string,tf:bigint>>")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each once: the rows of one item_id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, terms = [], []
            for i, value in enumerate(b["text"].cast(pa.binary())):
                found = sorted(set(terms_of(value.as_py())))
                ids += [i] * len(found)
                terms += found
            yield pa.RecordBatch.from_arrays([b["item_id"].take(pa.array(ids, pa.int64())), pa.array(terms, pa.binary()).cast(pa.string())], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", or_empty(F.col("text")).alias("text")).mapInArrow(run, f"item_id {kind}, term string").distinct()


def small_vocabulary(terms: DataFrame) -> frozenset[bytes] | None:
    """The distinct terms, if they are few enough for every task."""
    size = terms.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes")).first()
    if size["n"] > BROADCAST_TERMS or size["bytes"] > BROADCAST_BYTES:
        return None
    return frozenset(t.encode() for t in terms.toArrow()["term"].to_pylist())


def factor() -> Column:
    """What an occurrence count adds to a score per unit of weight, in a document of length m."""
    return F.expr(f"({UNIT}L * tf) div ({TF}L * tf + {FINE}L * m)")


def owner_starts(terms: DataFrame, owners: int) -> list[int]:
    """The least weight of each owner but the last. Weights are few numbers, as they grow with a logarithm."""
    volume = sorted(((r.w, int(r.df)) for r in terms.groupBy("w").agg(F.sum("df").alias("df")).collect()), reverse=True)
    total, done, starts = sum(df for _, df in volume), 0, []
    for w, df in volume:
        done += df
        while len(starts) < owners - 1 and done * owners >= total * (len(starts) + 1):
            starts.append(w)
    return starts


def weighed(postings: DataFrame, n_docs: int, owners: int) -> DataFrame:
    """(term, tid, w, most, owner) of the terms whose weight isn't zero; most bounds a contribution."""
    terms = postings.groupBy("term").agg(F.count("*").alias("df"), F.max(factor()).alias("most"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    terms = terms.withColumn("w", weight).where("w > 0").withColumn("tid", F.monotonically_increasing_id())
    terms = save(terms, "terms")
    owner = sum((F.when(F.col("w") < start, 1).otherwise(0) for start in owner_starts(terms, owners)), F.lit(0))
    return terms.select("term", "tid", "w", (F.col("w") * F.col("most")).alias("most"), owner.cast("int").alias("owner"))


_ACC = "array<struct<item:int,row:bigint,doc_id:bigint,score:bigint>>"
_STATE = f"bundle int, shard int, spec array<struct<item:int,tid:bigint,w:bigint,most:bigint,owner:int>>, acc {_ACC}"


def _one_list(fields: list[pa.Array], names: list[str]) -> pa.Array:
    """A column of one row: a list of structs of these fields."""
    return pa.ListArray.from_arrays(pa.array([0, len(fields[0])], pa.int32()), pa.StructArray.from_arrays(fields, names))


def added(state: pa.Table, postings: pa.Table, owner: int, top: int) -> pa.Table:
    """The bundle's accumulator after one owner: contributions added, hopeless documents left out."""
    spec = state["spec"].combine_chunks().flatten().flatten()
    item, tid, w, most, owners = (x.to_numpy() for x in spec)
    before = state["acc"].combine_chunks().flatten()
    row = np.concatenate([before.field("row").to_numpy(), postings["row"].to_numpy()])
    ids = pa.concat_arrays([before.field("doc_id"), *postings["doc_id"].chunks])
    row, first, at = np.unique(row, return_index=True, return_inverse=True)
    ids = ids.take(pa.array(first))
    old, new = at[: len(before)], at[len(before) :]
    items = np.unique(item)
    scores = np.zeros((len(items), len(row)), dtype=np.int64)
    scores[np.searchsorted(items, before.field("item").to_numpy()), old] = before.field("score").to_numpy()

    terms = postings["tid"].to_numpy()
    order = np.argsort(terms, kind="stable")
    terms, new, gain = terms[order], new[order], postings["gain"].to_numpy()[order]
    mine = np.flatnonzero(owners == owner)
    low, high = np.searchsorted(terms, tid[mine], "left"), np.searchsorted(terms, tid[mine], "right")
    for i, line, s, e in zip(mine, np.searchsorted(items, item[mine]), low, high, strict=True):
        scores[line, new[s:e]] += w[i] * gain[s:e]

    rest = np.zeros(len(items), dtype=np.int64)
    later = owners > owner
    np.add.at(rest, np.searchsorted(items, item[later]), most[later])
    known = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
    place = np.lexsort((row, known, ids.is_null().to_numpy(zero_copy_only=False)))
    kept = [np.zeros(0, dtype=np.int64)] * 2
    for line in range(len(items)):
        some = place[scores[line, place] > 0]
        if len(some) > top:
            values = scores[line, some]
            if rest[line]:
                bar = np.partition(values, len(values) - top)[len(values) - top]
                some = some[values + rest[line] >= bar]
            else:
                some = some[np.argsort(-values, kind="stable")[:top]]
        kept = [*kept, np.full(len(some), line), some]
    line, doc = np.concatenate(kept[0::2]), np.concatenate(kept[1::2])
    acc = [pa.array(items[line].astype(np.int32)), pa.array(row[doc]), ids.take(pa.array(doc)), pa.array(scores[line, doc])]
    return pa.table({
        "bundle": state["bundle"], "shard": state["shard"],
        "spec": _one_list(spec, ["item", "tid", "w", "most", "owner"]), "acc": _one_list(acc, ["item", "row", "doc_id", "score"]),
    })


def stage(state: DataFrame, postings: DataFrame, owner: int, top: int) -> DataFrame:
    """The accumulators cogrouped with one owner's postings, by bundle and shard."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return added(left, right, owner, top)

    key = ["bundle", "shard"]
    return state.groupBy(*key).cogroup(postings.groupBy(*key)).applyInArrow(run, _STATE)


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, bundle: int = BUNDLE, shard: int = SHARD
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `top` documents of score above zero; equal scores by ascending doc_id.

    Ids are whole numbers. Null and empty texts have no terms; items without any have no rows. Rows of one
    item_id, null included, are one item. Every row of documents is a document, so repeated ones are ranked one after the
    other; null ids come last among equal scores. No documents or no items give no rows.
    """
    bigint = F.col("doc_id").cast("bigint")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), bigint.alias("doc_id"), or_empty(F.col("text")).alias("text"))
    wanted = save(item_terms(items), "item-terms")
    vocabulary = wanted.select("term").distinct()
    found = save(tokenised(rows, known := small_vocabulary(vocabulary)), "postings")
    totals = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = int(totals["docs"]), max(int(totals["terms"]), 1)
    m = F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {n_docs}L) div {n_terms}L")
    postings = found.withColumn("m", m).select("row", "doc_id", "m", F.inline("postings"))
    if known is None:
        postings = postings.join(vocabulary, "term", "left_semi")
    terms = weighed(postings, n_docs, owners)

    n_items = wanted.select("item_id").distinct().count()
    n_bundles, n_shards = max(1, math.ceil(n_items / bundle)), max(1, math.ceil(n_docs / shard))
    numbered = wanted.select("item_id").distinct().withColumn("bundle", F.pmod(F.xxhash64("item_id"), F.lit(n_bundles)).cast("int"))
    numbered = save(numbered.withColumn("item", F.row_number().over(Window.partitionBy("bundle").orderBy("item_id")) - 1), "items")
    spec = wanted.withColumn("_id", F.struct("item_id")).join(numbered.select(F.struct("item_id").alias("_id"), "bundle", "item"), "_id").join(terms, "term")
    spec = save(spec.select("bundle", "item", "tid", "w", "most", "owner"), "item-weights")
    bundles = spec.groupBy("bundle").agg(F.collect_list(F.struct("item", "tid", "w", "most", "owner")).alias("spec"))
    shards = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))
    state = bundles.select("bundle", shards.alias("shard"), "spec", F.array().cast(_ACC).alias("acc"))
    owned = spec.select("tid", "bundle").distinct().groupBy("tid").agg(F.collect_list("bundle").alias("bundles")).join(terms.select("tid", "term", "owner"), "tid")
    owned = owned.select("term", "tid", "owner", "bundles")
    if known is not None:
        owned = F.broadcast(owned)
    dealt = postings.join(owned, "term").select(
        F.explode("bundles").alias("bundle"), F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int").alias("shard"), "row", "doc_id", "tid", factor().alias("gain"), "owner"
    )
    for owner in range(owners):
        state = stage(state, dealt.where(F.col("owner") == owner).drop("owner"), owner, top)
    best = state.select("bundle", F.inline("acc"))
    order = Window.partitionBy("bundle", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(numbered, ["bundle", "item"]).select("item_id", "rank", F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_MATCHES = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""
with texts as (select doc_id, {_MATCHES} as terms from documents),
totals as (select count(*) filter (len(terms) > 0) as docs, sum(len(terms)) as total from texts),
postings as (
  select doc_id, term, count(*) as tf, any_value(n) as n
  from (select doc_id, len(terms) as n, unnest(terms) as term from texts) group by doc_id, term
),
weights as (
  select term, cast(floor(1000 * ln((2 * any_value(t.docs) + 2) / (2 * count(*) + 1))) as bigint) as w
  from postings, totals t group by term
),
wanted as (select distinct item_id, unnest({_MATCHES}) as term from benchmark),
scores as (
  select i.item_id, p.doc_id,
    cast(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + cast((50 * p.n * t.docs) // t.total as bigint))))) as bigint) as score
  from wanted i join weights w on w.term = i.term join postings p on p.term = i.term, totals t
  group by i.item_id, p.doc_id
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scores where score > 0
qualify rank <= 50
"""
