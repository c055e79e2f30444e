"""SimHash near-duplicates by meeting in the middle.

Two fingerprints within distance 2r meet at a value within r of both. So every distinct fingerprint
emits all values within r of it, the values are shuffled, and the fingerprints that meet at one are
within 2r of each other. A bucket is never paired out: each of its members links to the smallest one,
which is enough for the components; the link's distance is verified. A bucket holds at most as many
distinct fingerprints as a ball has values (65 for r = 1), so no bucket is hot. Copies share a
fingerprint and are one node.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, row_key, table
from caselog.llm.shuffles import connected_components, lookup
from caselog.sources.storage import save

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, SEED, MAX_DISTANCE = 3, 42, 2


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of UTF-8 text; zero without words. bytes.lower and split know ASCII only."""
    words = text.lower().split()
    if not words:
        return 0
    grams = [words] if len(words) < shingle else zip(*(words[i:] for i in range(shingle)), strict=False)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(g), SEED) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start : start + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, k1, k2, fp) of every row: its `row_key` and its fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].cast(pa.binary())
            marks = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), dtype=np.uint64, count=len(texts))
            columns = [b["doc_id"], b["k1"], b["k2"], pa.array(marks.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "k1", "k2", "fp"])

    keys = row_key(F.col("doc_id"), F.col("text"))
    rows = docs.select("doc_id", keys[0].alias("k1"), keys[1].alias("k2"), or_empty(F.col("text")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, k1 bigint, k2 bigint, fp bigint")


def ball(fp: Column, radius: int) -> Column:
    """All values within the radius of a fingerprint, itself first."""
    values = F.array(fp)
    for _ in range(radius):
        values = F.array_distinct(
            F.flatten(
                F.transform(
                    values,
                    lambda x: F.concat(
                        F.array(x),
                        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: x.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))),
                    ),
                )
            )
        )
    return values


def links(fingerprints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (u, v) between distinct fingerprints `fp` that connect all pairs within the distance."""
    if max_distance % 2:
        raise ValueError("the distance must be even: two balls of half of it meet")
    met = fingerprints.select("fp", F.explode(ball(F.col("fp"), max_distance // 2)).alias("at"))
    least = met.withColumn("u", F.min("fp").over(Window.partitionBy("at"))).where("fp <> u")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("u"))) <= max_distance
    return least.where(near).select("u", F.col("fp").alias("v")).distinct()


def components(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """A table of (doc_id, k1, k2, fp, root, component_id): a row for each of the documents' rows.

    root is the smallest fingerprint of the component, and k1, k2 are `row_key` of the row.
    """
    rows = save(with_fingerprint(docs, shingle), "fingerprints")
    nodes = save(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = connected_components(links(nodes, max_distance)).withColumnRenamed("node", "fp")
    members = save(roots.join(nodes, "fp"), "members")
    least = members.groupBy("root").agg(F.min("first").alias("component_id"))
    merged = lookup(members, least, "root").select("fp", "root", "component_id")
    alone = nodes.join(members.select("fp"), "fp", "left_anti")
    alone = alone.select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    return lookup(rows, merged.unionByName(alone), "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row of (doc_id, text).

    component_id is the smallest doc_id among the rows reachable by links, the row's own included.
    Null and empty texts have fingerprint zero and link like any other; rows with a null id take
    part, but are never the smallest unless all are null. Repeated rows give repeated results.
    """
    return components(docs, shingle, max_distance).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest doc_id; null ids come last."""
    found = components(docs, shingle, max_distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2"))
    chosen = found.groupBy("root").agg(first.alias("at")).select(F.col("at.k1").alias("_k1"), F.col("at.k2").alias("_k2"))
    keys = row_key(F.col("doc_id"), F.col("text"))
    rows = docs.select(F.struct("*").alias("_row"), keys[0].alias("_k1"), keys[1].alias("_k2"))
    return rows.join(chosen, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
