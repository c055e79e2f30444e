"""Joins on keys of which a few may hold most rows, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselog.sources.storage import save

HOT_SHARE = 1_000


def lookup(rows: DataFrame, by_key: DataFrame, key: str) -> DataFrame:
    """Inner join of rows with a table of unique keys, safe against hot keys.

    A key of more than a thousandth of the rows is hot. There are fewer than 1,000 of them, whatever
    the data, so their entries are a broadcast of known size; the rows of all other keys are
    shuffled. `rows` is read three times and should be a table at rest.
    """
    total = rows.count()
    hot = rows.groupBy(key).count().where(F.col("count") * HOT_SHARE > total).select(key)
    entries = by_key.join(F.broadcast(hot), key, "left_semi")
    return rows.join(F.broadcast(entries), key).unionByName(
        rows.join(F.broadcast(hot), key, "left_anti").join(by_key, key).select(*rows.columns, *[c for c in by_key.columns if c != key])
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of the undirected links (u, v): root is the smallest node reachable.

    Each round lowers the parent of every node and of its parent to the least grandparent among the
    neighbours, and halves the paths; the rounds grow with the logarithm of the longest path. A round
    is written to the shared folder, so lineage stays short. Minima are combined in the map tasks, and
    popular parents are looked up by `lookup`. No links give no rows.
    """
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = save(both.where("u <> v").distinct(), "links")
    parents = save(
        edges.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("parent")), "parents"
    )
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        known = save(lookup(parents, above, "parent"), "grandparents")
        near = (
            edges.join(known.select(F.col("node").alias("v"), "grand"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("grand").alias("near"))
        )
        offers = known.join(near, "node").select(
            F.inline(
                F.array(
                    F.struct("node", F.least("near", "grand").alias("offer"), F.col("parent").alias("old")),
                    F.struct(F.col("parent").alias("node"), F.least("near", "grand").alias("offer"), F.lit(None).cast("bigint").alias("old")),
                )
            )
        )
        lowered = offers.groupBy("node").agg(F.min("offer").alias("offer"), F.max("old").alias("old"))
        lowered = save(lowered.select("node", F.least("offer", "old").alias("parent"), "old"), "parents")
        parents = lowered.select("node", "parent")
        if lowered.where("parent <> old").isEmpty():
            return parents.select("node", F.col("parent").alias("root"))
