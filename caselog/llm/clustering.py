"""Clusters of integer vectors around moving centroids, each vector placed by a tournament of bisectors.

The vectors nearer to centroid b than to a lie on one side of a plane. Its normal and threshold are integers,
computed once a round for each pair of centroids: v is nearer to b if v . 2(b - a) > |b|^2 - |a|^2. A vector
meets the centroids in their order; each sign test eliminates one of two, and zero, a tie, the one of
greater number. After k - 1 tests the winner is left, and the distance to it alone is computed.

Tasks add up their vectors by cluster before the shuffle, so what is shuffled and what reaches the driver is
k sums, whatever the number of vectors and however many are in one cluster.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm.common import or_empty, table
from caselog.sources.storage import save

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE, CLUSTERS, ROUNDS, SCALE = 64, 40, 5, 256
SEED = "2:"
#: Components of this absolute value or more don't have exact 64-bit distances.
LIMIT = 1 << 26


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        norms = (centroids**2).sum(axis=1)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = norms[None, :] - norms[:, None]

    def winners(self, vectors: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each vector, the smaller of equally near ones."""
        best = np.zeros(len(vectors), dtype=np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", vectors, self.normals[best, rival]) - self.thresholds[best, rival]
            best[side > 0] = rival
        return best

    def distances(self, vectors: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        return ((vectors - self.centroids[cluster]) ** 2).sum(axis=1)


def whole_vectors(rows: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors that are kept, their components as whole numbers."""
    parts = F.col("embedding").cast("array<double>")
    usable = (F.size(parts) == size) & F.forall(parts, lambda x: F.coalesce(F.abs(x * scale) < LIMIT, F.lit(False)))
    whole = F.transform(F.when(usable, parts), lambda x: F.floor(x * scale).cast("bigint"))
    return rows.where(usable).select("vec_id", whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: str = SEED) -> np.ndarray:
    """The k vectors whose ids have the least hashes, in their order; equal ids in the order of their vectors."""
    name = F.sha2(F.concat(F.lit(seed), or_empty(F.col("vec_id"))), 256)
    chosen = vectors.select("v", name.alias("name")).orderBy("name", "v").limit(k).select("v").toArrow()
    return np.array(chosen["v"].to_pylist(), dtype=np.int64)


def _matrix(b: pa.RecordBatch, size: int) -> np.ndarray:
    return b["v"].flatten().to_numpy().reshape(-1, size)


def sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, part, total): for each cluster the sum of its vectors' components, and as part -1 their number."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        totals = np.zeros((len(centroids), size + 1), dtype=np.int64)
        for b in batches:
            v = _matrix(b, size)
            cluster = bisectors.winners(v)
            np.add.at(totals, cluster, np.column_stack([np.ones(len(v), dtype=np.int64), v]))
        cluster, part = (x.ravel() for x in np.indices(totals.shape))
        some = totals[cluster, 0] > 0
        arrays = [pa.array(x[some]) for x in (cluster, part - 1, totals.ravel())]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "part", "total"])

    per_task = vectors.select("v").mapInArrow(run, "cluster bigint, part bigint, total bigint")
    return per_task.groupBy("cluster", "part").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of the means; empty ones stay."""
    totals = {(r.cluster, r.part): int(r.total) for r in sums(vectors, centroids).collect()}
    out = centroids.copy()
    for cluster in range(len(centroids)):
        if n := totals.get((cluster, -1)):
            out[cluster] = [totals[cluster, part] // n for part in range(centroids.shape[1])]
    return out


def placed(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        for b in batches:
            v = _matrix(b, size)
            cluster = bisectors.winners(v)
            arrays = [b["vec_id"], pa.array(cluster.astype(np.int32)), pa.array(bisectors.distances(v, cluster))]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> np.ndarray:
    """The centroids after some rounds; fewer than k if there are fewer vectors."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    return centroids


def _per_cluster(values: dict[int, object], cluster: Column, kind: str) -> Column:
    """A column of a value for each of the k clusters."""
    return F.element_at(F.lit([values.get(i) for i in range(max(values) + 1)]).cast(f"array<{kind}>"), cluster + 1)


def cluster(
    rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: str = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept row of (vec_id, embedding).

    Not kept are null vectors, those of another size or with null, NaN or infinite components, and those with
    whole components of 2**26 or more, whose distances don't fit 64 bits. Repeated rows and ids count as
    often as they occur; null ids are hashed as empty text. With fewer vectors than clusters each starts a
    cluster; no vectors give no rows. Inertias beyond 64 bits are null.
    """
    vectors = save(whole_vectors(rows, size, scale), "vectors")
    centroids = fit(vectors, k, rounds, seed)
    if not len(centroids):
        return vectors.select(
            "vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")))
        )
    found = save(placed(vectors, centroids), "clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).try_cast("bigint").alias("inertia")
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(total).collect()}
    whole = None if None in inertia.values() else sum(inertia.values())
    names = {i: sha256(",".join(map(str, c)).encode()).hexdigest() for i, c in enumerate(centroids.tolist())}
    return found.select(
        "vec_id", "cluster", "distance",
        _per_cluster(inertia, F.col("cluster"), "bigint").alias("cluster_inertia"),
        F.lit(whole).cast("bigint").alias("inertia"),
        _per_cluster(names, F.col("cluster"), "string").alias("centroid_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    steps = [
        f"""kept as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = {SIZE} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {SIZE}
),
c0 as materialized (
  select row_number() over (order by name) - 1 as cluster, v
  from (select v, sha256('{SEED}' || vec_id) as name from kept order by name limit {CLUSTERS})
)"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} as materialized (
  select k.vec_id, k.v, min(struct_pack(distance := list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))),
    cluster := c.cluster)) as best
  from kept k cross join c{i} c group by k.vec_id, k.v
)""")
        if i < ROUNDS:
            steps.append(f"""c{i + 1} as materialized (
  select c.cluster, coalesce(m.v, c.v) as v from c{i} c left join (
    select cluster, list(cast(floor((total - ((total % n) + n) % n) / n) as bigint) order by part) as v
    from (
      select best.cluster as cluster, part, cast(sum(x) as bigint) as total, count(*) as n
      from (select best, unnest(v) as x, unnest(range(1, {SIZE} + 1)) as part from a{i}) group by best.cluster, part
    ) group by cluster
  ) m on m.cluster = c.cluster
)""")
    return (
        "with "
        + ",\n".join(steps)
        + f"""
select a.vec_id, cast(a.best.cluster as integer) as cluster, cast(a.best.distance as bigint) as distance,
  cast(sum(a.best.distance) over (partition by a.best.cluster) as bigint) as cluster_inertia,
  cast(sum(a.best.distance) over () as bigint) as inertia,
  sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{ROUNDS} a join c{ROUNDS} c on c.cluster = a.best.cluster"""
    )


ORACLE = _oracle()
