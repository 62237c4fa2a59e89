"""Exact integer k-means whose assignment is filtered by n-simplex projection.

Vectors become integers ``floor(256 x)``.  The squared distances of every
vector to a few pivots are computed once and stored.  From them alone a vector
gets apex coordinates over the simplex of the pivots: its place in the pivots'
span, by a triangular solve, and its altitude above it.  For two apexes the
planar distance with the difference (sum) of the altitudes is a lower (upper)
bound of the true distance, so a centroid whose lower bound exceeds the least
upper bound is out; the rest are compared by exact integer distances.

A round is one pass over the stored table.  Tasks add up their vectors by
cluster and send 40 x 64 sums, so no group of vectors ever meets in one task.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm.common import discard, stored, workspace

COMPONENTS, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
PIVOTS = 24
#: Rows with a component beyond this are compared in Python's integers, without bounds.
SAFE = 1 << 26
#: A pivot must stand this share of its distance above the ones before it; bounds give way by SLACK of the distances' scale.
STEEP, SLACK = 0.05, 1e-6
LIMB = 40
LONG = (1 << 63) - 1


class Simplex:
    """Apex coordinates of points over a simplex of pivots, from distances alone."""

    def __init__(self, points: list[list[int]], pivots: int = PIVOTS):
        self.pivots = np.array(points[:1], np.int64).reshape(-1, COMPONENTS)
        self.base = np.zeros((0, 0))
        for p in points[1:]:
            if len(self.pivots) >= pivots:
                break
            reach = self.reach(np.array([p], np.int64))
            apex = self.apex(reach)[0]
            if apex[-1] > STEEP * np.sqrt(float(reach[0, 0])) and apex[-1] > 0:
                grown = np.zeros((len(apex), len(apex)))
                grown[:-1, :-1], grown[-1] = self.base, apex
                self.base, self.pivots = grown, np.append(self.pivots, [p], axis=0)

    def reach(self, q: np.ndarray) -> np.ndarray:
        """Squared distances of points to the pivots."""
        return np.stack([((q - p) ** 2).sum(axis=1) for p in self.pivots], axis=1)

    def apex(self, reach: np.ndarray) -> np.ndarray:
        """Coordinates in the pivots' span, then the altitude above it."""
        s = reach.astype(np.float64)
        plane = np.linalg.solve(self.base, ((s[:, :1] + (self.base ** 2).sum(axis=1) - s[:, 1:]) / 2).T).T if len(self.base) else s[:, :0]
        return np.concatenate([plane, np.sqrt(np.maximum(s[:, 0] - (plane ** 2).sum(axis=1), 0))[:, None]], axis=1)

    @staticmethod
    def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared lower and upper bounds of the distances between apexes a and b, and the scale of their rounding."""
        x, y, h, g = a[:, :-1], b[:, :-1], a[:, -1:], b[:, -1]
        size = (a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1) + 1
        plane = np.maximum((x ** 2).sum(axis=1)[:, None] + (y ** 2).sum(axis=1) - 2 * x @ y.T, 0)
        return plane + (h - g) ** 2 - SLACK * size, plane + (h + g) ** 2 + SLACK * size


class Assigner:
    """Nearest centroid of integer vectors: bounds first, exact comparison of the rest."""

    def __init__(self, simplex: Simplex | None, centroids: list[list[int]]):
        self.centroids = centroids
        wide = max((abs(x) for c in centroids for x in c), default=0) > SAFE
        self.simplex = None if wide else simplex
        if self.simplex is not None:
            self.exact = np.array(centroids, np.int64)
            self.apexes = simplex.apex(simplex.reach(self.exact))

    def near(self, reach: np.ndarray) -> np.ndarray:
        """Which centroids the bounds leave open, for each vector."""
        low, high = Simplex.bounds(self.simplex.apex(reach), self.apexes)
        return low <= high.min(axis=1, keepdims=True)

    def assign(self, q: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid, the smaller number at ties."""
        best, dist = np.zeros(len(q), np.int64), np.full(len(q), LONG)
        near = self.near(reach)
        for j, c in enumerate(self.exact):
            rows = np.flatnonzero(near[:, j])
            d = ((q[rows] - c) ** 2).sum(axis=1)
            closer = d < dist[rows]
            best[rows[closer]], dist[rows[closer]] = j, d[closer]
        return best, dist

    def assign_wide(self, v: list[int]) -> tuple[int, int]:
        """The same for one vector in Python's integers."""
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(self.centroids))[::-1]


def integers(values) -> tuple[np.ndarray, np.ndarray]:
    """floor(256 x) of the flattened vectors, and which rows are too large for 64 bits throughout (zeros here)."""
    with np.errstate(over="ignore"):
        q = np.floor(np.asarray(values, np.float64).reshape(-1, COMPONENTS) * SCALE)
    wide = (np.abs(q) > SAFE).any(axis=1)
    return np.where(wide[:, None], 0, q).astype(np.int64), wide


def wide_integers(values) -> list[int]:
    return [floor(Fraction(float(x)) * SCALE) for x in values]


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding, in doubles, of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("embedding") == COMPONENTS) & fine)


def seeds(rows: DataFrame, salt: str, count: int) -> list[list[int]]:
    """Integer vectors of the smallest sha256 of ``salt`` and the vec_id; equal ids in order of their components."""
    first = rows.where("vec_id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256))
    got = first.orderBy("h", "embedding").limit(count).collect()  # ``count`` rows
    return [wide_integers(r["embedding"]) for r in got]


def _blocks(batch):
    """(first row, ids, flattened vectors) of a batch, some thousand rows at a time."""
    for at in range(0, batch.num_rows, 4096):
        part = batch.slice(at, 4096)
        yield part, part.column(1).flatten().to_numpy(zero_copy_only=False)


def _reach(simplex):
    def run(batches):
        for batch in batches:
            for part, values in _blocks(batch):
                q, wide = integers(values)
                reach = simplex.reach(q).tolist() if simplex else [[]] * len(q)
                reach = [None if w else r for r, w in zip(reach, wide)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(reach, pa.list_(pa.int64()))], names=["vec_id", "embedding", "reach"])
    return run


def _nearest(assigner, part, values):
    """(cluster, distance, integer vector) of each row; arrays for plain rows, lists of Python's integers for wide ones."""
    q, wide = integers(values)
    if assigner.simplex is None:
        wide[:] = True
    plain = np.flatnonzero(~wide)
    reach = part.column(2).take(pa.array(plain)).flatten().to_numpy(zero_copy_only=False).reshape(len(plain), -1) if len(plain) else None
    best, dist = assigner.assign(q[plain], reach) if len(plain) else (plain, plain)
    big = [(i, *assigner.assign_wide(v), v) for i in np.flatnonzero(wide).tolist()
           for v in [wide_integers(values[i * COMPONENTS:(i + 1) * COMPONENTS])]]
    return q, plain, best, dist, big


def limbs(value: int):
    """(position, signed part) of an integer to the base 2 ** LIMB: sums of parts fit a long."""
    k = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield k, value & ((1 << LIMB) - 1)
        value, k = value >> LIMB, k + 1
    yield k, value


def _sums(handle):
    """Per task: of each cluster the number of vectors (dim -1) and their sum, in limbs."""
    def run(batches):
        assigner = handle.value
        count, total = {}, {}
        for batch in batches:
            for part, values in _blocks(batch):
                q, plain, best, _, big = _nearest(assigner, part, values)
                for j in np.unique(best).tolist():
                    own = q[plain[best == j]]
                    count[j] = count.get(j, 0) + len(own)
                    total[j] = [a + b for a, b in zip(total.get(j, [0] * COMPONENTS), own.sum(axis=0).tolist())]
                for _, j, _, v in big:
                    count[j] = count.get(j, 0) + 1
                    total[j] = [a + b for a, b in zip(total.get(j, [0] * COMPONENTS), v)]
        rows = [(j, d, k, x) for j in sorted(count) for d, s in enumerate([count[j], *total[j]], -1) for k, x in limbs(s)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                             names=["cluster", "dim", "limb", "part"])
    return run


def _labels(handle):
    def run(batches):
        for batch in batches:
            for part, values in _blocks(batch):
                q, plain, best, dist, big = _nearest(handle.value, part, values)
                cluster, distance = [0] * part.num_rows, [0] * part.num_rows
                for i, j, d in zip(plain.tolist(), best.tolist(), dist.tolist()):
                    cluster[i], distance[i] = j, d
                for i, j, d, _ in big:
                    cluster[i], distance[i] = j, d if d <= LONG else None
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])
    return run


def cluster_vectors(spark: SparkSession, vectors: DataFrame, clusters: int = CENTROIDS, rounds: int = ROUNDS,
                    salt: str = "2:") -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids.

    Vectors take part that have 64 components, none null or non-finite; others,
    and null ones, do not.  Repeated rows are vectors each for itself, a null
    vec_id is clustered but never seeds.  With fewer vectors than clusters each
    seeds one; with none (an empty table) there is no row and no centroid.
    Equal distances go to the smaller number, an empty centroid stays.  A
    distance beyond 64 bits is compared exactly and returned as null.  Other
    columns are ignored.
    """
    folder = workspace(spark, "simplex")
    rows = kept(vectors)
    centroids = seeds(rows, salt, clusters)
    schema = "vec_id long, cluster int, distance long"
    if not centroids:
        return spark.createDataFrame([], schema), []
    small = [c for c in centroids if max(map(abs, c)) <= SAFE]
    simplex = Simplex(small) if small else None
    table = stored(rows.mapInArrow(_reach(simplex), "vec_id long, embedding array<double>, reach array<long>"), f"{folder}/reach")
    for _ in range(rounds):
        handle = spark.sparkContext.broadcast(Assigner(simplex, centroids))  # 40 centroids and 24 pivots
        parts = table.mapInArrow(_sums(handle), "cluster int, dim int, limb int, part long").groupBy("cluster", "dim", "limb").agg(F.sum("part").alias("part"))
        sums: dict = {}
        for r in parts.collect():  # at most 40 x 65 numbers, in limbs
            sums[r["cluster"], r["dim"]] = sums.get((r["cluster"], r["dim"]), 0) + (r["part"] << LIMB * r["limb"])
        centroids = [[sums[j, d] // sums[j, -1] for d in range(COMPONENTS)] if (j, -1) in sums else c for j, c in enumerate(centroids)]
    handle = spark.sparkContext.broadcast(Assigner(simplex, centroids))
    out = stored(table.mapInArrow(_labels(handle), schema), f"{folder}/labels")
    discard(spark, f"{folder}/reach")
    return out, centroids


def cluster_digest(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The rows of the registered query; an inertia beyond 64 bits, or over a null distance, is null."""
    labels, centroids = cluster_vectors(spark, vectors)
    sums = labels.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("lost")).collect()
    fits = lambda x: x if x is not None and x <= LONG else None
    own = {r["cluster"]: None if r["lost"] else int(r["s"]) for r in sums}  # a row per cluster
    total = None if None in own.values() else sum(own.values())
    digest = [(j, fits(own.get(j)), fits(total), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    info = spark.createDataFrame(digest, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return labels.join(F.broadcast(info), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


_Q = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"


def _assigned(i: int) -> str:
    return f"""a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := d, c := cluster)) AS best FROM (
    SELECT k.r, c.cluster, CAST(list_sum(list_transform(list_zip(k.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM k, c{i} c)
  GROUP BY r)"""


def _moved(i: int) -> str:
    return f"""s{i} AS (
  SELECT cluster, dim, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
    SELECT a.best.c AS cluster, unnest(k.q) AS x, generate_subscripts(k.q, 1) AS dim FROM a{i} a JOIN k USING (r)) GROUP BY cluster, dim),
m{i} AS (SELECT cluster, list((s - (((s % n) + n) % n)) // n ORDER BY dim) AS q FROM s{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN m{i} m USING (cluster))"""


CLUSTER_SQL = f"""WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, {_Q} AS q FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {COMPONENTS}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS INTEGER) AS cluster, q FROM k WHERE vec_id IS NOT NULL
  QUALIFY cluster < {CENTROIDS}),
{', '.join(f'{_assigned(i)}, {_moved(i)}' for i in range(ROUNDS))}, {_assigned(ROUNDS)},
own AS (SELECT best.c AS cluster, CAST(sum(best.d) AS BIGINT) AS cluster_inertia FROM a{ROUNDS} GROUP BY 1)
SELECT k.vec_id, a.best.c AS cluster, a.best.d AS distance, own.cluster_inertia, CAST((SELECT sum(cluster_inertia) FROM own) AS BIGINT) AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN k USING (r) JOIN own ON own.cluster = a.best.c JOIN c{ROUNDS} c ON c.cluster = a.best.c"""
