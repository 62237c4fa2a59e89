"""Approximate nearest neighbours by inner product: probed lists scanned by adaptive dimensions.

Inner product is turned into distance by one more coordinate that gives every
vector the same norm.  Vectors fall into lists around k-means centres of a
bounded sample; a query scans the lists of its nearest centres.  Vectors are
rotated at random, so that a block of columns is a fair sample of the whole
distance: after each block of columns a hypothesis test abandons candidates
whose partial distance is too large for the query's current k-th best.
Survivors are scored exactly, in double precision, on the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from gridlens.llm.common import stored, workspace

#: Vectors the centres are learned from, at most.
SAMPLE = 16_384
MAX_LISTS = 2048
#: Share of the lists that a query scans, and at least so many.
PROBE_SHARE, MIN_PROBES = 0.6, 16
#: A query goes on to further lists until they hold so many candidates for each neighbour asked for, in a table of any size.
DEPTH = 100
#: Columns of a block, and the strictness of the abandoning test.
BLOCK_COLUMNS, EPSILON = 16, 2.1
#: Candidates and queries that meet in one task: small lists share a group, a large list is dealt into parts.
GROUP_ROWS, GROUP_QUERIES, BATCH_QUERIES = 8192, 2048, 64
SEED = 5


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres, 1)[:, 0]
        sums = np.zeros_like(centres, dtype=np.float64)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres).astype(np.float32)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` nearest centres of each row, nearest first, in blocks of rows."""
    half = 0.5 * (centres * centres).sum(axis=1)
    out = []
    for i in range(0, len(x), 4096):
        d = half - x[i:i + 4096] @ centres.T
        if k == 1:
            out.append(d.argmin(axis=1)[:, None])
            continue
        part = np.argpartition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else np.tile(np.arange(d.shape[1]), (len(d), 1))
        out.append(np.take_along_axis(part, np.take_along_axis(d, part, 1).argsort(axis=1, kind="stable"), 1))
    return np.concatenate(out) if out else np.zeros((0, k), np.int64)


def lift(x: np.ndarray, norm2: float) -> np.ndarray:
    """Vectors with one more coordinate, so that all have squared norm ``norm2``."""
    rest = np.sqrt(np.maximum(norm2 - (x.astype(np.float64) ** 2).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None].astype(np.float32)], axis=1)


def adaptive_scan(queries: np.ndarray, cands: np.ndarray, k: int, probed: np.ndarray | None = None, block: int = BLOCK_COLUMNS, epsilon: float = EPSILON):
    """(query, candidate) pairs that may be among each query's ``k`` nearest; rows are lifted and rotated.

    ``probed``: which pairs are in a probed list (all by default).  The ``2k`` best by the first block of columns are measured in full; the
    k-th of them bounds the distance looked for.  A candidate is abandoned
    after d of D columns when its partial distance, scaled by D/d, exceeds the
    bound by more than the test allows for so few columns.
    """
    dim = cands.shape[1]
    qn, cn = (queries[:, :block] ** 2).sum(1), (cands[:, :block] ** 2).sum(1)
    part = np.maximum(qn[:, None] + cn[None] - 2 * queries[:, :block] @ cands[:, :block].T, 0)
    if probed is not None:
        part[~probed] = np.inf
    if len(cands) <= 2 * k:
        return np.nonzero(np.isfinite(part))
    pilot = np.argpartition(part, 2 * k - 1, axis=1)[:, :2 * k]
    full = ((queries[:, None, :] - cands[pilot]) ** 2).sum(axis=2)
    full[~np.isfinite(np.take_along_axis(part, pilot, 1))] = np.inf
    bound = np.partition(full, k - 1, axis=1)[:, k - 1] * (1 + 1e-5) + 1e-9

    def allowed(d):
        return bound * (d / dim) * (1 + epsilon / math.sqrt(d)) ** 2 if d < dim else bound

    q, c = np.nonzero((part <= allowed(min(block, dim))[:, None]) & np.isfinite(part))
    dist = part[q, c]
    for a in range(block, dim, block):
        b = min(a + block, dim)
        diff = queries[q, a:b] - cands[c, a:b]
        dist = dist + np.einsum("ij,ij->i", diff, diff)
        keep = dist <= allowed(b)[q]
        q, c, dist = q[keep], c[keep], dist[keep]
    return q, c


def scan_group(query_ids, queries, probes, cand_ids, cands, cand_lists, k: int, norm2: float, turn: np.ndarray, scale: float = 1.0):
    """(query_id, vec_id, score) of the best ``k`` candidates of each query in its probed lists, its own id left out.

    Rows are original vectors; they are scanned as float32 over ``scale``, scored in double as they are.
    """
    # of equal vectors the smallest ids are enough: k, and one more for the query's own
    order = np.argsort(cand_ids, kind="stable")
    cand_ids, cands, cand_lists = cand_ids[order], np.ascontiguousarray(cands[order]), cand_lists[order]
    _, same = np.unique(cands.view(np.dtype((np.void, cands.dtype.itemsize * cands.shape[1]))).ravel(), return_inverse=True)
    by = np.argsort(same, kind="stable")
    place = np.arange(len(by)) - np.concatenate([[0], np.cumsum(np.bincount(same))])[same[by]]
    keep = np.sort(by[place <= k])
    cand_ids, cands, cand_lists = cand_ids[keep], cands[keep], cand_lists[keep]
    own = np.unique(cand_lists)
    column = np.searchsorted(own, cand_lists)
    turned = lift(scaled(cands, scale), norm2) @ turn
    out = []
    for i in range(0, len(queries), BATCH_QUERIES):
        qs, ids = queries[i:i + BATCH_QUERIES], query_ids[i:i + BATCH_QUERIES]
        lifted = np.concatenate([scaled(qs, scale), np.zeros((len(qs), 1), np.float32)], axis=1) @ turn
        asked = np.zeros((len(qs), len(own)), bool)
        for j, p in enumerate(probes[i:i + BATCH_QUERIES]):
            asked[j] = np.isin(own, p, assume_unique=True)
        q, c = adaptive_scan(lifted, turned, k + 1, asked[:, column])
        other = ids[q] != cand_ids[c]
        q, c = q[other], c[other]
        score = np.concatenate([np.einsum("ij,ij->i", qs[q[j:j + 65536]].astype(np.float64), cands[c[j:j + 65536]].astype(np.float64))
                                for j in range(0, len(q), 65536)] or [np.zeros(0)])
        best = np.lexsort((cand_ids[c], -score, q))
        q, c, score = q[best], c[best], score[best]
        first = np.searchsorted(q, q, "left")
        top = np.arange(len(q)) - first < k
        out.append(pd.DataFrame({"query_id": ids[q[top]], "vec_id": cand_ids[c[top]], "score": score[top]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): rows with an id whose vector is not null, not zero and wholly finite; floats stay floats, all else is double."""
    floats = embeddings.schema["embedding"].dataType == ArrayType(FloatType(), embeddings.schema["embedding"].dataType.containsNull)
    v = F.col("embedding") if floats else F.col("embedding").cast("array<double>")
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        ~F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(F.col("v"), lambda x: x != 0))


def _matrix(column, dtype=np.float64) -> np.ndarray:
    return np.array(column.tolist(), dtype=dtype).reshape(len(column), -1)


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """float32 rows over ``scale``, a power of two (so nothing is rounded that fits): no square of them overflows."""
    return (x / scale).astype(np.float32)


def probed_lists(x: np.ndarray, centres: np.ndarray, counts: np.ndarray, probes: int, need: np.ndarray) -> list[np.ndarray]:
    """The ``probes`` nearest lists of each row of ``x``, and the next ones until they hold ``need`` candidates (or all)."""
    near = list(nearest(x, centres, probes))
    short = np.flatnonzero([counts[row].sum() < n for row, n in zip(near, need)])
    if len(short) and probes < len(centres):
        for i, row in zip(short, nearest(x[short], centres, len(centres))):
            near[i] = row[:max(probes, np.searchsorted(np.cumsum(counts[row]), need[i]) + 1)]
    return near


def neighbours(spark: SparkSession, embeddings: DataFrame, k: int = 20, every: int = 20, probe_share: float = PROBE_SHARE) -> DataFrame:
    """The ``k`` nearest of every query (rows whose vec_id is divisible by ``every``): query_id, rank, vec_id, score.

    Ties go to the smaller vec_id.  Rows without id take no part, nor do
    invalid vectors, nor vectors of another length than the commonest.  A
    repeated row is a candidate each time, a repeated query id asks once.  No
    valid vector, no row.  ``probe_share`` 1 scans every list.  Finite components of any size take part: lists and
    scan work on vectors over a power of two, scores on the vectors as they are.
    """
    empty = "query_id long, rank int, vec_id long, score double"
    valid = valid_vectors(embeddings)
    dims = valid.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], empty)
    dim, n = dims["d"], dims["count"]
    valid = valid.where(F.size("v") == dim)
    kind = valid.schema["v"].dataType.simpleString()
    dtype = np.float32 if kind == "array<float>" else np.float64
    largest = valid.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x.cast("double")))))).first()[0]
    scale = math.ldexp(1.0, min(1023, math.frexp(largest)[1]))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x.cast("double") / scale) * (x.cast("double") / scale))
    norm2 = valid.agg(F.max(norm2)).first()[0]
    sample = valid.orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).select("v").toPandas()["v"]
    lists = max(1, min(MAX_LISTS, 4 * round(math.sqrt(n))))
    turn = rotation(dim + 1)
    centres = k_means(lift(scaled(_matrix(sample), scale), norm2) @ turn, lists)
    probes = min(len(centres), max(MIN_PROBES, math.ceil(probe_share * len(centres))))
    shared = spark.sparkContext.broadcast((centres, turn))  # at most MAX_LISTS vectors

    def to_list(batches):
        cs, rot = shared.value
        for pdf in batches:
            yield pdf.assign(list=nearest(lift(scaled(_matrix(pdf["v"], dtype), scale), norm2) @ rot, cs, 1)[:, 0].astype(np.int32))

    cands = stored(valid.mapInPandas(to_list, f"vec_id long, v {kind}, list int"), workspace(spark, "lists"))
    sizes = {r["list"]: r["count"] for r in cands.groupBy("list").count().collect()}  # a row per list
    group, parts = deal(sizes, len(centres))
    counts = np.array([sizes.get(i, 0) for i in range(len(centres))])
    queries = valid.where(F.col("vec_id") % every == 0)
    # rows of the query's own id are no answers
    queries = queries.dropDuplicates(["vec_id"]).join(queries.groupBy("vec_id").agg(F.count("*").alias("own")), "vec_id")
    q_parts = max(1, math.ceil(queries.count() / GROUP_QUERIES))

    def to_groups(batches):
        """A row for each group (and part of it) that holds probed lists."""
        cs, rot = shared.value
        for pdf in batches:
            x = _matrix(pdf["v"], dtype)
            near = probed_lists(np.concatenate([scaled(x, scale), np.zeros((len(x), 1), np.float32)], axis=1) @ rot, cs, counts, probes, DEPTH * k + pdf["own"].to_numpy())
            ids, out = pdf["vec_id"].to_numpy(), []
            for i, row in enumerate(near):
                for g in np.unique(group[row]):
                    if g >= 0:
                        out += [(g, c, ids[i] // every % q_parts, ids[i], x[i], row[group[row] == g]) for c in range(parts[g])]
                if len(out) >= 4096:
                    yield pd.DataFrame(out, columns=["g", "c", "q", "vec_id", "v", "probes"])
                    out = []
            yield pd.DataFrame(out, columns=["g", "c", "q", "vec_id", "v", "probes"])

    asked = queries.mapInPandas(to_groups, f"g int, c int, q int, vec_id long, v {kind}, probes array<int>")

    def place(batches):
        for pdf in batches:
            to = group[pdf["list"].to_numpy()]
            part = (pdf["vec_id"].to_numpy() * 2654435761 % (1 << 32) + np.arange(len(pdf))) % np.asarray(parts)[to]
            for q in range(q_parts):
                yield pdf.assign(g=to, c=part.astype(np.int32), q=np.int32(q))

    dealt = cands.mapInPandas(place, f"vec_id long, v {kind}, list int, g int, c int, q int")

    def scan(key, left, right):
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return scan_group(left["vec_id"].to_numpy(), _matrix(left["v"], dtype), left["probes"].tolist(), right["vec_id"].to_numpy(),
                          _matrix(right["v"], dtype), right["list"].to_numpy(), k, norm2, shared.value[1], scale)

    found = asked.groupBy("g", "c", "q").cogroup(dealt.groupBy("g", "c", "q")).applyInPandas(scan, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def deal(sizes: dict[int, int], lists: int) -> tuple[np.ndarray, list[int]]:
    """Group of each list (-1: empty list), and the number of parts of each group."""
    group, parts, room = np.full(lists, -1, np.int32), [], 0
    for i in sorted(sizes):
        if sizes[i] > GROUP_ROWS:
            parts.append(math.ceil(sizes[i] / GROUP_ROWS))
            room, group[i] = 0, len(parts) - 1
            continue
        if sizes[i] > room or not parts:
            parts.append(1)
            room = GROUP_ROWS
        room -= sizes[i]
        group[i] = len(parts) - 1
    return group, parts
