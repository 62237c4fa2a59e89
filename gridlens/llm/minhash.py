"""Near-duplicates by SetSketch registers, joint likelihood estimates and exact verification.

A document is the set of its distinct 5-word shingles.  Each register of a
sketch is the minimum of exponentially distributed hashes, truncated to an
exponential scale: sketches of parts merge by maximum, and two sets agree in a
register nearly as often as their Jaccard similarity.  Bands of registers give
candidates; inside a group of candidates the similarity is estimated by
likelihood from the registers and the set sizes, and what may reach the
threshold is verified on the full sets.  Links become connected components.

Equal sets are one node from the start.  Every node is first verified against
the hub it shares most bands with; nodes linked so are one cluster, and only
nodes of different clusters are compared after that.  A group emits a spanning
forest of its links, never its pairs; a large group is dealt into pairs of
blocks, which compare registers, and sets only of nodes with a likely partner.
Sets are compared by 64-bit digests of their shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm.common import discard, releasing, stored, workspace
from gridlens.llm.components import connected

WORDS = 5
#: A link: PERCENT or more of the union is shared, if the caller names no other percentage.
PERCENT = 85
#: Registers a band and bands, by percentage: a pair at the threshold is missed once in 200,000 times (85) or 190,000 (80),
#: one at 0.3 found once in 140 or 35.
SHAPES = {85: (7, 32), 80: (6, 40)}
REGISTERS = max(rows * bands for rows, bands in SHAPES.values())
#: SetSketch base, rate and largest register.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
#: Standard errors below the threshold at which an estimate still leads to verification.
MARGIN = 4.5
#: Nodes and shingles of a block of a large candidate group.
BLOCK_NODES, BLOCK_SHINGLES = 2048, 1 << 21

_U = np.uint64
_RNG = np.random.default_rng(1234567)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWER = int(_RNG.integers(0, 1 << 62)) * 2 + 1
_PLACE = _RNG.integers(0, 1 << 62, WORDS, dtype=np.uint64) * _U(2) + _U(1)
_MULTIPLY = _RNG.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)


def _mix(x):
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    have = _powers[name]
    while len(have) < n:
        have = np.concatenate([have, have * _U(pow(base, len(have), 1 << 64))])
    _powers[name] = have
    return have[:n]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words, from one running sum over the bytes."""
    b = np.frombuffer(text, np.uint8)
    n = len(b)
    edge = np.diff(np.concatenate([[True], _SPACE[b], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[b] * _power_table("up", _POWER, n), out=total[1:])
    down = _power_table("down", pow(_POWER, -1, 1 << 64), n + 1)
    return _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct digests of the shingles; one for a text of fewer words, none without words."""
    w = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(w):
        return w
    k = min(WORDS, len(w))
    n = len(w) - k + 1
    s = np.full(n, k, np.uint64)
    for i in range(k):
        s += _mix(w[i:i + n] * _PLACE[i])
    return np.unique(_mix(s))


def sketch(sets: list[np.ndarray], count: int = REGISTERS) -> np.ndarray:
    """(len(sets), count) registers of non-empty sets."""
    x = np.concatenate(sets)
    x = (x >> _U(32)).astype(np.uint32) ^ x.astype(np.uint32)
    first = np.cumsum([0, *map(len, sets[:-1])])
    low, v = np.empty((count, len(sets)), np.uint32), np.empty_like(x)
    for i in range(count):
        np.multiply(x, _MULTIPLY[i], out=v)
        v += _ADD[i]
        np.minimum.reduceat(v, first, out=low[i])
    h = -np.log1p(-(low.T + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1 - np.log(h) / math.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(registers: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    rows, bands = SHAPES[percent]
    keys = np.zeros((len(registers), bands), np.uint64)
    for i in range(rows):
        keys = _mix(keys * _U(0x9E3779B97F4A7C15) + registers[:, i:rows * bands:rows].astype(np.uint64) + _U(1))
    return _mix(keys + np.arange(bands, dtype=np.uint64)).view(np.int64)


def _log_slope(plus, minus, equal, n, m, j):
    """Derivative at similarity ``j`` of the likelihood of the register comparison, given both set sizes."""
    u = n / (n + m)
    v = 1 - u
    c, ln = (BASE - 1) / BASE, math.log(BASE)

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * c) / ln

    def dp(x):
        return c / ln / (1 - np.clip(x, 0, 1) * c)

    a, b = u - v * j, v - u * j
    pa_, pb = p(a), p(b)
    da, db = -v * dp(a), -u * dp(b)
    return plus * da / pa_ + minus * db / pb - equal * (da + db) / np.maximum(1 - pa_ - pb, 1e-12)


def _floor_similarity(percent: int) -> float:
    t = percent / 100
    return t - MARGIN * math.sqrt(t * (1 - t) / math.prod(SHAPES[percent]))


def _near_places(sizes: np.ndarray, registers: np.ndarray, percent: int):
    """(a, places b > a) of the pairs that may reach the threshold, likeliest first; rows are sorted by size.

    A pair passes if sizes allow the threshold, then if the likelihood still
    rises at the floor similarity (the estimate is at least that).
    """
    floor, count = _floor_similarity(percent), registers.shape[1]
    for a in range(len(sizes) - 1):
        # larger sets up to 100 / percent of this one
        end = np.searchsorted(sizes, sizes[a] * 100 // percent, "right")
        if end <= a + 1:
            continue
        other = registers[a + 1:end]
        plus = (registers[a] > other).sum(axis=1)
        equal = (registers[a] == other).sum(axis=1)
        slope = _log_slope(plus, count - plus - equal, equal, float(sizes[a]), sizes[a + 1:end].astype(float), floor)
        near = np.flatnonzero(slope >= 0)
        yield a, near[np.argsort(-equal[near], kind="stable")] + a + 1


def _linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    both = len(np.intersect1d(s, t, assume_unique=True))
    return 100 * both >= percent * (len(s) + len(t) - both)


def near_in_group(sizes: np.ndarray, registers: np.ndarray, cluster: np.ndarray, side: np.ndarray | None = None, percent: int = PERCENT):
    """Mask of the places with a partner in another cluster (and on the other side) that may reach the threshold."""
    order = np.argsort(sizes, kind="stable")
    cluster, side, hit = cluster[order], None if side is None else side[order], np.zeros(len(order), bool)
    for a, near in _near_places(sizes[order], registers[order], percent):
        near = near[(cluster[near] != cluster[a]) & (True if side is None else side[near] != side[a])]
        hit[near] = True
        hit[a] |= len(near) > 0
    out = np.zeros(len(order), bool)
    out[order] = hit
    return out


def links_in_group(sizes: np.ndarray, registers: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None,
                   percent: int = PERCENT, cluster: np.ndarray | None = None):
    """Spanning forest (pairs of places) of the verified links; with ``side``, only links across the two sides.

    A pair is compared exactly if sizes and registers let it reach the
    threshold - unless a link, or a cluster known from before, already connects the two.
    """
    parent = list(range(len(sizes)))
    if cluster is not None:
        first = {}
        parent = [first.setdefault(c, i) for i, c in enumerate(cluster.tolist())]

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    order, forest = np.argsort(sizes, kind="stable"), []
    for a, near in _near_places(sizes[order], registers[order], percent):
        for b in near.tolist():
            i, j = int(order[a]), int(order[b])
            if side is not None and side[i] == side[j]:
                continue
            ri, rj = root(i), root(j)
            if ri != rj and _linked(sets[i], sets[j], percent):
                parent[max(ri, rj)] = min(ri, rj)
                forest.append((i, j))
    return forest


def _sketcher(percent: int):
    def run(batches):
        for batch in batches:
            keys, ids, texts = (batch.column(i) for i in range(3))
            sets = [shingles(t) for t in texts.to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            n = np.array([len(s) for s in sets], np.int64)
            registers, bands, node = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            for k in range(0, len(full), 256):
                part = full[k:k + 256]
                r = sketch([sets[i] for i in part], math.prod(SHAPES[percent]))
                b = band_keys(r, percent)
                for row, i in enumerate(part):
                    registers[i], bands[i] = r[row].tobytes(), b[row]
                    node[i] = int((_mix(sets[i]).sum(dtype=np.uint64) + _U(len(sets[i]))).view(np.int64))
            yield pa.RecordBatch.from_arrays([keys, ids, pa.array(n), pa.array(node, pa.int64()), pa.array(registers, pa.binary()),
                                              pa.array(bands, pa.list_(pa.int64()))],
                                             names=["key", "doc_id", "n_shingles", "node", "registers", "bands"])
    return run


def _sets(batches):
    for batch in batches:
        nodes, sets, size = [], [], 0
        for node, text in zip(batch.column(0), batch.column(1)):
            nodes.append(node.as_py())
            sets.append(shingles(text.as_py()).tobytes())
            size += len(sets[-1])
            if size >= 8 * BLOCK_SHINGLES:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "set"])
                nodes, sets, size = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "set"])


def _hub_verifier(percent: int):
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (hub, _), group in pdf.groupby(["hub", "chunk"], sort=False):
            sets = {node: np.frombuffer(s, np.uint64) for node, s in zip(group["node"].tolist(), group["set"])}
            centre = sets.pop(hub)
            out += [(node, hub) for node, s in sets.items() if _linked(s, centre, percent)]
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    return verify


def _blocks_of(pdf: pd.DataFrame, percent: int):
    """Rows, registers and sides of each pair of blocks of a frame."""
    for (_, bi, bj), group in pdf.groupby(["component", "bi", "bj"], sort=False):
        registers = np.frombuffer(b"".join(group["registers"]), np.uint16).reshape(len(group), math.prod(SHAPES[percent]))
        yield group, registers, None if bi == bj else group["block"].to_numpy()


def _near_finder(percent: int):
    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [group[near_in_group(group["n"].to_numpy(), registers, group["cluster"].to_numpy(), side, percent)]
               for group, registers, side in _blocks_of(pdf, percent)]
        return pd.concat(out).drop(columns="_task")
    return find


def _verifier(percent: int):
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for group, registers, side in _blocks_of(pdf, percent):
            sets = [np.frombuffer(s, np.uint64) for s in group["set"]]
            node = group["node"].to_numpy()
            out += [(node[i], node[j]) for i, j in links_in_group(group["n"].to_numpy(), registers, sets, side, percent, group["cluster"].to_numpy())]
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    return verify


def _blocks(rows, shingles_) -> F.Column:
    return F.greatest(F.ceil(rows / BLOCK_NODES), F.ceil(shingles_ / BLOCK_SHINGLES)).cast("int")


def with_tasks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``_task``: a large group of ``keys`` is a task of its own, small ones share tasks of about a block.

    Groups are bounded by blocks; column n counts the shingles of a row.
    """
    per = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), F.sum("n").alias("_n"))
    total = per.agg(F.sum("_rows"), F.sum("_n")).first()
    many = 1 + max((total[0] or 0) * 2 // BLOCK_NODES, (total[1] or 0) * 2 // BLOCK_SHINGLES)
    small = (F.col("_rows") * 8 <= BLOCK_NODES) & (F.col("_n") * 8 <= BLOCK_SHINGLES)
    task = F.when(small, F.pmod(F.xxhash64(*keys), F.lit(many))).otherwise(F.xxhash64(*keys))
    return rows.join(per.select(*keys, task.alias("_task")), keys)


def hub_rows(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """(hub, chunk, node, n): every node with the hub that it shares most bands with; a chunk is a block, and has the hub too."""
    best = edges.groupBy("u").agg(F.max(F.struct("shared", "v")).alias("_b")).select(F.col("u").alias("node"), F.col("_b.v").alias("hub"))
    best = best.join(sizes, "node")
    chunks = best.groupBy("hub").agg(_blocks(F.count("*"), F.sum("n")).alias("chunks"))
    members = best.join(chunks, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), "node", "n")
    centres = members.select("hub", "chunk").distinct().withColumn("node", F.col("hub")).join(sizes, "node")
    return members.unionByName(centres)


def block_rows(nodes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows of ``nodes`` (component, node, n, ...) once for each pair of blocks (bi, bj) in which they meet others.

    A component of one cluster is settled.  Blocks of the largest cluster
    meet all other blocks, but not each other: its nodes are linked already.
    """
    nodes = nodes.join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    per = nodes.groupBy("component", "cluster").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    per = per.groupBy("component").agg(F.max(F.struct("c", "cluster", "w")).alias("top"), F.sum("c").alias("c"), F.sum("w").alias("w"),
                                       F.count("*").alias("clusters")).where("clusters > 1")
    one = _blocks(F.col("c"), F.col("w")) <= 1
    per = per.select("component", F.col("top.cluster").alias("_top"), F.when(one, 0).otherwise(_blocks(F.col("top.c"), F.col("top.w"))).alias("_first"),
                     F.when(one, 1).otherwise(_blocks(F.col("c") - F.col("top.c"), F.col("w") - F.col("top.w"))).alias("_rest"))
    top, deal = (F.col("cluster") == F.col("_top")) & (F.col("_first") > 0), F.xxhash64("node")
    block = F.when(top, F.pmod(deal, F.nullif("_first", F.lit(0)))).otherwise(F.col("_first") + F.pmod(deal, F.col("_rest"))).cast("int")
    rows = nodes.join(per, "component").withColumn("block", block)
    other = F.sequence(F.when(top, F.col("_first")).otherwise(0), F.col("_first") + F.col("_rest") - 1)
    return rows.withColumn("_o", F.explode(other)).select(
        *nodes.columns, "block", F.least("block", "_o").alias("bi"), F.greatest("block", "_o").alias("bj"))


def row_key() -> F.Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def near_components(spark: SparkSession, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, doc_id, n_shingles, node, component) of every row; component is null for an empty set.

    Rows with equal sets share a node; ``component`` names the nodes linked at
    ``percent`` (85 or 80).
    ``key`` is a digest of doc_id and text.  Null and wordless texts have the
    empty set and no link; null ids take part; repeated rows share a node;
    other columns are ignored.
    """
    folder = workspace(spark, "near")
    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = stored(rows.mapInArrow(releasing(_sketcher(percent)), "key long, doc_id long, n_shingles long, node long, registers binary, bands array<long>"), folder + "/rows")
    # one row of each distinct set (the registers of equal sets are equal)
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("key"))
    nodes = stored(rows.join(nodes, ["node", "key"], "left_semi").dropDuplicates(["node"])
                   .select("node", "key", F.col("n_shingles").alias("n"), "registers", "bands"), folder + "/nodes")
    bands = nodes.select("node", F.explode("bands").alias("band"))
    hubs = bands.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("band", "hub")
    edges = bands.join(hubs, "band").where("node <> hub").groupBy(F.col("node").alias("u"), F.col("hub").alias("v")).agg(F.count("*").alias("shared"))
    edges = stored(edges, folder + "/edges")
    groups = stored(connected(edges, folder + "/candidates"), folder + "/groups")
    texts = docs.select(row_key().alias("key"), F.col("text").cast("binary").alias("text"))
    sets = texts.join(nodes.select("node", "key").join(groups, "node"), "key").dropDuplicates(["node"]).select("node", "text")
    sets = stored(sets.mapInArrow(releasing(_sets), "node long, set binary"), folder + "/sets")

    # every node against one hub; what that links is one cluster and is not compared again
    asked = with_tasks(hub_rows(edges, nodes.select("node", "n")), ["hub", "chunk"])
    near = stored(asked.join(sets, "node").groupBy("_task").applyInPandas(_hub_verifier(percent), "u long, v long"), folder + "/hub-links")
    clusters = stored(connected(near, folder + "/clusters-star"), folder + "/clusters").withColumnRenamed("component", "cluster")
    # then blocks of nodes by their registers, then the sets of those with a likely partner
    pair = ["component", "bi", "bj"]
    pairs = block_rows(nodes.select("node", "n", "registers").join(groups, "node"), clusters)
    found = with_tasks(pairs, pair).groupBy("_task").applyInPandas(_near_finder(percent), pairs.schema)
    found = stored(found, folder + "/found")
    links = with_tasks(found, pair).join(sets, "node").groupBy("_task").applyInPandas(_verifier(percent), "u long, v long")
    links = stored(links.union(near), folder + "/links")
    linked = connected(links, folder + "/links-star").withColumnRenamed("component", "_c")
    discard(spark, *(f"{folder}/{x}" for x in ("nodes", "edges", "candidates", "groups", "sets", "hub-links", "clusters-star", "clusters", "found", "links")))
    return rows.select("key", "doc_id", "n_shingles", "node").join(linked, "node", "left").select(
        "key", "doc_id", "n_shingles", "node", F.coalesce("_c", "node").alias("component"))


def duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document its set size, the smallest doc_id reachable, and whether it is that (the registered query)."""
    rows = near_components(spark, docs, PERCENT)
    rows = rows.withColumn("_own", F.when(F.col("component").isNull(), F.col("doc_id")))
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("_least"))
    out = rows.join(least, "component", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("_least", "_own").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(spark: SparkSession, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near-duplicates at ``percent``: that of the smallest doc_id, then of the smallest row digest.

    Rows with an empty set are all kept.
    """
    rows = near_components(spark, docs, percent).where("component IS NOT NULL")
    # a null id loses against any other
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    keep = first.select(F.col("first.key").alias("_key")).distinct()
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_key().alias("_key"), has_words.alias("_words"))
    kept = rows.where("_words").join(keep, "_key", "left_semi").dropDuplicates(["_key"])
    return kept.select("_row.*").unionByName(rows.where("NOT _words").select("_row.*"))
