"""Conversation repair and integer clustering against plain versions; toxicity by held-out labels."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlens.llm import langid, queries, repair, simplex, toxicity

SF = "/root/testdata/sf0.01"


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- conversation repair ----------------------------------------------------------

def plain_cheapest(rows):
    """Cheapest (cost, audit) by memoised search over all edit sequences; no insert after two in a row can help."""
    grammar = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def go(i, state, inserted):
        found = []
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, ""))
        else:
            initial, fault = rows[i]
            options = [(2, "D", state)]
            if fault not in ("blank", "copy"):
                more = 5 if fault == "cut" else 0
                if initial in grammar[state]:
                    options.append((more, "K", grammar[state][initial]))
                options += [(1 + more, "R", to) for to in ("u", "a") if to in grammar[state]]
            for cost, e, to in options:
                rest = go(i + 1, to, 0)
                if rest:
                    found.append((cost + rest[0], e + rest[1]))
        if inserted < 3:
            for to in ("u", "a"):
                if to in grammar[state] and (rest := go(i, to, inserted + 1)):
                    found.append((5 + rest[0], "I" + rest[1]))
        return min(found, default=None)
    return go(0, "", 0)


FAULTS = {"fine": repair.FINE, "blank": repair.BLANK, "copy": repair.COPY, "cut": repair.TRUNCATED}


def test_bidirectional_search_equals_exhaustive_search_and_joins_stretches():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.choice(["fine"] * 4 + ["blank", "copy", "cut"])) for _ in range(rng.randrange(0, 9))]
        own = [(r, FAULTS[f]) for r, f in rows]
        want = plain_cheapest(tuple(rows))
        assert repair.cheapest(own, repair.NOTHING, repair.DONE) == want, rows
        cut = rng.randrange(0, len(rows) + 1)
        labels = {repair.NOTHING: (0, "")}
        for part in (own[:cut], own[cut:]):
            solved = [(e, x, *got) for e in range(4) for x in range(4) if (got := repair.cheapest(part, e, (x,)))]
            labels = repair.join(labels, solved)
        assert min(labels[x] for x in repair.DONE if x in labels) == want, (rows, cut)


def plain_repair(rows):
    """The query's rows by conversation from (conv_id, turn, role, text) rows."""
    groups, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        groups[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for conv, got in groups.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in got:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "copy" if (role, text) in seen else "fine" if body[-1] in ".!?" else "cut")
            seen.add((role, text))
        turns = {r[0] for r in got if r[0] is not None}
        cost, audit = plain_cheapest(tuple((r[1][:1], f) for r, f in zip(got, faults)))
        said, at, state = [], 0, ""
        for e in audit:
            if e == "I":
                state = "u" if state != "u" else "a"
                said.append({"u": "user:", "a": "assistant:"}[state])
                continue
            _, role, text = got[at]
            at += 1
            if e != "D":
                state = role[0] if e == "K" else "u" if state != "u" else "a"
                said.append(f"{role if e == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "copy", "cut")],
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(got, got[1:])), cost, audit,
                     hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


COLS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def digest(df):
    rows = df.collect()
    got = {r["conv_id"]: tuple(r[c] for c in COLS) for r in rows}
    assert len(got) == len(rows)
    return got


def test_repair_query_equals_plain_version_on_the_table(spark):
    rows = [tuple(r) for r in table(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert digest(queries.op12_repair(spark, SF)) == plain_repair(rows)


def test_repair_of_nulls_ties_copies_long_and_other_conversations(spark):
    rng = random.Random(3)
    texts = ["Hi.", "Hi.", "cut off", " \t", "", None, "So? ", "Wow!\n", "ß."]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    rows = [(c, rng.choice([None, 1, 2, 3, 7]), rng.choice(roles), rng.choice(texts)) for c in [None, 1, 2, 3] for _ in range(9)]
    rows += [(9, t, "user" if t % 2 == 0 else "assistant", f"turn {t}." if t % 7 else "again.") for t in range(700)]
    rows += [(10, 5, "user", "Same.")] * 500
    rows += [(c, 0, "user", "x.") for c in range(100, 160)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit(1)).withColumn("step", F.lit(2))
    got = digest(repair.repair_digest(spark, df.repartition(7)))
    import sys
    sys.setrecursionlimit(20000)
    assert got == plain_repair(rows)
    assert any(v[5] == 0 and v[6] == "" for v in got.values())  # all rows dropped
    assert repair.repair_digest(spark, df.limit(0)).count() == 0


def test_edits_are_the_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Yes.")], "conv_id long, turn long, role string, text string")
    got = [(r["step"], r["edit"], r["role"], r["text"]) for r in repair.repair(spark, rows, rows).orderBy("step").collect()]
    assert got == [(0, None, None, None), (1, "R", "user", "Hello."), (2, "K", "assistant", "Yes.")]


# --- integer clusters -------------------------------------------------------------

def plain_clusters(rows, k=40, rounds=5):
    """(vec_id, cluster, distance, inertias, digest) by whole integer arithmetic."""
    from fractions import Fraction
    from math import floor, isfinite
    kept = [(i, [floor(Fraction(float(x)) * 256) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    own = defaultdict(int)
    for d, j in near:
        own[j] += d
    fits = lambda x: x if x < 1 << 63 else None
    lost = {j for d, j in near if d >= 1 << 63}
    return sorted((str(i), j, fits(d), None if j in lost else fits(own[j]), None if lost else fits(sum(own.values())),
                   hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, near))


def clusters(df):
    cols = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r["vec_id"]), *[r[c] for c in cols[1:]]) for r in df.collect())


def test_clusters_equal_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, "embeddings", sf).collect()][:300]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    assert repr(clusters(simplex.cluster_digest(spark, df))) == repr(plain_clusters(rows))


@pytest.mark.parametrize("huge", [None, 1e30, 1e300])
def test_clusters_of_odd_vectors(spark, huge):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=64).round(2).tolist()) for i in range(50)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (60, None), (61, [1.0] * 63), (62, [None] + [1.0] * 63), (63, [float("nan")] + [1.0] * 63),
             (64, [float("inf")] * 64), (65, []), (66, [0.0] * 64)]
    rows += [(70 + i, rows[5][1]) for i in range(30)]
    if huge:
        rows += [(200 + i, [huge * (i + 1)] + [0.5] * 63) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).withColumn("reach", F.lit("y"))
    assert repr(clusters(simplex.cluster_digest(spark, df.repartition(4)))) == repr(plain_clusters(rows))


def test_few_or_no_vectors(spark):
    rows = [(1, [0.25] * 64), (2, [0.5] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert repr(clusters(simplex.cluster_digest(spark, df))) == repr(plain_clusters(rows))
    assert simplex.cluster_digest(spark, df.limit(0)).count() == 0


def test_simplex_bounds_enclose_the_distances():
    rng = np.random.default_rng(2)
    points = rng.integers(-300, 300, (200, 64))
    points[50:80] = points[0] + rng.integers(-2, 3, (30, 64))  # nearly equal ones
    s = simplex.Simplex([p.tolist() for p in points[:60]])
    assert len(s.pivots) == simplex.PIVOTS
    a = s.apex(s.reach(points))
    low, high = s.bounds(a, a)
    true = ((points[:, None] - points[None]) ** 2).sum(2)
    assert (low <= true).all() and (true <= high).all()
    inside = s.apex(s.reach(s.pivots))
    assert np.allclose(np.sqrt(((inside[:, None] - inside[None]) ** 2).sum(2) ** 2) ** 0.5,
                       np.sqrt(((s.pivots[:, None] - s.pivots[None]) ** 2).sum(2)), rtol=1e-6, atol=1e-3)
    near = simplex.Assigner(s, points[100:140].tolist()).near(s.reach(points))
    best = ((points[:, None] - points[None, 100:140]) ** 2).sum(2).argmin(1)
    assert near[np.arange(200), best].all()
    assert near.sum() < near.size


# --- toxicity ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def toxic(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, "documents", sf), table(spark, "labels", sf)
    model = toxicity.train(docs, labels)
    return docs, labels, model


def test_toxicity_on_held_out_labels(spark, toxic):
    docs, labels, model = toxic
    got = toxicity.score_toxicity(docs, model, carry=["doc_id"]).join(labels.where(langid.held_out()), "doc_id").collect()
    hit = sum(r["toxic"] == 1 and r["predicted"] == 1 for r in got)
    false = sum(r["toxic"] == 0 and r["predicted"] == 1 for r in got)
    missed = sum(r["toxic"] == 1 and r["predicted"] == 0 for r in got)
    assert hit >= 85 and false <= 2 and missed <= 15, (hit, false, missed)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    n = 6000
    y = rng.random(n) < 0.2
    fire = lambda p, q: np.where(rng.random(n) < np.where(y, p, q), 1.0, 0.0)
    v = [fire(0.8, 0.05), fire(0.7, 0.1), fire(0.6, 0.02), fire(0.5, 0.5)]
    v.append(np.where(rng.random(n) < 0.95, v[1], 1 - v[1]))  # nearly a copy of the second voter
    label = np.where(rng.random(n) < 0.05, 1 - y, y)
    m = toxicity.LabelModel(label.mean()).fit(np.stack([*v, label], axis=1), np.where(label == 1, 0.95, 0.05))
    q = m.posterior(np.stack([*v, label], axis=1))
    assert ((q > 0.5) == y).mean() > max((label == y).mean(), 0.965)
    assert {1, 4} <= {m.parent[4], m.parent[1], 1, 4} and (m.parent[4] == 1 or m.parent[1] == 4)
    assert abs(m.accuracy[1][0] - 0.8) < 0.06 and abs(m.accuracy[0][0] - 0.95) < 0.03


def test_features_equal_plain_counts():
    book = toxicity.Terms(["idiot", "idio-", "xyz", "ab"])
    texts = ["Idiot, idiots! IDIOT?? you", "", "ab ab xyzzy é", "$$ %% a a a"]
    got = book.features(texts)
    for row, text in zip(got, texts):
        words = re.findall(r"[^\W_]+", text.lower())
        assert row[0] == words.count("idiot") and row[2] == words.count("xyz") and row[3] == words.count("ab")
        assert row[1] == sum(w.startswith("idio") and len(w) > 4 for w in words)
        assert row[-1] == len(words)
    assert got[0][4] > 0 and got[0][6] > 0 and got[3][7] > 0 and got[3][8] > 0


def test_toxicity_edges(spark, toxic):
    _, _, model = toxic
    rows = [(1, None, 5), (2, "", 5), (None, "you idiot moron", 5), (3, "you idiot moron", 5), (3, "you idiot moron", 5), (4, "word " * 200_000 + "idiot idiot moron scum", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int").withColumn("predicted", F.lit("?")).withColumn("_doc", F.lit(1))
    out = toxicity.score_toxicity(df, model)
    assert out.columns == ["doc_id", "text", "_doc", "score", "predicted"]
    got = sorted((r["doc_id"] or 0, r["predicted"]) for r in out.collect())
    assert got[:5] == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1)] and len(got) == 6
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, None), (2, 0)], "doc_id long, toxic int")
    assert toxicity.train(df, labels) is None
    assert {r["score"] for r in toxicity.predictions(df, labels).collect()} == {0.0}
    assert toxicity.train(df.limit(0), labels.limit(0)) is None


def test_toxicity_query_never_reads_labels_of_scored_rows(spark):
    got = queries.op11_toxicity(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == table(spark, "documents").count()
