"""Trained operators by gradients and held-out accuracy; search by recall; chat rotation by hand."""

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from gridlens.llm import ann, chat, langid, quality, queries

SF = "/root/testdata/sf0.01"


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def numeric(f, x, eps=1e-3):
    out = np.zeros_like(x, dtype=np.float64)
    for i in np.ndindex(x.shape):
        old = x[i]
        x[i] = old + eps
        up = f()
        x[i] = old - eps
        out[i] = (up - f()) / (2 * eps)
        x[i] = old
    return out


def test_recurrent_gradients_are_those_of_the_loss():
    m = langid.Model(["a", "b", "c"], hidden=3, seed=1)
    for n in m.NAMES:
        setattr(m, n, getattr(m, n).astype(np.float64))
    x, keep = langid.pad([b"abca", b"bb", b"cabbage"])
    x, keep = x[:8], keep[:8]
    y = np.array([0, 2, 1])
    _, grads = m.gradients(x, keep, y)
    for n in ("uf", "ub", "w", "b"):
        assert np.allclose(grads[n], numeric(lambda: m.gradients(x, keep, y)[0], getattr(m, n)), atol=2e-3), n
    rows = m.tf[97:100]
    assert np.allclose(grads["tf"][97:100], numeric(lambda: m.gradients(x, keep, y)[0], rows), atol=2e-3)


def test_fast_labels_equal_plain_ones_and_cover_every_byte():
    m = langid.Model(["a", "b"], seed=3)
    x, keep = langid.pad([b"some text here", b"", b"y" * 64])
    h = np.concatenate([langid._run(x, keep, m.tf, m.uf), langid._run(x[::-1], keep[::-1], m.tb, m.ub)[::-1]], axis=2)
    want = (langid._softmax(h @ m.w + m.b) * keep[:, :, None]).sum(axis=0)
    assert np.allclose(want, m.label_segments(x, keep), atol=1e-4)
    p = m.document_probabilities([b"z" * 1000, b"", b"ab"])
    assert np.allclose(p.sum(axis=1), [1, 0, 1], atol=1e-4)


@pytest.fixture(scope="module")
def languages(spark):
    docs = table(spark, "documents")
    model = langid.train(docs)
    return docs, model


def test_language_held_out_accuracy(languages):
    docs, model = languages
    got = langid.identify(docs, model, carry=["doc_id", "lang"]).withColumn("held", langid.held_out())
    rows = got.where("held").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, languages):
    docs, model = languages
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "123 !!", "x"), (4, "the of and thention", "x"), (None, "der die und", "x"), (4, "the of and thention", "x")],
                                "doc_id long, text string, lang_pred string")
    rows = langid.identify(odd.drop("lang_pred"), model).collect()
    assert [r.lang_pred for r in rows if r.doc_id in (1, 2, 3)] == ["und"] * 3 and len(rows) == 6
    got = langid.reject(docs.limit(50).unionByName(odd.withColumnsRenamed({"lang_pred": "source"}), allowMissingColumns=True))
    assert got.columns == docs.columns
    assert not {1, 2, 3} & {r.doc_id for r in got.where("lang is null").collect()}
    nothing = langid.identify(odd.drop("lang_pred"), langid.train(docs.where("false")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    clash = langid.reject(odd.withColumn("lang", F.lit("en")).withColumn("score", F.lit(1)))
    assert clash.columns == ["doc_id", "text", "lang_pred", "lang", "score"]


def test_clean_documents_have_a_language(languages):
    docs, _ = languages
    assert langid.reject(docs).count() >= 0.99 * docs.count()


def test_attention_gradients_are_those_of_the_loss():
    m = quality.Model(seed=2)
    for n in m.NAMES:
        setattr(m, n, getattr(m, n).astype(np.float64))
    x, counts = quality.passages([b"abc def " * 100, b"", b"Q!! Q!! " * 90])
    x, y = x.astype(np.float64), np.array([1.0, 0.0, 0.0])

    def loss():
        p, _ = m.forward(x, counts)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    _, grads = m.gradients(x, counts, y)
    for n in ("v", "u", "a", "o", "c", "b"):
        assert np.allclose(grads[n], numeric(loss, getattr(m, n)), atol=1e-4), n


def test_quality_held_out_separation(spark):
    docs, labels = table(spark, "documents", "/root/testdata/sf0.1"), table(spark, "labels", "/root/testdata/sf0.1")
    rows = quality.predictions(docs, labels).join(labels.groupBy("doc_id").agg(F.max("quality").alias("y")), "doc_id").where("held_out").collect()
    s, y = np.array([r.score for r in rows]), np.array([r.y for r in rows])
    rank = s.argsort().argsort() + 1
    auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.95 and np.mean([r.predicted == r.y for r in rows]) > 0.95


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "fine words here"), (2, "### $$$"), (3, None), (4, ""), (None, "x"), (2, "### $$$")], "doc_id long, text string")
    rows = quality.predictions(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.predictions(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.predictions(docs, labels.limit(0)).collect()} == {0.5}


def brute_neighbours(pdf, k=20):
    pdf = pdf[[v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in pdf["embedding"]]].sort_values("vec_id")
    x, ids = np.array(pdf["embedding"].tolist(), dtype=np.float64), pdf["vec_id"].to_numpy()
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        other = ids != ids[i]
        order = np.lexsort((ids[other], -s[other]))[:k]
        out[ids[i]] = (ids[other][order], s[other][order])
    return out


def check_recall(got, want, least):
    hits = total = 0
    for q, (ids, scores) in want.items():
        mine = got[got["query_id"] == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, len(ids) + 1))
        assert list(mine["score"]) == sorted(mine["score"], reverse=True)
        both = dict(zip(ids.tolist(), scores.tolist()))
        assert all(abs(both[v] - s) < 1e-12 for v, s in zip(mine["vec_id"], mine["score"]) if v in both)
        hits += len(set(ids.tolist()) & set(mine["vec_id"]))
        total += len(ids)
    assert hits >= least * total


def test_neighbours_recall(spark):
    e = table(spark, "embeddings", "/root/testdata/sf0.1")
    check_recall(ann.neighbours(spark, e).toPandas(), brute_neighbours(e.toPandas()), 0.9)


def test_neighbours_of_uneven_norms_equal_vectors_and_invalid_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(8) * rng.uniform(0.1, 3)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(i, rows[3][1]) for i in range(400, 460)]  # one vector many times
    rows += [(460, None), (480, [0.0] * 8), (500, [float("nan")] + [1.0] * 7), (520, [float("inf")] + [1.0] * 7), (540, [None] + [1.0] * 7),
             (None, [1.0] * 8), (560, [1.0] * 5), (-20, [0.5] * 8)]
    e = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    want = brute_neighbours(spark.createDataFrame([(i, v) for i, v in rows if i is not None and i != 560], "vec_id long, embedding array<float>").toPandas())
    got = ann.neighbours(spark, e, probe_share=1.0).toPandas()
    assert set(got["query_id"]) == set(want)
    check_recall(got, want, 0.99)
    assert list(got[got["query_id"] == 420].sort_values("rank")["vec_id"])[:3] == list(want[420][0][:3])
    assert ann.neighbours(spark, e.limit(0)).count() == 0
    assert ann.neighbours(spark, e.where("vec_id = 20")).count() == 0


@pytest.mark.parametrize("n", [21, 28, 40])
def test_neighbours_of_small_tables_are_complete(spark, monkeypatch, n):
    rng = np.random.default_rng(n)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(n)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    check_recall(ann.neighbours(spark, e).toPandas(), brute_neighbours(e.toPandas()), 0.99)
    monkeypatch.setattr(ann, "DEPTH", 1)
    got = ann.neighbours(spark, e.union(e.where("vec_id = 20"))).toPandas()
    assert (got.groupby("query_id").size() == 20).all() and set(got["query_id"]) == set(range(0, n, 20))


def test_probing_goes_on_until_the_lists_hold_enough():
    centres, counts = np.array([[float(i), 0] for i in range(6)]), np.array([1, 2, 0, 4, 5, 6])
    lists = ann.probed_lists(np.zeros((3, 2)), centres, counts, 2, np.array([3, 7, 99]))
    assert [x.tolist() for x in lists] == [[0, 1], [0, 1, 2, 3], [0, 1, 2, 3, 4, 5]]


def test_large_lists_are_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP_ROWS", 37)
    monkeypatch.setattr(ann, "GROUP_QUERIES", 7)
    e = table(spark, "embeddings")
    check_recall(ann.neighbours(spark, e).toPandas(), brute_neighbours(e.toPandas()), 0.9)


def test_rotation_by_hand(spark):
    rows = [(1, 2, "bob", "hi <|im_end|>", 0), (1, 0, "system", "be kind", 0), (1, 1, "al ice", None, 0), (2, 0, "system", "alone", 0),
            (None, 5, None, "who", 0), (None, None, "x", "last", 0), (None, 5, None, "who", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, perspective int")
    got = chat.rotate(df).collect()
    texts = {}
    for r in sorted(got, key=lambda r: r.start):
        key = (r.conv_id, r.perspective)
        assert r.start == len(texts.get(key, "")) and r.end - r.start == len(r.segment)
        texts[key] = texts.get(key, "") + r.segment
        if r.speaker == r.perspective:
            assert r.segment[r.mask_start - r.start:r.mask_end - r.start].endswith("<|im_end|>")
        else:
            assert r.mask_start is None and r.mask_end is None
    assert set(texts) == {(1, "bob"), (1, "al ice"), (None, "unknown"), (None, "x")}
    assert texts[(1, "bob")] == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=al_ice\n<|im_end|>\n"
                                 "<|im_start|>assistant\nhi < |im_end|><|im_end|>\n")
    assert texts[(None, "x")].endswith("<|im_start|>assistant\nlast<|im_end|>\n") and texts[(None, "x")].count("who") == 2
    assert chat.rotate(df.limit(0)).count() == 0


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, key):
    sys.path.insert(0, os.path.join(ROOT, "tools"))
    import oracle_check
    status, msg = oracle_check.check(spark, oracle_check.duck(SF), key, queries.QUERIES[key], queries.ORACLE[key], SF)
    assert status == "OK", msg


@pytest.mark.parametrize("size", [1.0, 1e30, 1e39, 1e-30])
def test_neighbours_score_doubles_of_any_size_exactly(spark, size):
    """Double vectors: no component is rounded to a float, none is lost for its size."""
    from gridlens.llm import ann
    x = np.random.default_rng(8).standard_normal((300, 16)) * size
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.neighbours(spark, df, probe_share=1.0).collect()
    dots = x @ x.T
    assert len(got) == 15 * 20
    for r in got:
        assert r["score"] == pytest.approx(dots[r["query_id"], r["vec_id"]], rel=1e-12, abs=1e-13 * size * size)
    for q in range(0, 300, 20):
        want = [i for i in np.lexsort((np.arange(300), -dots[q])) if i != q][:20]
        found = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert len(set(found) & set(want)) >= 18
