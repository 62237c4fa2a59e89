"""The corpus pipeline and its stages against plain Python."""

import collections
import random

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gridlens.llm import langid, minhash
from test_text_ops import brute_sets


def replaced(base, at):
    w = base.split(" ")
    for i in at:
        w[i] = f"z{i}"
    return " ".join(w)


def between(share, n):
    """Two texts of n words whose sets share ``share`` of the union or a little more, and the share."""
    base = " ".join(f"w{random.Random(n).randrange(10 ** 6)}x{i}" for i in range(n))
    cut = round((n - 4) * share)
    other = " ".join(base.split(" ")[:cut + 4])
    a, b = brute_sets(base), brute_sets(other)
    return base, other, len(a & b) / len(a | b)


def brute_groups(texts, percent):
    """Smallest place of each text's group of near-duplicates."""
    sets, group = [brute_sets(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


def near_texts():
    texts = []
    for k, n in enumerate(range(104, 304, 10)):
        for share in (0.78, 0.80, 0.82, 0.84, 0.86):
            a, b, _ = between(share, n + k % 3)
            texts += [f"p{share} " + a.replace("w", f"w{share}"), f"p{share} " + b.replace("w", f"w{share}")]
    return texts


@pytest.mark.parametrize("percent", [80, 85])
def test_the_percentage_of_near_duplicates_against_brute_force(spark, percent):
    texts = near_texts()
    group = brute_groups(texts, percent)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in minhash.deduplicate(spark, df, percent).collect()}
    assert kept == set(group) and len(kept) < len(texts) - 10


def test_the_stage_links_from_four_fifths_on(spark):
    texts = near_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()}
    assert kept == set(brute_groups(texts, 80)) != set(brute_groups(texts, 85))


def test_verification_frames_are_bounded_and_linked_nodes_are_not_paired_again(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 16)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 4000)
    nodes = spark.createDataFrame([(i, 100 + i % 3, 7) for i in range(400)] + [(1000, 50, 8), (1001, 51, 8)], "node long, n long, component long")
    none = spark.createDataFrame([], "node long, cluster long")
    rows = minhash.with_tasks(minhash.block_rows(nodes, none), ["component", "bi", "bj"])
    frames = [(r["c"], r["n"]) for r in rows.groupBy("_task").agg(F.count("*").alias("c"), F.sum("n").alias("n")).collect()]
    assert max(c for c, _ in frames) <= 6 * 16 and max(n for _, n in frames) <= 4 * 4000
    met = {(min(a, b), max(a, b)) for ids in rows.groupBy("component", "bi", "bj").agg(F.collect_list("node").alias("ids")).collect()
           for a in ids.ids for b in ids.ids if a != b}
    assert met == {(a, b) for a in range(400) for b in range(a + 1, 400)} | {(1000, 1001)}
    # 390 linked nodes meet the other 10, not each other
    clusters = spark.createDataFrame([(i, 0) for i in range(390)] + [(1000, 1000), (1001, 1000)], "node long, cluster long")
    rows = minhash.block_rows(nodes, clusters)
    assert rows.where("component = 8").count() == 0 and rows.count() < 2 * 400 + 10 * 40
    met = {(a, b) for ids in rows.groupBy("component", "bi", "bj").agg(F.collect_list("node").alias("ids")).collect() for a in ids.ids for b in ids.ids if a < b}
    assert {(a, b) for a in range(400) for b in range(390, 400) if a < b} <= met
    # members of a hub are dealt into chunks, each with the hub
    edges = spark.createDataFrame([(i, 0, 5) for i in range(1, 400)] + [(1001, 1000, 1)], "u long, v long, shared long")
    chunks = minhash.hub_rows(edges, nodes.select("node", "n")).groupBy("hub", "chunk").agg(
        F.count("*").alias("c"), F.sum(F.expr("CAST(node = hub AS INT)")).alias("centres")).collect()
    assert len(chunks) > 20 and {r.centres for r in chunks} == {1} and max(r.c for r in chunks) <= 40 and sum(r.c - 1 for r in chunks) == 400


# --- every stage, and run() ----------------------------------------------------------

def plain_cut(rows, size=50):
    """Texts without the bytes covered by strings of ``size`` bytes that start in a document of a smaller doc_id."""
    seen, out = {}, []
    for d, t in sorted(rows):
        b = t.encode()
        for i in range(len(b) - size + 1):
            seen.setdefault(b[i:i + size], d)
    for d, t in rows:
        b = t.encode()
        gone = set()
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] < d:
                gone.update(range(i, i + size))
        out.append((d, bytes(c for i, c in enumerate(b) if i not in gone)))
    return out


def plain_leaks(rows, items, n=10):
    """Documents of whose words less than half are in a window of an item, with those words' number."""
    import re
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().lower() if t.isascii() else t.encode().translate(
        bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    windows = {}
    for t in items:
        w = words(t or "")
        for i in range(max(1, len(w) - n + 1)) if w else []:
            windows.setdefault(tuple(w[i:i + n]), 1)
    sizes = {len(w) for w in windows}
    out = {}
    for d, t in rows:
        w = words(t)
        hit = set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
        out[d] = (len(w), len(hit))
    return out


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder of tables: 160 documents and odd rows with columns of clashing names, and the benchmark."""
    sf, folder = "/root/testdata/sf0.001", str(tmp_path_factory.mktemp("small"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("n_chars < 3000").orderBy("doc_id").limit(160)
    odd = [(9001, None, None), (9002, "", "en"), (9003, "123 456.", None), (9004, " \n", "de")]
    copy = docs.orderBy("doc_id").limit(3).select("doc_id", "text", "lang")
    odd = spark.createDataFrame(odd, "doc_id long, text string, lang string").unionByName(copy).withColumns(
        {"source": F.lit("x"), "n_chars": F.lit(1).cast("long")})
    every = docs.unionByName(odd).withColumns({"score": F.lit("s"), "_letters": F.lit(3), "screen": F.lit("c"), "lang_pred": F.lit(None).cast("int")})
    every.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def rows_of(df):
    return sorted((r["doc_id"], r["text"] or "") for r in df.collect())


def test_each_stage_against_a_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    left = corpus_pipeline.language(spark, docs, small)
    assert left.columns == columns
    seen = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in langid.identify(docs.select("doc_id", "text", "lang"), langid.train(docs)).collect()}
    assert rows_of(left) == sorted((r["doc_id"], r["text"]) for r in docs.collect() if seen[r["doc_id"], r["text"]][0] != "und" and seen[r["doc_id"], r["text"]][1] >= 0.4)
    before = rows_of(left)
    assert not {9001, 9002, 9003, 9004} & {d for d, _ in before}
    near = corpus_pipeline.near_duplicates(spark, left, small)
    texts = [t for _, t in before]
    assert near.columns == columns and rows_of(near) == [before[i] for i in sorted(set(brute_groups(texts, 80)))]
    cut = corpus_pipeline.repeated_passages(spark, near, small)
    want = [(d, b.decode("utf-8", "replace")) for d, b in plain_cut(rows_of(near))]
    assert cut.columns == columns and [d for d, _ in rows_of(cut)] == [d for d, t in want if t]
    assert [(d, t) for d, t in rows_of(cut) if "\ufffd" not in t] == [(d, t) for d, t in want if t and "\ufffd" not in t]
    clean = corpus_pipeline.benchmark_leaks(spark, cut, small)
    items = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = plain_leaks(rows_of(cut), items)
    assert clean.columns == columns
    kept = dict(rows_of(clean))
    assert all(kept[d] == t for d, t in rows_of(cut) if not found[d][1])
    assert all(n == 0 for _, n in plain_leaks(list(kept.items()), items).values()) or all(len(kept[d]) < len(t) for d, t in rows_of(cut) if d in kept and found[d][1])
    packed = corpus_pipeline.pack(spark, clean, small).collect()
    tokenizer = __import__("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = collections.Counter()
    for r in packed:
        sizes[r["doc_id"]] += r["length"]
    assert dict(sizes) == {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in rows_of(clean)}


def test_run_is_its_stages_and_takes_empty_tables(spark, small, tmp_path):
    got = corpus_pipeline.run(spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
    assert sorted(map(key, got)) == sorted(map(key, docs.collect())) and got
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
