"""Operators on texts against brute force on small tables with nulls, ties, repeated rows and clashing columns."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridlens.llm import decontam, minhash, packing, seekable, sharding, suffix
from gridlens.llm.tokens import BYTE_UNITS, WORD_UNITS, UnitEncoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _doc string, part int, key string, screen int"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "thention", "onal", "émile", "wher", "st", "and", "ing", "x1"]) + rng.choice(["", "", ",", ".", "\n"])
                    for _ in range(n))


def rows():
    base, other = words(1, 120), words(2, 90)
    near = base.split(" ")
    near[40] = "changed"
    texts = [(5, base), (3, base), (9, " ".join(near)), (9, " ".join(near)), (7, other), (11, other + " tail of its own"), (None, base),
             (13, None), (14, ""), (15, "   \n"), (16, "short"), (17, "a b c d"), (18, "A  b C d"), (19, "ab " * 400), (20, "ab " * 400 + "x"),
             (21, words(3, 6000) + base), (22, words(4, 10) + base[50:300] + words(5, 30)), (5, other[:200]), (23, "çé" * 60), (24, "é" + "çé" * 60),
             (25, "1234 5678 !!"), (-4, other)]
    return [(d, t, "en", "s", None if t is None else len(t), "clash", 1, "k", 2) for d, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- tokens, files, packing -----------------------------------------------------

TRICKY = ["", " ", "a  b\n\n c\x1c!\x1c d e <|endoftext|> x<|startoftext|>y", "it's  'S n't \t\ttab  ", "é é éx ́a ΑΣ Σ İI", " lead", "\n\nx",
          " \n y  ", "don't,'s ,'ll", "ab1c2 áb", "<|ENDOFTEXT|> Ab<|endoftext|>", "a b c　 d", "ﬁ Å K ſ", "x" * 3000, "日本 語\n 문장"]


@pytest.mark.parametrize("name, units, lower", [("word_bpe_49k.json", WORD_UNITS, True), ("byte_bpe_50k.json", BYTE_UNITS, False)])
def test_units_give_the_ids_of_the_whole_text(name, units, lower):
    path = public_tokenizers.path(name)
    plain, mine = Tokenizer.from_file(path), UnitEncoder(path, units, lower)
    rng = random.Random(3)
    marks = ["'s", "'", " ", "  ", "\n", "\t", "\x1d", "É", "é", "σΣ", "12", "word", "Word", ",", "<|endoftext|>", " ", "🙂"]
    for text in TRICKY + ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 14))) for _ in range(1500)]:
        assert mine.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def expected_ids(name, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: np.array([*(t.encode(text, add_special_tokens=False).ids if text else []), end], "<u4").tobytes()


def test_token_files_round_trip(spark, docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = expected_ids("word_bpe_49k.json", 1)
    got = seekable.token_digest(spark, docs, path).collect()
    want = [(r[0], len(ids(r[1])) // 4, zlib.crc32(ids(r[1]))) for r in rows()]
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter(want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # ascending doc_id, null first, gapless
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert seekable.token_digest(spark, empty, path).count() == 0


def test_only_requested_frames_are_read(spark, docs, tmp_path):
    writer_file = tmp_path / "x.zst"
    with open(writer_file, "wb") as out:
        w = seekable.FrameWriter(out, frame_bytes=64)
        for d in [None, 1, 2, 2, 2, 7, 9]:
            w.add(d, struct.pack("<10I", *range(10)) if d != 7 else b"")
        w.close()
    import zstandard
    with open(writer_file, "rb") as f:
        reader = seekable.FrameReader(f)
        read = [reader.frame(i) for i in range(len(reader.seek))]
        assert [d for part in read for d, _ in part] == [None, 1, 2, 2, 2, 7, 9]
        for wanted in ([2], [1], [7], [9], [3], [0, 100]):
            frames = reader.frames_of(wanted)
            found = [d for i in frames for d, _ in reader.frame(i) if d in wanted]
            assert found == [d for d in [1, 2, 2, 2, 7, 9] if d in wanted]
        assert len(reader.frames_of([9])) < len(reader.seek)
    # any zstandard reader passes over the tables
    with open(writer_file, "rb") as f:
        plain = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert len(plain) == sum(s[1] for s in reader.seek)
    raw = bytearray(writer_file.read_bytes())
    raw[20] ^= 1
    (tmp_path / "bad.zst").write_bytes(raw)
    with open(tmp_path / "bad.zst", "rb") as f, pytest.raises(Exception):
        list(seekable.FrameReader(f).frame(0))
    from gridlens.llm.common import workspace
    manifest = seekable.write_tokens(docs, workspace(spark, "t"), public_tokenizers.path("word_bpe_49k.json"))
    ids = expected_ids("word_bpe_49k.json", 1)
    got = seekable.fetch(manifest, spark.createDataFrame([(9,), (21,), (4,)], "doc_id long")).collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in got) == sorted((r[0], ids(r[1])) for r in rows() if r[0] in (9, 21))


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(5)
    for _ in range(200):
        sizes = [rng.randrange(1, 33) for _ in range(rng.randrange(0, 60))]
        placed, n = packing.best_fit_decreasing(sizes, 32)
        rooms, at = [], {}
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):  # brute force: same rooms, tightest first
            fit = [r for r in rooms if r >= sizes[k]]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - sizes[k])
            else:
                rooms.append(32 - sizes[k])
        used = collections.defaultdict(list)
        for s, (w, o) in zip(sizes, placed):
            used[w].append((o, s))
        assert n == len(rooms) == len(used)
        for parts in used.values():
            end = 0
            for o, s in sorted(parts):
                assert o == end
                end += s
            at[end] = at.get(end, 0) + 1
        assert collections.Counter(32 - e for e in at for _ in range(at[e])) == collections.Counter(rooms)


def test_packing_places_every_id_once(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = expected_ids("byte_bpe_50k.json", 0)
    got = packing.pack_documents(docs, path, block_ids=3000).collect()
    by_doc = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in got:
        by_doc[(r.doc_id, r.doc_tokens)].append((r.start, bytes(r.ids)))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.length == len(r.ids) // 4
    want = collections.Counter((r[0], len(ids(r[1])) // 4, ids(r[1])) for r in rows())
    for (doc, n), parts in by_doc.items():
        copies = sum(c for (d, m, _), c in want.items() if (d, m) == (doc, n))
        whole = b"".join(x for _, x in sorted(parts)[::copies]) if copies > 1 and len(set(parts)) < len(parts) else b"".join(x for _, x in sorted(parts))
        assert (doc, n, whole) in want
    assert sum(r.length for r in got) == sum(len(k[2]) // 4 * c for k, c in want.items())
    for parts in sequences.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 1024
    assert packing.pack_digest(empty, path).count() == 0


@pytest.mark.parametrize("partitions", [1, 211])
def test_little_padding_however_the_rows_are_dealt(spark, partitions):
    path = public_tokenizers.path("byte_bpe_50k.json")
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack_digest(table.repartition(partitions), path).collect()
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0 and sum(parts[-1]) <= 1024
    total = sum(r.length for r in got)
    assert 1 - total / (1024 * len(sequences)) <= 0.01
    assert total == sum({(r.doc_id, r.doc_tokens): r.doc_tokens for r in got}.values())


def test_memo_generations_change_no_ids(monkeypatch):
    from gridlens.llm import tokens
    monkeypatch.setattr(tokens, "MEMO_UNITS", 20)
    mine = tokens.UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"), tokens.BYTE_UNITS)
    texts = ["", None, "a <|endoftext|> b", *[" ".join(f"word{i * j % 37} and" for j in range(9)) for i in range(40)]]
    whole = [np.array(mine.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(mine.encode_many(texts)) == whole and [mine.encode(t) for t in texts] == whole
    assert len(mine.memo) + len(mine.memo.old) < 120


# --- sharding ---------------------------------------------------------------------

def brute_position(i, n, seed):
    import xxhash
    a, b = sharding.radices(n)

    def h(key, value):
        first = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        out = xxhash.xxh64_intdigest(struct.pack("<q", value), first)
        return out - (1 << 64) if out >> 63 else out

    while True:
        left, right = divmod(i, b)
        for k in range(sharding.ROUNDS):
            if k % 2 == 0:
                left = (left + h(seed * sharding.ROUNDS + k, right) % a) % a
            else:
                right = (right + h(seed * sharding.ROUNDS + k, left) % b) % b
        i = left * b + right
        if i < n:
            return i


def test_sharding_against_brute_force(spark, docs, empty):
    got = sharding.shard_documents(spark, docs, shards=4, seed=9).collect()
    n = len(rows())
    assert sorted(r.row_no for r in got) == list(range(n)) == sorted(r.position for r in got)
    assert all(r.position == brute_position(r.row_no, n, 9) and (r.shard, r.slot) == (r.position % 4, r.position // 4) for r in got)
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows())
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    order = sorted(got, key=lambda r: r.row_no)
    assert [r.doc_id for r in order] == sorted([r[0] for r in rows()], key=lambda d: (d is not None, d or 0))
    places = spark.createDataFrame([(r.shard, r.slot, r.row_no) for r in got], "shard int, slot long, want long")
    back = sharding.row_at(spark, places, n, 4, 9).collect()
    assert all(r.row_no == r.want for r in back)
    assert sharding.shard_documents(spark, empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_of_any_size(spark, n):
    df = sharding.permute(spark.range(n), "id", "p", n, 5)
    assert sorted(r.p for r in df.collect()) == list(range(n))


# --- repeats and near-duplicates ------------------------------------------------------

def brute_repeats(data):
    starts = collections.defaultdict(list)
    for d, t in data:
        t = (t or "").encode()
        if d is not None:
            for p in range(len(t) - 49):
                starts[t[p:p + 50]].append(d)
    out = []
    for d, t in data:
        t = (t or "").encode()
        hit = bytearray(len(t))
        if d is not None:
            for p in range(len(t) - 49):
                if min(starts[t[p:p + 50]]) < d:
                    hit[p:p + 50] = b"\1" * 50
        runs = [m.span() for m in re.finditer(b"\1+", bytes(hit))]
        out.append((d, len(t), sum(hit), len(runs), hashlib.sha256(suffix.cut(t, runs)).hexdigest()))
    return collections.Counter(out)


def as_counter(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_repeats_against_brute_force(spark, docs, empty):
    assert as_counter(suffix.repeats(spark, docs)) == brute_repeats([(r[0], r[1]) for r in rows()])
    assert suffix.repeats(spark, empty).count() == 0


def test_repeats_of_small_alphabets_and_long_texts(spark, monkeypatch):
    rng = random.Random(8)
    stock = ["".join(rng.choice("ab") for _ in range(rng.randrange(30, 90))) for _ in range(12)] + ["a" * 70, "ab" * 40, "abc" * 30]
    data = [(i, "".join(rng.choice(stock) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    data += [(60, words(9, 20000)), (61, words(9, 20000)[1000:90000] + "z"), (62, "q" + words(9, 15000)[40000:])]
    got = suffix.repeats(spark, spark.createDataFrame(data, "doc_id long, text string").repartition(5))
    assert as_counter(got) == brute_repeats(data)


def test_long_texts_are_worked_on_in_overlapping_pieces(monkeypatch):
    text = words(12, 3000).encode()
    monkeypatch.setattr(suffix, "PIECE", 700)
    s = [suffix.Stretch(p) for p in suffix.pieces([text, b"x" * 20, text[:300]])]
    seen = sorted((int(r), int(p)) for g in s for r, a, b, sh in zip(g.row, g.p1, g.p2, g.shift) for p in range(a + sh, b + sh + 1))
    assert seen == [(0, p) for p in range(len(text) - 49)] + [(2, p) for p in range(251)]


def test_remove_repeats_keeps_rows_and_columns(spark, docs, empty):
    got = suffix.remove_repeats(spark, docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    text = {(r.doc_id, r.n_chars): r.text for r in got.collect()}
    assert text[(9, 0)] != "" if (9, 0) in text else True
    assert [r.text for r in got.where("doc_id = 5").orderBy("n_chars").collect()][0] == ""  # copy of 3
    assert got.where("doc_id = 13").first().text is None
    assert suffix.remove_repeats(spark, empty).count() == 0


def brute_sets(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_near(data):
    sets = [brute_sets(t) for _, t in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(data):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    out = []
    for i, (d, _) in enumerate(data):
        c = least.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return collections.Counter(out)


def edited(seed, base, k):
    rng = random.Random(seed)
    w = base.split(" ")
    for _ in range(k):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_near_duplicates_against_brute_force(spark, docs, empty):
    assert as_counter(minhash.duplicates(spark, docs)) == brute_near([(r[0], r[1]) for r in rows()])
    assert minhash.duplicates(spark, empty).count() == 0


def test_a_large_group_in_blocks(spark, monkeypatch):
    base = " ".join(f"w{i}" for i in range(150))
    data = [(1000 - i, edited(i, base, i % 9)) for i in range(150)] + [(2000 + i, " ".join(f"v{i}_{j}" for j in range(30))) for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    want = brute_near(data)
    assert as_counter(minhash.duplicates(spark, df)) == want
    monkeypatch.setattr(minhash, "BLOCK_NODES", 16)
    assert as_counter(minhash.duplicates(spark, df)) == want


def test_registers_estimate_similarity_and_merge():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 64, 800, dtype=np.uint64)
    b = np.concatenate([a[:600], rng.integers(0, 1 << 64, 100, dtype=np.uint64)])  # similarity 600/900
    ra, rb, rab, r1 = minhash.sketch([np.unique(a), np.unique(b), np.unique(np.concatenate([a, b])), np.unique(a[:300])])
    assert (np.maximum(ra, rb) == rab).all() and (r1 <= ra).all()
    plus, equal = (ra > rb).sum(), (ra == rb).sum()
    grid = np.linspace(0.01, 0.86, 400)
    slope = np.array([minhash._log_slope(plus, len(ra) - plus - equal, equal, 800.0, 700.0, j) for j in grid])
    assert abs(grid[np.argmin(abs(slope))] - 2 / 3) < 0.12


def test_deduplicate_keeps_one_row_of_each_group(spark, docs, empty):
    got = minhash.deduplicate(spark, docs)
    assert got.columns == docs.columns
    want = brute_near([(r[0], r[1]) for r in rows()])
    with_words = {c for (_, n, c, _) in want if n}
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i not in (13, 14, 15)) == sorted(with_words) and {13, 14, 15} <= set(ids)
    assert minhash.deduplicate(spark, empty).count() == 0


# --- decontamination ------------------------------------------------------------------

ITEMS = [(1, "the quick brown fox jumps over the lazy dog near a river bank"), (2, "Short item-here"), (10, "one TWO three four five six seven eight nine ten"),
         (3, None), (4, "!!"), (None, "two three four five six seven eight nine ten eleven"), (1, "the quick brown fox jumps over the lazy dog near a river bank")]


def leak_rows():
    t = ["Prefix The quick, brown fox jumps over the lazy dog: near! tail", "the quick brown fox jumps over the lazy", "x one two three four five six seven eight nine ten eleven y",
         "say short item here and short item", None, "", "été " * 50, "one two three four five six seven eight nine ten " * 3,
         "the quick brown fox jumps over the lazy dog near a river bank the quick brown fox", "short\nITEM\there"]
    return [(i, x, "en", "s", None if x is None else len(x), "c", 1, "k", 7) for i, x in enumerate(t)] + [(3, t[3], "en", "s", 1, "c", 1, "k", 7), (None, t[0], "en", "s", 1, "c", 1, "k", 7)]


def brute_leaks(data, items):
    pattern = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    norm = lambda t: pattern.findall((t or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = norm(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].update([] if i is None else [str(i)])  # an item without an id hits, but is not listed
    out = []
    for d, t in data:
        w = norm(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                got = windows.get(tuple(w[k:k + n]))
                if got is not None:
                    hit.update(range(k, k + n))
                    found |= got
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return collections.Counter(out)


def test_contamination_against_brute_force(spark):
    docs = spark.createDataFrame(leak_rows(), SCHEMA).repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute_leaks([(r[0], r[1]) for r in leak_rows()], ITEMS)
    assert as_counter(decontam.contamination(docs, bench)) == want
    parts = decontam.screen_documents(docs, bench, block_words=12, carry=["doc_id"])  # several automata
    got = parts.select("doc_id", "screen.n_words", "screen.n_hit", F.size("screen.items"), "screen.items_sha256", F.col("screen.n_hit") > 0)
    assert as_counter(got) == want
    none = decontam.contamination(docs, bench.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(leak_rows())
    assert decontam.contamination(docs.limit(0), bench).count() == 0


def test_automaton_tracks_longest_matches():
    rng = random.Random(2)
    for _ in range(60):
        items = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(1, 5))]
        auto = decontam.SuffixAutomaton()
        for item in items:
            auto.add(item)
        subs = {tuple(x[i:j]) for x in items for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
        text = [rng.randrange(3) for _ in range(40)]
        want = [max(n for n in range(j + 2) if n == 0 or tuple(text[j + 1 - n:j + 1]) in subs) for j in range(len(text))]
        assert list(auto.matches(text)) == want


def test_windows_hang_on_the_states_that_hold_them():
    """Items shorter and longer than a window, parts of each other and repeated: every window that occurs, and no other."""
    rng = random.Random(5)
    for _ in range(200):
        size = rng.randrange(1, 6)
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))).encode()) for i in range(rng.randrange(1, 7))]
        windows = collections.defaultdict(set)
        for name, raw in items:
            w = raw.split()
            n = min(size, len(w))
            for k in range(len(w) - n + 1 if n else 0):
                windows[tuple(w[k:k + n])].add(name)
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)]
        hit, names = set(), set()
        for i in range(len(text)):
            for n in range(1, size + 1):
                got = windows.get(tuple(text[i:i + n])) if i + n <= len(text) else None
                if got:
                    hit |= set(range(i, i + n))
                    names |= got
        spans, found = decontam.Screen(items, size).screen(text)
        assert {p for a, b in spans for p in range(a, b)} == hit and found == names


def test_decontaminate_cuts_spans_and_drops_covered_documents(spark):
    docs = spark.createDataFrame(leak_rows(), SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.decontaminate(docs, bench)
    assert got.columns == docs.columns
    text = {r.doc_id: r.text for r in got.collect()}
    assert text[1] == leak_rows()[1][1] and text[6] == leak_rows()[6][1] and 4 in text and 7 not in text and 9 not in text
    again = decontam.contamination(got, bench)
    assert again.where("contaminated").count() == 0


def test_stored_leaves_no_shuffle_files(spark):
    """What a stored table shuffled is deleted with the write, not when the driver collects its garbage; the setting is restored."""
    import gc
    import time

    from gridlens.llm.common import CLEANUP, stored, workspace

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in files if "/shuffle_" in f}
    rows = spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count()
    before, set_before = shuffled(), spark.conf.get(CLEANUP, None)
    gc.disable()
    try:
        assert stored(rows, workspace(spark, "shuffles") + "/rows").count() == 1000
        for _ in range(50):
            left = {f for f in shuffled() - before if f.endswith(".data")}
            if len(left) <= 4:  # those of the count
                break
            time.sleep(0.1)
    finally:
        gc.enable()
    assert len(left) <= 4 and spark.conf.get(CLEANUP, None) == set_before
