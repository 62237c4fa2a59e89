"""Benchmark decontamination by a generalised suffix automaton over words.

The normalised items become one automaton of word ids (or several, of bounded
size, when the benchmark is large).  The windows of the items hang on its
states, each on the one that holds it.  Every document is streamed through the
automaton, which tracks the longest match ending at each word and its state;
the windows of that state no longer than the match, and those of the shorter
classes it links to, end there, and their words are hit.  Spans of hit words can
then be cut out, and documents covered beyond a limit dropped.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import discard, stored, worker_cache, workspace

WINDOW = 10
#: Words of benchmark items in one automaton (some tens of MB in a worker).
BLOCK_WORDS = 200_000

# Fixed values of the normal form: A-Z lower-cased, every ASCII character but
# letters and digits separates words.
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TABLE = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORD_BYTES = re.compile(rb"[^ ]+")


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_TABLE).split() if raw else []


class SuffixAutomaton:
    """All substrings of all items: ``step`` maps word id to state, ``link`` to the next shorter class.

    ``windows`` maps a state to its windows (size to item names), ``above`` a
    state to the nearest shorter class that has windows (0: none).
    """

    def __init__(self):
        self.step, self.link, self.length = [{}], [-1], [0]
        self.windows: dict[int, dict[int, set[str]]] = {}
        self.above: list[int] = []

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of q for its strings no longer than p's plus one."""
        copy = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, item: list[int]) -> None:
        last = 0
        for word in item:
            q = self.step[last].get(word)
            if q is not None:  # known from an earlier item
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and word not in self.step[p]:
                self.step[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.step[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = new

    def walk(self, ids):
        """State and length of the longest item substring that ends at each word."""
        step, link, length = self.step, self.link, self.length
        state, n = 0, 0
        for word in ids:
            nxt = step[state].get(word)
            while nxt is None and state:
                state = link[state]
                n = length[state]
                nxt = step[state].get(word)
            if nxt is None:
                n = 0
            else:
                state, n = nxt, n + 1
            yield state, n

    def matches(self, ids):
        """Length of the longest item substring that ends at each word."""
        for _, n in self.walk(ids):
            yield n

    def mark(self, item: list[int], size: int, name: str | None) -> None:
        """Hang each window of ``size`` words of an item on its state; call once all items are added."""
        state, n = 0, 0
        for word in item:
            state, n = self.step[state][word], n + 1
            if n > size:  # one word too many: the class of the last ``size``
                n = size
                if self.length[self.link[state]] >= size:
                    state = self.link[state]
            if n == size:
                names = self.windows.setdefault(state, {}).setdefault(size, set())
                if name is not None:
                    names.add(name)

    def finish(self) -> None:
        """Link every state to the nearest shorter class with windows."""
        self.above = [0] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            shorter = self.link[state]
            self.above[state] = shorter if shorter in self.windows else self.above[shorter]

    def windows_ending(self, state: int, n: int):
        """(size, item names), the longest first, of the windows that end where ``walk`` is in ``state`` with a match of ``n``."""
        while state:
            here = self.windows.get(state)
            if here:
                for size in sorted(here, reverse=True):
                    if size <= n:
                        yield size, here[size]
            state = self.above[state]


class Screen:
    """One block of items, ready to screen documents."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.vocabulary, self.automaton = {}, SuffixAutomaton()
        known = []
        for name, raw in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(raw)]
            if ids:
                self.automaton.add(ids)
                known.append((ids, min(window, len(ids)), name))
        for ids, size, name in known:
            self.automaton.mark(ids, size, name)
        self.automaton.finish()
        self.shortest = min((size for _, size, _ in known), default=0)

    def screen(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit windows (first word, end) and the items whose windows occur."""
        spans, items = [], set()
        if not self.shortest or len(words) < self.shortest:
            return spans, items
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        # a match is inside a run of words that items know; shorter runs can't hold a window
        edge = np.flatnonzero(np.diff(np.concatenate([[0], ids >= 0, [0]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        keep = ends - starts >= self.shortest
        for a, b in zip(starts[keep].tolist(), ends[keep].tolist()):
            for end, (state, n) in enumerate(self.automaton.walk(ids[a:b].tolist()), a + 1):
                if n < self.shortest:
                    continue
                longest = 0
                for size, names in self.automaton.windows_ending(state, n):
                    longest = longest or size
                    items |= names
                if longest:  # the shorter ones are inside it
                    spans.append((end - longest, end))
        return spans, items


def cut_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the hit words and what stands between them."""
    at = [m.span() for m in _WORD_BYTES.finditer(raw.translate(_TABLE))]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done:at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]])


def merge(spans) -> list[list[int]]:
    merged = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged


def _screener(key: str, items, window: int, carry: list[str], last: bool):
    """Adds one block's spans and items to each row's; the last block also cuts and counts."""
    def run(batches):
        kept = worker_cache("decontam")
        if key not in kept:
            kept.clear()  # one automaton in a worker
            kept[key] = Screen(items.value, window)
        screen = kept[key].screen
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            out = []
            for raw, spans, items_before in zip(cols["_text"].to_pylist(), cols["_spans"].to_pylist(), cols["_items"].to_pylist()):
                words = words_of(raw)
                found, names = screen(words)
                spans = merge([*found, *map(tuple, spans)])
                names = sorted(names.union(items_before))
                row = {"spans": spans, "items": names}
                if last:
                    row |= {"n_words": len(words), "n_hit": sum(b - a for a, b in spans), "clean_text": cut_spans(raw, spans) if spans else None,
                            "items_sha256": hashlib.sha256(",".join(names).encode()).hexdigest()}
                out.append(row)
            pairs, strings = pa.list_(pa.list_(pa.int32())), pa.list_(pa.string())
            new = {"_spans": pa.array([r["spans"] for r in out], pairs), "_items": pa.array([r["items"] for r in out], strings)}
            if last:
                new |= {"_words": pa.array([r["n_words"] for r in out], pa.int64()), "_hit": pa.array([r["n_hit"] for r in out], pa.int64()),
                        "_sha": pa.array([r["items_sha256"] for r in out], pa.string()),
                        "_clean": pa.array([r["clean_text"] for r in out], pa.binary()).cast(pa.string())}
            else:
                new["_text"] = cols["_text"]
            if carry:
                new["_doc"] = cols["_doc"]
            yield pa.RecordBatch.from_arrays([new[n] for n in sorted(new)], names=sorted(new))
    return run


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.where("text IS NOT NULL").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("raw"))


def _n_blocks(benchmark: DataFrame, block_words: int) -> int:
    """Blocks of about ``block_words`` words, at six bytes a word."""
    total = _items(benchmark).agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    return max(1, -(-total // (6 * block_words)))


def _block(benchmark: DataFrame, i: int, n: int) -> list[tuple[str | None, bytes]]:
    rows = _items(benchmark).where(F.pmod(F.xxhash64("item_id", "raw"), F.lit(n)) == i)
    return [(r.item_id, bytes(r.raw)) for r in rows.toLocalIterator()]


def screen_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                     carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` of ``docs`` (all by default) and a struct ``screen``:
    n_words, n_hit, spans, items, items_sha256, clean_text (null where nothing is hit).

    Null text has no words; items without words, or null, have no window; an
    item without an id hits, but is not listed; an empty benchmark hits
    nothing, an empty table gives no row.  Rows are screened each for itself, so
    repeated rows and null ids are kept, and a text of any length streams
    through the automaton; columns may have any name but ``screen``.
    """
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_doc"), F.array().cast("array<string>").alias("_items"),
                       F.array().cast("array<array<int>>").alias("_spans"), F.col("text").cast("binary").alias("_text"))
    doc = work.schema["_doc"].dataType.simpleString()
    blocks = list(range(_n_blocks(benchmark, block_words)))
    before = None
    for i in blocks:
        last = i == blocks[-1]
        handle = spark.sparkContext.broadcast(_block(benchmark, i, len(blocks)))  # about block_words words at most
        kind = {"_doc": doc, "_items": "array<string>", "_spans": "array<array<int>>"}
        kind |= {"_words": "long", "_hit": "long", "_sha": "string", "_clean": "string"} if last else {"_text": "binary"}
        work = work.mapInArrow(_screener(uuid.uuid4().hex, handle, window, carry, last), ", ".join(f"{k} {kind[k]}" for k in sorted(kind)))
        if not last:  # a pass per block over a stored table: one automaton in a worker at a time
            path = workspace(spark, "screened")
            work = stored(work, path)
            if before is not None:
                discard(spark, before)
            before = path
    return work.select("_doc.*", F.struct(
        F.col("_words").alias("n_words"), F.col("_hit").alias("n_hit"), F.col("_spans").alias("spans"), F.col("_items").alias("items"),
        F.col("_sha").alias("items_sha256"), F.col("_clean").alias("clean_text")).alias("screen"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items that occur (the rows of the registered query)."""
    got = screen_documents(docs, benchmark, carry=["doc_id"])
    return got.select("doc_id", "screen.n_words", "screen.n_hit", F.size("screen.items").cast("long").alias("n_items"),
                      "screen.items_sha256", (F.col("screen.n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without hit spans; documents covered beyond ``max_coverage`` are dropped."""
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    got = screen_documents(rows, benchmark, carry=["_row"]).where(F.col("screen.n_hit") <= max_coverage * F.col("screen.n_words"))
    hit, clean = F.col("screen.n_hit") > 0, F.col("screen.clean_text")
    new = {"text": clean, "n_chars": F.length(clean)}
    return got.select(*[(F.when(hit, new[c].cast(docs.schema[c].dataType)).otherwise(F.col(f"_row.`{c}`")) if c in new
                         else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CONTAMINATION_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), v AS (
  SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
), g AS (
  SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT r, ws, n, unnest(range(1, greatest(1, len(ws) - n + 2))) AS i FROM d, (SELECT DISTINCT n FROM v))
), h AS (SELECT g.r, g.i, g.n, v.item FROM g JOIN v ON g.n = v.n AND g.win = v.win),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM h GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""
