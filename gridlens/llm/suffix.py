"""Repeated byte strings across documents by distributed prefix doubling.

Positions get ranks for growing lengths: equal strings of a length share a
rank, and the rank of a longer string is the pair of its parts' ranks at an
offset.  Each round sends rank pairs to the partition of their rank, sorts them
there and hands the answer back; positions whose string is in one document only
drop out.  Since only equality matters, a rank is a 64-bit name of the string.

Round 1 ranks 25-byte strings.  A window of 50 bytes has 26 of them, and the
one of least name (its anchor) is the same wherever the window occurs, so
anchors, one position in 13, stand for all positions.
Round 2 ranks the whole stretch of windows that share an anchor (up to 75
bytes): if a smaller document has the same stretch, all its windows repeat.
Only where an anchor occurs in several different stretches (where copies begin,
end or were edited) do single positions go on.
Round 3 doubles their ranks: a window is the pair of 25-byte ranks at offsets 0
and 25, 50 bytes, past the threshold.

Before anything is sent, a batch of documents answers for itself what it can:
of equal strings only that of its smallest document asks, so a string in a
third of all documents makes one question per batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm.common import discard, releasing, stored, workspace

WIDTH = 50
GRAM = 25
WINDOW = WIDTH - GRAM + 1
#: Bytes worked on at once; positions in a piece fit 20 bits.
PIECE, ROOM = 1 << 19, 1 << 20
#: Bytes of text whose questions a task gathers before it sends them.  (In round 3 a byte may ask.)
BATCH_BYTES, BATCH_BYTES_OPEN = 4 << 20, 1 << 20
#: Questions that one partition sorts, about.
PART_ENTRIES = 500_000

_U = np.uint64
_RNG = np.random.default_rng(424242)
_BYTE = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
_POWER = int(_RNG.integers(0, 1 << 62)) * 2 + 1
_LOW = _U(ROOM - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * _U(pow(base, len(out), 1 << 64))])
    return out[:n]


_UP, _DOWN = _powers(_POWER, 2 * ROOM), _powers(pow(_POWER, -1, 1 << 64), 2 * ROOM)


def _mix(x):
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def pieces(texts: list[bytes]):
    """Lists of (row, offset, bytes) of at most ``ROOM`` bytes; long texts overlap by one window less a byte."""
    now, size = [], 0
    for row, text in enumerate(texts):
        if len(text) < WIDTH:
            continue
        for base in range(0, len(text) - WIDTH + 1, PIECE):
            part = text[base:base + PIECE + WIDTH - 1]
            if size + len(part) > ROOM:
                yield now
                now, size = [], 0
            now.append((row, base, part))
            size += len(part)
    if now:
        yield now


class Stretch:
    """The stretches of windows with a common anchor in a list of pieces."""

    def __init__(self, parts):
        sizes = [len(p) for _, _, p in parts]
        b = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
        n = len(b)
        own = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[b] * _UP[:n], out=total[1:])
        self.total = total
        self.gram = _mix((total[GRAM:] - total[:-GRAM]) * _DOWN[:n - GRAM + 1])
        # least name of each window, its place in the low bits: the leftmost of equal ones
        least = (self.gram & ~_LOW) | np.arange(n - GRAM + 1, dtype=np.uint64)
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[:n - WIDTH + 1], least[WINDOW - 16:])
        at = (least & _LOW).astype(np.int64)
        valid = own[:n - WIDTH + 1] == own[WIDTH - 1:]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | ~valid[:-1]
        first = np.flatnonzero(new & valid)
        last = np.ones(len(at), bool)
        last[:-1] = (at[1:] != at[:-1]) | ~valid[1:]
        self.p1, self.p2 = first, np.flatnonzero(last & valid)
        self.anchor = at[first]
        piece = own[first]
        self.row = np.array([r for r, _, _ in parts])[piece]
        starts = np.cumsum([0, *sizes[:-1]])
        #: what turns a place in the pieces into an offset in the document
        self.shift = (np.array([base for _, base, _ in parts]) - starts)[piece]

    def names(self) -> np.ndarray:
        """25-byte rank of each anchor."""
        return self.gram[self.anchor]

    def stretch_names(self) -> np.ndarray:
        """Rank of the stretch around each anchor, with the anchor's place in it."""
        s = (self.total[self.p2 + WIDTH] - self.total[self.p1]) * _DOWN[self.p1]
        return _mix(s + _mix(((self.p2 - self.p1) * 256 + self.anchor - self.p1).astype(np.uint64)))


# --- questions and answers -------------------------------------------------

ASK = "part int, known boolean, k1 binary, k2 binary, doc binary, tid binary, at binary, size binary"
_ASK_ARROW = pa.schema([("part", pa.int32()), ("known", pa.bool_()), *((n, pa.binary()) for n in ("k1", "k2", "doc", "tid", "at", "size"))])
_TYPES = {"k1": np.uint64, "k2": np.uint64, "doc": np.int64, "tid": np.uint32, "at": np.uint32, "size": np.uint8}


def _ask(cols: dict, parts: int):
    """Rows of packed questions, one per partition; of equal (k1, k2) in the batch only the smallest document's asks."""
    k1, k2, doc = cols["k1"], cols["k2"], cols["doc"]
    if not len(k1):
        return
    order = np.lexsort((doc, k2, k1))
    a, b, d = k1[order], k2[order], doc[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    known = np.empty(len(a), bool)
    known[order] = d > d[new][group]
    # of equal rows of the smallest document one asks for all: they get the same answer, so each asks
    part = (_mix(k1) % _U(parts)).astype(np.int32)
    part[known] = (_mix(doc[known].astype(np.uint64)) % _U(parts)).astype(np.int32)
    part = part * 2 + known
    by = np.argsort(part, kind="stable")
    edge = np.flatnonzero(np.diff(part[by])) + 1
    for chunk in np.split(by, edge):
        p = int(part[chunk[0]])
        yield {"part": p // 2, "known": bool(p % 2), **{n: np.ascontiguousarray(cols[n][chunk], t).tobytes() for n, t in _TYPES.items()}}


def _batches(rows):
    rows = list(rows)
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_pylist(rows[i:i + 64], schema=_ASK_ARROW)


def _unpack(table: pa.Table) -> tuple[dict, np.ndarray]:
    cols = {n: np.frombuffer(b"".join(table.column(n).to_pylist()), t) for n, t in _TYPES.items()}
    sizes = [len(x) // 8 for x in table.column("doc").to_pylist()]
    return cols, np.repeat(np.array(table.column("known").to_pylist(), bool), sizes)


ANSWER = "bucket int, doc binary, tid binary, at binary, size binary, k1 binary, open binary"


def _answers(cols: dict, pick: np.ndarray, names: list[str], buckets: int, is_open: np.ndarray | None = None) -> pa.Table:
    """The picked entries, packed in a row for each bucket of documents; other columns are empty."""
    cols = {n: cols[n][pick] for n in ("doc", "tid", *names)}
    cols["open"] = np.ones(len(pick), np.uint8) if is_open is None else is_open.astype(np.uint8)
    bucket = (_mix(cols["doc"].astype(np.uint64)) % _U(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    chunks = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
    out = {"bucket": pa.array([int(bucket[c[0]]) for c in chunks], pa.int32())}
    for n in ("doc", "tid", "at", "size", "k1", "open"):
        out[n] = pa.array([np.ascontiguousarray(cols[n][c]).tobytes() if n in cols else b"" for c in chunks], pa.binary())
    return pa.table(out)


def _by_document(names: list[str]):
    """A bucket's answers as one row per document: its entries, and how many of them are open."""
    def run(table: pa.Table) -> pa.Table:
        types = _TYPES | {"open": np.uint8}
        cols = {n: np.frombuffer(b"".join(table.column(n).to_pylist()), types[n]) for n in ("doc", "tid", "open", *names)}
        order = np.lexsort((cols["tid"], cols["doc"]))
        doc, tid = cols["doc"][order], cols["tid"][order]
        edge = np.flatnonzero((np.diff(doc) != 0) | (np.diff(tid.astype(np.int64)) != 0)) + 1
        first = np.concatenate([[0], edge]).astype(np.int64)
        data = [pa.array(doc[first]), pa.array(tid[first].astype(np.int64))]
        for n in names:
            flat, width = np.ascontiguousarray(cols[n][order]).tobytes(), types[n]().itemsize
            ends = (np.concatenate([first, [len(doc)]]) * width).tolist()
            data.append(pa.array([flat[i:j] for i, j in zip(ends[:-1], ends[1:])], pa.binary()))
        data.append(pa.array(np.add.reduceat(cols["open"][order].astype(np.int64), first)))
        return pa.Table.from_arrays(data, names=["doc_id", "tid", *names, "n"])
    return run


def _classes(k1, k2, doc):
    """Order by (k1, k2, doc), class number of each ordered entry, and each class's least document."""
    order = np.lexsort((doc, k2, k1))
    a, b, d = k1[order], k2[order], doc[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.cumsum(new) - 1, d[new], a[new]


def _round1(buckets: int):
    """Anchors whose 25 bytes are in two documents or more.  (A batch that has a class twice says so: size 1.)"""
    def run(table: pa.Table) -> pa.Table:
        cols, known = _unpack(table)
        ask = np.flatnonzero(~known)
        order, group, least, _ = _classes(cols["k1"][ask], cols["k2"][ask], cols["doc"][ask])
        doc = cols["doc"][ask][order]
        most = np.zeros(len(least), np.int64)
        most[group] = doc  # the last of each class
        several = most > least
        np.logical_or.at(several, group, cols["size"][ask][order] > 0)
        pick = np.concatenate([np.flatnonzero(known), ask[order][several[group]]])
        return _answers(cols, pick, ["k1"], buckets)
    return run


def _round2(buckets: int):
    """Stretches that a smaller document has (size + 100), and those of anchors with several stretches (to go on)."""
    def run(table: pa.Table) -> pa.Table:
        cols, known = _unpack(table)
        ask = np.flatnonzero(~known)
        order, group, least, rank = _classes(cols["k1"][ask], cols["k2"][ask], cols["doc"][ask])
        later = cols["doc"][ask][order] > least[group]
        alone = np.ones(len(rank), bool)
        alone[1:] &= rank[1:] != rank[:-1]
        alone[:-1] &= rank[1:] != rank[:-1]
        on = ~later & ~alone[group]
        cols["size"] = cols["size"].copy()
        done = np.concatenate([np.flatnonzero(known), ask[order][later]])
        cols["size"][done] += np.uint8(100)
        pick = np.concatenate([done, ask[order][on]])
        return _answers(cols, pick, ["at", "size"], buckets, np.arange(len(pick)) >= len(done))
    return run


def _round3(buckets: int):
    """Windows that a smaller document has."""
    def run(table: pa.Table) -> pa.Table:
        cols, known = _unpack(table)
        ask = np.flatnonzero(~known)
        order, group, least, _ = _classes(cols["k1"][ask], cols["k2"][ask], cols["doc"][ask])
        later = cols["doc"][ask][order] > least[group]
        return _answers(cols, np.concatenate([np.flatnonzero(known), ask[order][later]]), ["at"], buckets)
    return run


# --- passes over the texts ---------------------------------------------------

def _slices(batches, size: int):
    """The same rows in batches of about ``size`` bytes of text (the third column)."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, end - start)
            start = end


def _rows(batch):
    """(doc_id, tid, texts) of a batch whose first columns are doc_id, tid, text."""
    return (np.array(batch.column(0).to_pylist(), np.int64), np.array(batch.column(1).to_pylist(), np.int64).astype(np.uint32),
            [x or b"" for x in batch.column(2).to_pylist()])


def _join(found: list[dict]) -> dict:
    return {n: np.concatenate([f[n] for f in found]) if found else np.zeros(0, t) for n, t in _TYPES.items()}


def _several(k1, doc) -> np.ndarray:
    """Whether each k1 of the batch is in two of its documents or more."""
    order = np.lexsort((doc, k1))
    a, d = k1[order], doc[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    group = np.cumsum(new) - 1
    most = np.zeros(new.sum(), np.int64)
    most[group] = d
    out = np.empty(len(a), bool)
    out[order] = (most > d[new])[group]
    return out


def _pass1(parts: int):
    def run(batches):
        for batch in _slices(batches, BATCH_BYTES):
            doc, tid, texts = _rows(batch)
            found = []
            for group in pieces(texts):
                s = Stretch(group)
                n = len(s.row)
                found.append({"k1": s.names(), "k2": np.zeros(n, np.uint64), "doc": doc[s.row], "tid": tid[s.row],
                              "at": np.zeros(n, np.uint32), "size": np.zeros(n, np.uint8)})
            cols = _join(found)
            cols["size"] = _several(cols["k1"], cols["doc"]).astype(np.uint8)
            yield from _batches(_ask(cols, parts))
    return run


def _pass2(parts: int):
    def run(batches):
        for batch in _slices(batches, BATCH_BYTES):
            doc, tid, texts = _rows(batch)
            flagged = [np.unique(np.frombuffer(x, np.uint64)) for x in batch.column(3).to_pylist()]
            found = []
            for group in pieces(texts):
                s = Stretch(group)
                k1 = s.names()
                keep = np.zeros(len(k1), bool)
                edge = np.flatnonzero(np.diff(s.row)) + 1
                for i, j in zip([0, *edge.tolist()], [*edge.tolist(), len(k1)]):
                    if j > i:
                        f = flagged[s.row[i]]
                        keep[i:j] = f[np.minimum(np.searchsorted(f, k1[i:j]), len(f) - 1)] == k1[i:j] if len(f) else False
                found.append({"k1": k1[keep], "k2": s.stretch_names()[keep], "doc": doc[s.row[keep]], "tid": tid[s.row[keep]],
                              "at": (s.p1 + s.shift)[keep].astype(np.uint32), "size": (s.p2 - s.p1)[keep].astype(np.uint8)})
            yield from _batches(_ask(_join(found), parts))
    return run


def _pass3(parts: int):
    def run(batches):
        for batch in _slices(batches, BATCH_BYTES_OPEN):
            doc, tid, texts = _rows(batch)
            found = []
            for row, (at, size) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                at, size = np.frombuffer(at, np.uint32).astype(np.int64), np.frombuffer(size, np.uint8)
                at, size = at[size < 100], size[size < 100].astype(np.int64)
                # every window of the open stretches, as two 25-byte ranks
                p = np.repeat(at, size + 1) + (np.arange(int((size + 1).sum())) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1))
                for base in range(0, len(texts[row]) - WIDTH + 1, PIECE):
                    here = p[(p >= base) & (p < base + PIECE)] - base
                    if not len(here):
                        continue
                    b = np.frombuffer(texts[row][base:base + PIECE + WIDTH - 1], np.uint8)
                    total = np.zeros(len(b) + 1, np.uint64)
                    np.cumsum(_BYTE[b] * _UP[:len(b)], out=total[1:])
                    rank = lambda q: _mix((total[q + GRAM] - total[q]) * _DOWN[q])  # noqa: B023, E731
                    n = len(here)
                    found.append({"k1": rank(here), "k2": rank(here + WIDTH - GRAM), "doc": np.full(n, doc[row]), "tid": np.full(n, tid[row]),
                                  "at": (here + base).astype(np.uint32), "size": np.zeros(n, np.uint8)})
            yield from _batches(_ask(_join(found), parts))
    return run


def merge_windows(starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Maximal runs covered by [start, end) intervals."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)
    return np.stack([s[new], e[last]], axis=1).tolist()


def _spans(batches):
    for batch in batches:
        out = []
        for at, size, single in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            at, size = np.frombuffer(at, np.uint32).astype(np.int64), np.frombuffer(size, np.uint8).astype(np.int64)
            whole = size >= 100
            one = np.frombuffer(single or b"", np.uint32).astype(np.int64)
            starts = np.concatenate([at[whole], one])
            out.append(merge_windows(starts, np.concatenate([at[whole] + size[whole] - 100, one]) + WIDTH))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.list_(pa.int64())))], names=["doc_id", "tid", "spans"])


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tid (a digest of the text, to tell rows of one doc_id apart), bytes of the text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").bitwiseAND(0xFFFFFFFF).alias("tid"), F.col("text").cast("binary").alias("text"))


def repeated_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, tid, spans): byte ranges of every row that repeats strings of a smaller doc_id.

    A row that repeats a whole text of a smaller doc_id has the one span of all
    its bytes.  Rows without a repeat are absent; texts under 50 bytes, empty
    and null texts have none; null doc_ids neither repeat nor are repeated; rows
    of one doc_id do not repeat each other; repeated rows have one entry.
    """
    folder = workspace(spark, "suffix")
    rows = keyed(docs.where("doc_id IS NOT NULL AND octet_length(text) >= 50"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def parts(n):
        return max(1, -(-n // PART_ENTRIES))

    def answered(n, texts, ask, rank, names):
        """Questions of ``texts`` (about ``n``), ranked, and their answers by document."""
        got = texts.mapInArrow(releasing(ask(parts(n))), ASK).groupBy("part").applyInArrow(rank(parts(n)), ANSWER)
        return got.groupBy("bucket").applyInArrow(_by_document(names), "doc_id long, tid long, " + ", ".join(f"{c} binary" for c in names) + ", n long")

    # whole copies need no search: every window is in the smallest doc_id with that text
    narrow = rows.select("doc_id", "tid", F.xxhash64("text").alias("_h"), F.octet_length("text").cast("long").alias("_n"), F.crc32("text").alias("_c"))
    text = ["_h", "_n", "_c"]
    least = narrow.groupBy(*text).agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most")).where("_least < _most")
    least = stored(least.drop("_most"), folder + "/least")  # a table of its own, so that a text's many rows can be dealt to many tasks
    copies = stored(narrow.join(least, text).where("doc_id > _least").select("doc_id", "tid", "_n").distinct(), folder + "/copies")

    flagged = answered(total // 13, rows.select("doc_id", "tid", "text"), _pass1, _round1, ["k1"])
    flagged = stored(flagged.join(copies, ["doc_id", "tid"], "left_anti"), folder + "/flagged")
    n = flagged.agg(F.sum("n")).first()[0] or 0
    second = rows.join(flagged, ["doc_id", "tid"]).dropDuplicates(["doc_id", "tid"]).select("doc_id", "tid", "text", "k1")
    stretches = stored(answered(n, second, _pass2, _round2, ["at", "size"]), folder + "/stretches")
    open_ = stretches.where("n > 0")
    n = open_.agg(F.sum("n")).first()[0] or 0
    third = rows.join(open_, ["doc_id", "tid"]).dropDuplicates(["doc_id", "tid"]).select("doc_id", "tid", "text", "at", "size")
    windows = answered(n * 13, third, _pass3, _round3, ["at"]).select("doc_id", "tid", F.col("at").alias("single"))
    spans = stretches.join(windows, ["doc_id", "tid"], "left").select("doc_id", "tid", "at", "size", "single").mapInArrow(
        _spans, "doc_id long, tid long, spans array<array<long>>").where(F.size("spans") > 0)
    whole = copies.select("doc_id", "tid", F.array(F.array(F.lit(0).cast("long"), F.col("_n"))).alias("spans"))
    spans = stored(spans.unionByName(whole), folder + "/spans")
    discard(spark, *(f"{folder}/{x}" for x in ("least", "copies", "flagged", "stretches")))
    return spans


def cut(text: bytes, spans) -> bytes:
    out, done = [], 0
    for a, b in spans:
        out.append(text[done:a])
        done = b
    return b"".join([*out, text[done:]])


def _digest(batches):
    for batch in batches:
        kept = [cut(t, s) for t, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        sha = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sha], names=["doc_id", "tid", "sha"])


def repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document its bytes, removed bytes and runs, and the digest of what is left (the registered query)."""
    spans = repeated_spans(spark, docs)
    rows = keyed(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    base = rows.select("doc_id", "tid", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       F.sha2(F.coalesce(F.col("text"), F.lit(b"")), 256).alias("sha_all"))
    base = base.join(spans.select("doc_id", "tid", removed.alias("_r"), F.size("spans").cast("long").alias("_s")), ["doc_id", "tid"], "left")
    partly = rows.join(spans, ["doc_id", "tid"]).where(removed < F.octet_length("text")).dropDuplicates(["doc_id", "tid"])
    sha = partly.select("doc_id", "tid", "text", "spans").mapInArrow(_digest, "doc_id long, tid long, sha string")
    base = base.join(sha, ["doc_id", "tid"], "left")
    return base.select("doc_id", "n_bytes", F.coalesce("_r", F.lit(0)).cast("long").alias("n_removed"),
                       F.coalesce("_s", F.lit(0)).cast("long").alias("n_spans"),
                       F.when(F.col("_r") == F.col("n_bytes"), F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("sha", "sha_all")).alias("kept_sha256"))


def _cut_text(batches):
    for batch in batches:
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        # what is left of a character that a span cuts through is dropped with it
        text = [None if t is None else cut(t, s).decode("utf-8", "ignore") if s else t.decode("utf-8", "replace")
                for t, s in zip(cols["_bytes"].to_pylist(), cols["_spans"].to_pylist())]
        yield pa.RecordBatch.from_arrays([cols["_doc"], pa.array(text, pa.string())], names=["_doc", "_text"])


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; all rows and columns stay."""
    spans = repeated_spans(spark, docs)
    names = docs.columns
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"), F.col("doc_id").cast("long").alias("_id"),
                       F.xxhash64("text").bitwiseAND(0xFFFFFFFF).alias("_tid"))
    hit = spans.select(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid"), F.col("spans").alias("_spans"))
    work = work.join(hit, ["_id", "_tid"], "left").select("_doc", F.col("_doc.text").cast("binary").alias("_bytes"), "_spans")
    kind = work.schema["_doc"].dataType.simpleString()
    same = work.where("_spans IS NULL").select("_doc.*")
    changed = work.where("_spans IS NOT NULL").mapInArrow(_cut_text, f"_doc {kind}, _text string")
    cols = [F.col("_text").alias("text") if c == "text" else F.length("_text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars"
            else F.col(f"_doc.`{c}`") for c in names]
    return same.unionByName(changed.select(*cols))
