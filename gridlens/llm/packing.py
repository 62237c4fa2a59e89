"""Best-fit-decreasing packing of documents into fixed windows of tokens.

Every task tokenizes its own rows and packs them in blocks of at most
``BLOCK_IDS`` ids, so memory is bounded by the block.  Within a block overlong
documents are cut into full windows first; the rest go, longest first, each
into the open window with the least room that still holds it, found by a
segment tree indexed by remaining capacity.  The pieces of windows that stay
under-filled, however many tasks there are, are dealt together and packed
once more, by size alone.
"""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import bounded_batches, stored, workspace
from gridlens.llm.tokens import BYTE_UNITS, encoder

BLOCK_IDS = 1 << 22
#: A window with more than this share of its capacity left goes to the second round.
LOOSE = 1 / 64
#: Sequence ids of the second round begin here.
SECOND = 1 << 61


class RoomTree:
    """Open windows by remaining capacity; finds the least capacity >= a size in log time."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves < capacity + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.windows = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i //= 2

    def put(self, room: int, window) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, size: int):
        """(room, window) with the least room >= size, or None."""
        i = size + self.leaves
        while not self.count[i]:
            # climb until a right sibling can hold something
            while i & 1:
                i //= 2
                if i <= 1:
                    return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return room, self.windows[room].pop()


def best_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[tuple[int, int]], int]:
    """(window, offset) of each size (each from 1 to ``capacity``), and the number of windows."""
    tree, placed, windows = RoomTree(capacity), [(0, 0)] * len(sizes), 0
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        got = tree.take(sizes[k])
        if got is None:
            got, windows = (capacity, windows), windows + 1
        room, window = got
        placed[k] = (window, capacity - room)
        if room > sizes[k]:
            tree.put(room - sizes[k], window)
    return placed, windows


def _schema(digest: bool) -> tuple[str, list]:
    """Spark and Arrow types of the pieces; with ``digest`` a crc32 stands for the ids."""
    ids = ("ids_crc32 long", pa.int64()) if digest else ("ids binary", pa.binary())
    return (f"doc_id long, start long, length long, {ids[0]}, doc_tokens long, sequence_id long, offset long",
            [pa.int64(), pa.int64(), pa.int64(), ids[1], pa.int64(), pa.int64(), pa.int64()])


def _rows(rows, digest: bool):
    sql, kinds = _schema(digest)
    names = [x.split()[0] for x in sql.split(", ")]
    for i in range(0, len(rows), 4096):
        part = rows[i:i + 4096]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], t) for j, t in enumerate(kinds)], names=names)


def _packer(tokenizer: str, units: str, end_id: int, capacity: int, block_ids: int, digest: bool):
    end = struct.pack("<I", end_id)
    keep = zlib.crc32 if digest else (lambda ids: ids)

    def pack_block(docs, sequence):
        rows, rest = [], []
        for doc_id, n, full, tail in docs:
            for k, ids in enumerate(full):
                rows.append((doc_id, k * capacity, capacity, ids, n, sequence, 0))
                sequence += 1
            if n > len(full) * capacity:
                rest.append((doc_id, len(full) * capacity, n - len(full) * capacity, tail, n))
        placed, windows = best_fit_decreasing([r[2] for r in rest], capacity)
        room = [capacity] * windows
        for r, (w, _) in zip(rest, placed):
            room[w] -= r[2]
        loose = [x > LOOSE * capacity for x in room]
        rows += [(*r, None, None) if loose[w] else (*r, sequence + w, at) for r, (w, at) in zip(rest, placed)]
        return rows, sequence + windows

    def cut(doc_id, ids):
        n = len(ids) // 4
        full = n // capacity
        return doc_id, n, [keep(ids[4 * k * capacity:4 * (k + 1) * capacity]) for k in range(full)], keep(ids[4 * full * capacity:])

    def pack(batches):
        enc = encoder(tokenizer, units)
        sequence = TaskContext.get().partitionId() << 40
        docs, size = [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode_many(batch.column(1).to_pylist())):
                ids += end
                if docs and size + len(ids) > 4 * block_ids:
                    rows, sequence = pack_block(docs, sequence)
                    yield from _rows(rows, digest)
                    docs, size = [], 0
                docs.append(cut(doc_id, ids))
                size += len(ids)
        rows, sequence = pack_block(docs, sequence)
        yield from _rows(rows, digest)
    return pack


def _repacker(capacity: int, block_ids: int, digest: bool):
    """Best-fit decreasing over the loose pieces of a partition, a block at a time."""
    def run(batches):
        sequence = SECOND + (TaskContext.get().partitionId() << 40)
        rest, size = [], 0

        def packed():
            placed, windows = best_fit_decreasing([r[2] for r in rest], capacity)
            return [(*r[:5], sequence + w, at) for r, (w, at) in zip(rest, placed)], windows
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if rest and size + r[2] > block_ids:
                    rows, windows = packed()
                    yield from _rows(rows, digest)
                    rest, size, sequence = [], 0, sequence + windows
                rest.append(r)
                size += r[2]
        yield from _rows(packed()[0], digest)
    return run


def pack_documents(docs: DataFrame, tokenizer: str, units: str = BYTE_UNITS, end_id: int = 0, capacity: int = 1024,
                   block_ids: int = BLOCK_IDS, digest: bool = False) -> DataFrame:
    """Pieces of all documents with their ids (``digest``: crc32 of them) and places; sequences are padded to ``capacity``.

    A document is the ids of its whole text plus ``end_id`` (null text: only
    that).  ``sequence_id`` is unique over all tasks; offsets in a sequence are
    gapless from 0.  Repeated rows are packed each for itself, null doc_ids are
    kept, other columns are ignored, an empty table gives no row.  A very long
    text is a block of its own, cut into full windows.  The pieces are written
    to the shared folder, from where the second round reads the loose ones.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    sql = _schema(digest)[0]
    first = stored(rows.mapInArrow(_packer(tokenizer, units, end_id, capacity, block_ids, digest), sql), workspace(spark, "packing"))
    loose = first.where("sequence_id IS NULL")
    total = loose.agg(F.sum("length")).first()[0] or 0
    # by hash, so that every block has pieces of all sizes; each block then packs the largest first, in a fixed order
    dealt = loose.repartition(max(1, -(-total // block_ids)), "doc_id", "start", "length").sortWithinPartitions("doc_id", "start", "length", loose.columns[3])
    return first.where("sequence_id IS NOT NULL").unionByName(dealt.mapInArrow(_repacker(capacity, block_ids, digest), sql))


def pack_digest(docs: DataFrame, tokenizer: str, capacity: int = 1024) -> DataFrame:
    """The packed pieces with a digest in place of the ids (the rows of the registered query)."""
    return pack_documents(docs, tokenizer, capacity=capacity, digest=True)
