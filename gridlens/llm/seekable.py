"""Token-ID files of independent zstandard frames with a trailing seek table.

A file is a row of zstandard frames, each with its own content checksum, then
two skippable frames that any zstandard decoder passes over: a document table
(first doc_id, documents and ids of each frame) and the seek table of the
public seekable format (compressed size, size and checksum of each frame,
then the number of frames).  A reader takes the two tables from the end of the
file and decompresses only the frames that hold the documents asked for.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlens.llm.common import filesystem, stored, workspace
from gridlens.llm.tokens import WORD_UNITS, encoder

# Fixed values of the zstandard seekable format.
SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
# Our document table, in a skippable frame of its own.
SKIPPABLE_DOCS = 0x184D2A50

FRAME_BYTES = 1 << 18
MANIFEST = "part int, path string, n_docs long, n_tokens long, first_doc long, last_doc long"
READ = "part int, doc_id long, local_start long, n_tokens long, ids binary"


class FrameWriter:
    """Writes documents in order to one open binary file."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard
        self.out, self.frame_bytes = out, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.docs, self.size, self.seek, self.table = [], 0, [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.docs and self.size + len(ids) > self.frame_bytes:
            self.flush()
        self.docs.append((doc_id, ids))
        self.size += len(ids)

    def flush(self) -> None:
        import xxhash
        n = len(self.docs)
        body = b"".join([
            struct.pack("<I", n),
            np.array([d or 0 for d, _ in self.docs], dtype="<i8").tobytes(),
            bytes(d is None for d, _ in self.docs),
            np.array([len(x) // 4 for _, x in self.docs], dtype="<u4").tobytes(),
            *(x for _, x in self.docs)])
        frame = self.pack.compress(body)
        self.out.write(frame)
        self.seek.append((len(frame), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        first = self.docs[0][0]
        self.table.append((-(1 << 63) if first is None else first, n, self.size // 4))
        self.docs, self.size = [], 0

    def close(self) -> None:
        if self.docs:
            self.flush()
        rows = b"".join(struct.pack("<qIQ", *x) for x in self.table)
        self.out.write(struct.pack("<II", SKIPPABLE_DOCS, len(rows)) + rows)
        seek = b"".join(struct.pack("<III", *x) for x in self.seek) + struct.pack("<IBI", len(self.seek), 0x80, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)


class FrameReader:
    """Reads the tables of one file, then single frames on demand."""

    def __init__(self, file):
        import zstandard
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        end = file.size() if callable(getattr(file, "size", None)) else file.seek(0, 2)
        n, _, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table at the end of the file")
        seek_at = end - 9 - 12 * n
        docs_at = seek_at - 8 - 20 * n
        tables = self._at(docs_at, 20 * n + 8 + 12 * n)
        self.table = [struct.unpack_from("<qIQ", tables, 20 * i) for i in range(n)]
        self.seek = [struct.unpack_from("<III", tables, 20 * n + 8 + 12 * i) for i in range(n)]
        self.place = np.concatenate([[0], np.cumsum([s[0] for s in self.seek], dtype=np.int64)])

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(int(start))
        return self.file.read(int(size))

    def frame(self, i: int):
        """(doc_id, ids) of every document of frame ``i``, checksums verified."""
        import xxhash
        size, length, check = self.seek[i]
        body = self.unpack.decompress(self._at(self.place[i], size), max_output_size=length)
        if len(body) != length or xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} is damaged")
        n, = struct.unpack_from("<I", body)
        ids = np.frombuffer(body, "<i8", n, 4).tolist()
        null = body[4 + 8 * n:4 + 9 * n]
        ends = 4 + 13 * n + 4 * np.cumsum(np.frombuffer(body, "<u4", n, 4 + 9 * n), dtype=np.int64)
        at = 4 + 13 * n
        for d, gone, end in zip(ids, null, ends.tolist()):
            yield (None if gone else d), body[at:end]
            at = end

    def frames_of(self, wanted: list[int]) -> list[int]:
        """Frames that can hold the wanted doc_ids, by the document table alone."""
        first = np.array([t[0] for t in self.table], dtype=np.int64)
        ids = np.array(sorted(wanted), dtype=np.int64)
        lo = np.maximum(np.searchsorted(first, ids, "left") - 1, 0)
        hi = np.searchsorted(first, ids, "right")
        return sorted({i for a, b in zip(lo.tolist(), hi.tolist()) for i in range(a, max(a + 1, b))})


def _writer(folder: str, tokenizer: str, units: str, lower: bool, end_id: int):
    end = struct.pack("<I", end_id)

    def write(batches):
        out, n, total, first, last = None, 0, 0, None, None
        enc = encoder(tokenizer, units, lower)
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.tok.zst"
        for batch in batches:
            if out is None and batch.num_rows:
                fs, path = filesystem(name)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(path, compression=None)
                frames = FrameWriter(out)
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode_many(batch.column(1).to_pylist())):
                ids += end
                frames.add(doc_id, ids)
                n, total = n + 1, total + len(ids) // 4
                first = doc_id if first is None else first
                last = doc_id
        if out is not None:
            frames.close()
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": task.partitionId(), "path": name, "n_docs": n, "n_tokens": total,
                                               "first_doc": first, "last_doc": last}], schema=_arrow_manifest())
    return write


def _arrow_manifest():
    return pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                      ("first_doc", pa.int64()), ("last_doc", pa.int64())])


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, units: str = WORD_UNITS, lower: bool = True,
                 end_id: int = 1) -> DataFrame:
    """Encode whole texts and write them in ascending doc_id order; returns the manifest.

    One file per range of doc_ids.  Only files named in the manifest count: a
    lost or repeated task leaves a file of another name behind, never a mix.
    Null text is empty (only the end id); null doc_ids come first; rows with
    equal doc_id are ordered by text and all kept; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    # the last key only spreads rows of one doc_id over several ranges
    rows = (rows.withColumn("_h", F.xxhash64("text")).withColumn("_n", F.monotonically_increasing_id())
            .repartitionByRange("doc_id", "_h", "_n").sortWithinPartitions("doc_id", "_h", "_n").select("doc_id", "text"))
    return stored(rows.mapInArrow(_writer(folder + "/files", tokenizer, units, lower, end_id), MANIFEST), folder + "/manifest")


def _emit(part, rows):
    return pa.RecordBatch.from_arrays([
        pa.array([part] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()),
        pa.array([r[1] for r in rows], pa.int64()), pa.array([len(r[2]) // 4 for r in rows], pa.int64()),
        pa.array([r[2] for r in rows], pa.binary())], schema=pa.schema([
            ("part", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]))


def _read(batches):
    for batch in batches:
        for part, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fs, p = filesystem(path)
            with fs.open_input_file(p) as f:
                reader, start = FrameReader(f), 0
                for i in range(len(reader.seek)):
                    rows = []
                    for doc_id, ids in reader.frame(i):
                        rows.append((doc_id, start, ids))
                        start += len(ids) // 4
                    yield _emit(part, rows)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids."""
    files = manifest.count()  # one row per file
    base = manifest.select("part", (F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")).alias("base"))
    rows = manifest.select("part", "path").repartition(max(1, files)).mapInArrow(_read, READ)
    return (rows.join(F.broadcast(base), "part")  # one row per file, a few dozen bytes each
            .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids"))


def _fetch(pdf):
    import pandas as pd
    wanted = [int(x) for x in pdf["doc_id"]]
    fs, p = filesystem(pdf["path"].iloc[0])
    keep, found = set(wanted), []
    with fs.open_input_file(p) as f:
        reader = FrameReader(f)
        for i in reader.frames_of(wanted):
            found += [(d, ids) for d, ids in reader.frame(i) if d in keep]
    return pd.DataFrame({"doc_id": [d for d, _ in found], "ids": [x for _, x in found]})


def fetch(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ids of the requested doc_ids only: each is looked up among the files' ranges
    (one row per file), then a touched file gives its tables and single frames."""
    low = -(1 << 63)  # null doc_ids, which can't be asked for, come first
    files = [(r["first_doc"] if r["first_doc"] is not None else low, r["last_doc"] if r["last_doc"] is not None else low, r["path"])
             for r in manifest.orderBy("part").collect()]
    firsts, lasts, paths = (list(x) for x in zip(*files)) if files else ([], [], [])

    def place(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for d in pdf["doc_id"].tolist():
                i = bisect_left(lasts, d)
                while i < len(firsts) and firsts[i] <= d:
                    out.append((d, paths[i]))
                    i += 1
            yield pd.DataFrame(out, columns=["doc_id", "path"])

    ids = wanted.select(F.col("doc_id").cast("long")).where("doc_id IS NOT NULL").distinct()
    return ids.mapInPandas(place, "doc_id long, path string").groupBy("path").applyInPandas(_fetch, "doc_id long, ids binary")


def token_digest(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write, read back, and digest each document's ids (the rows of the registered query)."""
    manifest = write_tokens(docs, workspace(spark, "tokens"), tokenizer, end_id=end_id)
    return read_tokens(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc_of(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
