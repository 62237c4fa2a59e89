"""Language identification by a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on a bounded sample; every
byte position of every text is then labelled with language probabilities,
which are pooled (mean over positions) into the document's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.llm.common import bounded_batches, releasing, worker_cache

#: Training sample: at most this many documents of each language, and slices of each.
DOCS_PER_LANG, SLICES, SLICE_CHARS = 300, 12, 64
#: Bytes of a segment: the network's state starts anew with each.
SEGMENT = 64
HIDDEN, STEPS, BATCH, RATE, SEED = 8, 220, 256, 0.02, 7
#: Segments run side by side, and bytes (whole segments) laid out for it at once.
LANES = 2048
SIDE_BYTES = 1 << 20
UNKNOWN = "und"
TEXT = "_text"


def held_out() -> F.Column:
    """crc32(doc_id as text) mod 5 = 0; false for a null doc_id (which is never learned from either)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x, keep, table, u, h0=None):
    """States of one direction. x, keep: (T, S); table: (256, 3H) input weights; u: (H, 3H)."""
    steps, lanes = x.shape
    n = u.shape[0]
    h = np.zeros((lanes, n), np.float32)
    out = np.empty((steps, lanes, n), np.float32)
    cache = []
    for t in range(steps):
        e, a = table[x[t]], h @ u
        zr = _sigmoid(e[:, :2 * n] + a[:, :2 * n])
        z, r = zr[:, :n], zr[:, n:]
        c = np.tanh(e[:, 2 * n:] + r * a[:, 2 * n:])
        new = (c + z * (h - c)) * keep[t][:, None]
        if h0 is not None:
            cache.append((h, z, r, c, a[:, 2 * n:]))
        h = out[t] = new
    return (out, cache) if h0 is not None else out


def _back(x, keep, table, u, cache, grad):
    """Gradients of input table and recurrent weights by backpropagation through time."""
    n = u.shape[0]
    d_table, d_u = np.zeros_like(table), np.zeros_like(u)
    carry = np.zeros_like(grad[0])
    for t in reversed(range(len(x))):
        h, z, r, c, ac = cache[t]
        g = (grad[t] + carry) * keep[t][:, None]
        dz = g * (h - c) * z * (1 - z)
        dc = g * (1 - z) * (1 - c * c)
        dr = dc * ac * r * (1 - r)
        d_in = np.concatenate([dz, dr, dc], axis=1)
        np.add.at(d_table, x[t], d_in)
        d_a = np.concatenate([dz, dr, dc * r], axis=1)
        d_u += h.T @ d_a
        carry = g * z + d_a @ u.T
    return d_table, d_u


def _softmax(x):
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """Weights of both directions and of the position labeller."""

    NAMES = ("tf", "uf", "tb", "ub", "w", "b")

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.langs = langs
        draw = lambda *s, k: (rng.standard_normal(s) * k).astype(np.float32)
        self.tf, self.tb = draw(256, 3 * hidden, k=0.3), draw(256, 3 * hidden, k=0.3)
        self.uf, self.ub = draw(hidden, 3 * hidden, k=0.3), draw(hidden, 3 * hidden, k=0.3)
        self.w, self.b = draw(2 * hidden, len(langs), k=0.1), np.zeros(len(langs), np.float32)

    def gradients(self, x, keep, y):
        """Loss and gradients for segments x (T, S) of classes y (S)."""
        f, cf = _run(x, keep, self.tf, self.uf, True)
        rx, rk = x[::-1], keep[::-1]
        g, cb = _run(rx, rk, self.tb, self.ub, True)
        h = np.concatenate([f, g[::-1]], axis=2)
        p = _softmax(h @ self.w + self.b)
        weight = keep / max(1.0, float(keep.sum()))
        loss = float(-(np.log(np.maximum(p[:, np.arange(len(y)), y], 1e-9)) * weight).sum())
        d = p
        d[:, np.arange(len(y)), y] -= 1
        d *= weight[:, :, None]
        n = self.uf.shape[0]
        dw, db, dh = np.einsum("tsh,tsl->hl", h, d), d.sum((0, 1)), d @ self.w.T
        dtf, duf = _back(x, keep, self.tf, self.uf, cf, dh[:, :, :n])
        dtb, dub = _back(rx, rk, self.tb, self.ub, cb, dh[::-1, :, n:])
        return loss, dict(zip(self.NAMES, (dtf, duf, dtb, dub, dw, db)))

    def train(self, segments: list[bytes], classes: list[int], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED):
        """Adam over batches drawn evenly from the classes."""
        rng = np.random.default_rng(seed)
        x, keep = pad(segments)
        y = np.array(classes)
        groups = [np.flatnonzero(y == k) for k in range(len(self.langs)) if (y == k).any()]
        m = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        v = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        for i in range(1, steps + 1):
            pick = np.concatenate([rng.choice(g, max(1, batch // len(groups))) for g in groups])
            _, grads = self.gradients(x[:, pick], keep[:, pick], y[pick])
            lr = rate * min(1.0, 2 * (1 - (i - 1) / steps))
            for n, g in grads.items():
                m[n] += 0.1 * (g - m[n])
                v[n] += 0.01 * (g * g - v[n])
                setattr(self, n, (getattr(self, n) - lr * (m[n] / (1 - 0.9 ** i)) / (np.sqrt(v[n] / (1 - 0.99 ** i)) + 1e-8)).astype(np.float32))
        return self

    def _states(self, x, keep, table, u):
        """As ``_run``, in place and with one contiguous array per gate (half-angle form of the logistic)."""
        n = u.shape[0]
        parts = [slice(0, n), slice(n, 2 * n), slice(2 * n, 3 * n)]
        scale = (0.5, 0.5, 1.0)
        tz, tr, tc = (np.ascontiguousarray(table[:, p]) * np.float32(k) for p, k in zip(parts, scale))
        uz, ur, uc = (np.ascontiguousarray(u[:, p]) * np.float32(0.5) for p in parts)
        steps, lanes = x.shape
        out = np.empty((steps, lanes, n), np.float32)
        h = np.zeros((lanes, n), np.float32)
        z, r, c, a = (np.empty((lanes, n), np.float32) for _ in range(4))
        for t in range(steps):
            for gate, tab, w in ((z, tz, uz), (r, tr, ur)):
                np.take(tab, x[t], axis=0, out=gate, mode="clip")
                gate += np.dot(h, w, out=a)
                np.tanh(gate, out=gate)
                gate += 1
            np.take(tc, x[t], axis=0, out=c, mode="clip")
            r *= np.dot(h, uc, out=a)
            c += r
            np.tanh(c, out=c)
            h = out[t]
            np.subtract(out[t - 1] if t else 0, c, out=h)
            h *= z
            h *= 0.5
            h += c
            if not keep[t].all():
                h *= keep[t][:, None]
        return out.reshape(-1, n)

    def label_segments(self, x, keep):
        """Sum of the position probabilities of each segment (S, L)."""
        n = self.uf.shape[0]
        p = self.w[:n].T @ self._states(x, keep, self.tf, self.uf).T
        back = self.w[n:].T @ self._states(x[::-1], keep[::-1], self.tb, self.ub).T
        p.reshape(len(p), *x.shape)[:] += back.reshape(len(p), *x.shape)[:, ::-1]
        p += self.b[:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p *= keep.reshape(-1) / p.sum(axis=0)
        return p.reshape(len(p), *x.shape).sum(axis=1).T

    def document_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean position probabilities of each text, over all of its bytes; zeros for an empty one.

        Segments are labelled ``SIDE_BYTES`` at a time, also those of one long
        text: the working arrays are many times that size, never a text's."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        out = np.zeros((len(texts), len(self.langs)))
        pieces = ((i, t[at:at + SIDE_BYTES]) for i, t in enumerate(texts) for at in range(0, len(t), SIDE_BYTES))
        some, room = [], SIDE_BYTES
        for i, piece in pieces:
            if some and len(piece) > room:
                self._add(some, out)
                some, room = [], SIDE_BYTES
            some.append((i, piece))
            room -= len(piece)
        if some:
            self._add(some, out)
        return out / np.maximum(sizes, 1)[:, None]

    def _add(self, pieces: list[tuple[int, bytes]], out: np.ndarray) -> None:
        """Add the position probabilities of the pieces to the rows they belong to."""
        owner = np.array([i for i, _ in pieces])
        counts = np.array([-(-len(p) // SEGMENT) for _, p in pieces])
        flat = np.zeros(int(counts.sum()) * SEGMENT, np.uint8)
        mask = np.zeros(len(flat), np.float32)
        at = 0
        for (_, p), c in zip(pieces, counts.tolist()):
            flat[at:at + len(p)] = np.frombuffer(p, np.uint8)
            mask[at:at + len(p)] = 1
            at += c * SEGMENT
        x, keep = flat.reshape(-1, SEGMENT), mask.reshape(-1, SEGMENT)
        owner = np.repeat(owner, counts)
        for i in range(0, len(x), LANES):
            part = slice(i, i + LANES)
            np.add.at(out, owner[part], self.label_segments(np.ascontiguousarray(x[part].T), np.ascontiguousarray(keep[part].T)))


def pad(segments: list[bytes]):
    """(T, S) bytes and mask of segments cut to the segment length."""
    x = np.zeros((len(segments), SEGMENT), np.uint8)
    keep = np.zeros((len(segments), SEGMENT), np.float32)
    for i, s in enumerate(segments):
        s = s[:SEGMENT]
        x[i, :len(s)] = np.frombuffer(s, np.uint8)
        keep[i, :len(s)] = 1
    return np.ascontiguousarray(x.T), np.ascontiguousarray(keep.T)


def training_slices(docs: DataFrame, per_lang: int = DOCS_PER_LANG) -> list:
    """(lang, slices) of a bounded sample: the ``per_lang`` smallest hashes of a hashed share of each language."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    rows = rows.select("lang", "text", F.xxhash64(F.col("doc_id").cast("long"), "text").alias("_h"))
    # of each language about four times as many as asked for go on to be ranked, however many there are
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("_h").alias("n")).collect()  # a row per language
    share = F.lit(0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], int((1 << 30) * min(1.0, 4 * per_lang / max(1, r["n"])))).otherwise(share)
    rows = rows.where(F.pmod("_h", F.lit(1 << 30)) < share)
    ranked = rows.select("lang", "_h").distinct().withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("_h")))
    last = ranked.where(F.col("_n") <= per_lang).groupBy("lang").agg(F.max("_h").alias("_h")).collect()  # a row per language
    if not last:
        return []
    chosen = F.lit(False)
    for r in last:
        chosen = F.when(F.col("lang") == r["lang"], F.col("_h") <= r["_h"]).otherwise(chosen)
    room = F.greatest(F.length("text") - SLICE_CHARS, F.lit(0)) + 1
    cut = F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)),
                      lambda i: F.substring(F.col("text"), F.pmod(F.xxhash64("_h", i), room).cast("int") + 1, F.lit(SLICE_CHARS)))
    sample = rows.where(chosen).select("lang", "_h", cut.alias("slices")).dropDuplicates(["lang", "_h"])
    return sorted((r["lang"], r["_h"], r["slices"]) for r in sample.collect())  # at most per_lang rows a language


def train(docs: DataFrame) -> Model | None:
    """A model of the non-null languages among rows that are not held out; None without any."""
    sample = training_slices(docs)
    if not sample:
        return None
    langs = sorted({r[0] for r in sample})
    pairs = [(s.encode(), langs.index(lang)) for lang, _, slices in sample for s in slices if s]
    return Model(langs).train([p[0] for p in pairs], [p[1] for p in pairs])


def _predictor(model):
    def run(batches):
        worker_cache("langid")
        m = model.value
        for batch in batches:
            doc = batch.column(1)
            text = batch.column(0) if TEXT in batch.schema.names else doc.field(doc.type.get_field_index("text"))
            texts = [x or b"" for x in text.cast(pa.binary()).to_pylist()]
            p = m.document_probabilities(texts)
            best = p.argmax(axis=1)
            cols = [pa.array([m.langs[k] for k in best], pa.string()), pa.array(p[np.arange(len(p)), best].clip(0, 1), pa.float64())]
            yield pa.RecordBatch.from_arrays([*cols, doc, batch.column(2)], names=["_lang", "_score", "_doc", "_letters"])
    return run


def identify(docs: DataFrame, model: Model | None, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` of ``docs`` (all by default), ``lang_pred`` and ``score``.

    Null, empty and letterless texts get ``und`` and score 0, as does every
    text when there was nothing to learn from.  Whole texts are labelled, some
    of a long one at a time.  Rows are labelled each for themselves: repeated
    rows and null ids are kept, an empty table gives no row.  Columns of
    ``docs`` called ``lang_pred`` or ``score`` give way to the new ones.
    """
    own = [c for c in (docs.columns if carry is None else carry) if c not in ("lang_pred", "score")]
    got = _labelled(docs, model, own)
    return got.select(*[F.col(f"_doc.`{c}`") for c in own],
                      F.when(F.col("_letters"), F.col("_lang")).otherwise(UNKNOWN).alias("lang_pred"),
                      F.when(F.col("_letters"), F.col("_score")).otherwise(0.0).alias("score"))


def _labelled(docs: DataFrame, model: Model | None, own: list[str]) -> DataFrame:
    """``_doc`` (columns ``own``), ``_lang``, ``_score`` and ``_letters``; the text travels once."""
    bounded_batches(docs.sparkSession)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters")
    doc = F.struct(*[F.col(f"`{c}`") for c in own]).alias("_doc")
    if model is None:
        return docs.select(doc, F.lit(UNKNOWN).alias("_lang"), F.lit(0.0).alias("_score"), letters)
    work = docs.select(F.lit(0).alias("_none") if "text" in own else F.col("text").alias(TEXT), doc, letters)
    handle = docs.sparkSession.sparkContext.broadcast(model)  # some 50 kB
    kind = work.schema["_doc"].dataType.simpleString()
    work = work.mapInArrow(releasing(_predictor(handle)), f"_lang string, _score double, _doc {kind}, _letters boolean")
    return work.select("_doc", "_lang", "_score", "_letters")


def predictions(docs: DataFrame) -> DataFrame:
    """The rows of the registered query."""
    got = identify(docs, train(docs), carry=["doc_id"])
    return got.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def reject(docs: DataFrame, min_score: float = 0.4) -> DataFrame:
    """``docs`` without those of no language: ``und``, or position labels that agree too little."""
    model = train(docs)
    if model is None:  # nothing to learn from: only letterless texts go
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    got = _labelled(docs, model, docs.columns).where((F.col("_letters")) & (F.col("_score") >= min_score))
    return got.select(*[F.col(f"_doc.`{c}`") for c in docs.columns])
