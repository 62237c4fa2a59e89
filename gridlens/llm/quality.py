"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` bytes.  Every passage is
encoded from its byte and byte-class-pair frequencies and repeated words by a
learned layer;
gated attention, learned from document labels alone, weighs the passages; the
weighted mean representation is scored.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.langid import held_out

#: Labelled documents learned from, at most: those of the smallest hashes of (doc_id, text).
SAMPLE_DOCS = 6000
#: A longer training text is represented by this many evenly spaced passages.
SAMPLE_PASSAGES = 12
PASSAGE = 512
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE, SEED = 24, 12, 25, 128, 0.01, 11
THRESHOLD = 0.3

# Byte classes of the pair features (fixed values): control and blank, line
# feed, digits, capitals, vowels, other letters, sentence marks, other ASCII
# marks each in one of six groups, bytes above 7F by high bits.
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (1 if _c == "\n" else 0 if _b <= 0x20 else 2 if _c.isdigit() and _b < 0x80 else 3 if "A" <= _c <= "Z"
                  else 4 if _c in "aeiou" else 5 if "a" <= _c <= "z" else 6 if _c in ".," else 7 if _c in "!?;:" else 8 if _c in "#$%&*@"
                  else 9 if _c in "|/\\_~^`=+" else 10 if _c in "<>()[]{}" else 11 if _b < 0x80 else 12 if _b < 0xC0 else 13)
CLASSES = 14
FEATURES = 256 + CLASSES * CLASSES + 4


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text (at least one)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = np.maximum(1, -(-sizes // PASSAGE))
    buf = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(len(buf)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    owner = first[doc] + inside // PASSAGE
    n = int(counts.sum())
    length = np.bincount(owner, minlength=n)
    bytes_ = np.bincount(owner * 256 + buf, minlength=n * 256).reshape(n, 256)
    kind = _CLASS[buf]
    same = owner[1:] == owner[:-1]
    pairs = np.bincount((owner[:-1] * (CLASSES * CLASSES) + kind[:-1] * CLASSES + kind[1:])[same],
                        minlength=n * CLASSES * CLASSES).reshape(n, CLASSES * CLASSES)
    scale = 1 / np.maximum(length, 1)[:, None]
    size = np.log1p(np.repeat(sizes, counts)) / 10
    again = np.array([x for t, c in zip(texts, counts.tolist()) for x in _repeats(t, c)]).reshape(-1, 2)
    out = np.concatenate([np.sqrt(bytes_ * scale), np.sqrt(pairs * scale), size[:, None], np.log1p(length)[:, None] / 10, again], axis=1)
    return out.astype(np.float32), counts


def _repeats(text: bytes, count: int):
    """Of each passage, the share of words equal to the one before, and of words seen before in it."""
    for i in range(count):
        words = text[i * PASSAGE:(i + 1) * PASSAGE].split()
        n = max(1, len(words))
        yield sum(map(eq, words, words[1:])) / n, 1 - len(set(words)) / n


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Model:
    """Passage encoder, gated attention and document score."""

    NAMES = ("w", "b", "v", "u", "a", "o", "c")

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w, self.b = draw(FEATURES, HIDDEN), np.zeros(HIDDEN, np.float32)
        self.v, self.u, self.a = draw(HIDDEN, ATTENTION), draw(HIDDEN, ATTENTION), draw(ATTENTION)
        self.o, self.c = draw(HIDDEN), np.zeros(1, np.float32)

    def forward(self, x, counts):
        """Scores of the bags whose passages are consecutive rows of x, and what backpropagation needs."""
        first = np.cumsum(counts) - counts
        bag = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(x @ self.w + self.b)
        t, g = np.tanh(h @ self.v), _sigmoid(h @ self.u)
        e = (t * g) @ self.a
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        att = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(att[:, None] * h, first, axis=0)
        p = _sigmoid(z @ self.o + self.c)
        return p, (first, bag, h, t, g, att, z)

    def gradients(self, x, counts, y):
        p, (first, bag, h, t, g, att, z) = self.forward(x, counts)
        d = ((p - y) / len(y)).astype(np.float32)
        grads = {"o": z.T @ d, "c": d.sum(keepdims=True)}
        dz = d[:, None] * self.o
        datt = (dz[bag] * h).sum(axis=1)
        de = att * (datt - np.add.reduceat(att * datt, first)[bag])
        grads["a"] = (t * g).T @ de
        back = de[:, None] * self.a
        dt, dg = back * g * (1 - t * t), back * t * g * (1 - g)
        grads["v"], grads["u"] = h.T @ dt, h.T @ dg
        dh = (att[:, None] * dz[bag] + dt @ self.v.T + dg @ self.u.T) * (1 - h * h)
        grads["w"], grads["b"] = x.T @ dh, dh.sum(axis=0)
        return p, grads

    def train(self, x, counts, y, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        first = np.cumsum(counts) - counts
        m = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        v = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        k = 0
        for epoch in range(epochs):
            lr = rate * (1 - epoch / epochs)
            order = rng.permutation(len(y))
            for i in range(0, len(y), batch):
                pick = order[i:i + batch]
                rows = np.concatenate([np.arange(first[j], first[j] + counts[j]) for j in pick])
                _, grads = self.gradients(x[rows], counts[pick], y[pick])
                k += 1
                for n, g in grads.items():
                    m[n] += 0.1 * (g - m[n])
                    v[n] += 0.001 * (g * g - v[n])
                    step = lr * (m[n] / (1 - 0.9 ** k)) / (np.sqrt(v[n] / (1 - 0.999 ** k)) + 1e-7)
                    setattr(self, n, (getattr(self, n) - step).astype(np.float32))
        return self

    def score(self, texts: list[bytes], block_bytes: int = 1 << 21) -> np.ndarray:
        """Scores of whole texts, a few MB at a time; one long text is a block of its own."""
        out, start = [], 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= block_bytes):
                size += len(texts[end])
                end += 1
            x, counts = passages(texts[start:end])
            out.append(self.forward(x, counts)[0])
            start = end
        return np.concatenate(out).astype(np.float64) if out else np.zeros(0)


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_DOCS) -> list:
    """(hash, quality, slices) of at most ``limit`` labelled documents that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)  # a top-k per task, then of those
    n = F.length("text")
    longer = n > SAMPLE_PASSAGES * PASSAGE
    gap = F.when(longer, ((n - PASSAGE) / (SAMPLE_PASSAGES - 1)).cast("int")).otherwise(PASSAGE)
    cut = F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_PASSAGES - 1)), lambda i: F.substring(F.col("text"), i * gap + 1, F.lit(PASSAGE)))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "quality", n.alias("n"), cut.alias("slices")).dropDuplicates(["doc_id"])
    return sorted((r["doc_id"], r["quality"], r["slices"]) for r in rows.collect())  # at most ``limit`` rows of some 6 kB


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    rows = training_rows(docs, labels)
    if not rows:
        return None
    # features of some texts at a time: the working arrays are many times a text's size
    parts = [passages(["".join(s).encode() for _, _, s in rows[i:i + 250]]) for i in range(0, len(rows), 250)]
    x, counts = (np.concatenate(p) for p in zip(*parts))
    return Model().train(x, counts, np.array([float(q) for _, q, _ in rows], np.float32))


def _scorer(model):
    def run(batches):
        m = model.value
        for batch in batches:
            scores = m.score([x or b"" for x in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(scores.clip(0, 1), pa.float64()), batch.column(1)], names=["_score", "_doc"])
    return run


def score_quality(docs: DataFrame, model: Model | None, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` of ``docs`` (all by default), ``score`` and ``predicted``.

    Null and empty texts are one empty passage and are scored too; without a
    model every score is 0.5.  Rows are scored each for itself.
    """
    carry = docs.columns if carry is None else carry
    own = [F.col(f"`{c}`") for c in carry]
    if model is None:
        got = docs.select(*own, F.lit(0.5).alias("score"))
    else:
        work = docs.select(F.col("text").cast("binary").alias("_text"), F.struct(*own).alias("_doc"))
        handle = docs.sparkSession.sparkContext.broadcast(model)  # some 50 kB
        kind = work.schema["_doc"].dataType.simpleString()
        got = work.mapInArrow(_scorer(handle), f"_score double, _doc {kind}").select("_doc.*", F.col("_score").alias("score"))
    return got.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the registered query."""
    got = score_quality(docs, train(docs, labels), carry=["doc_id"])
    return got.select("doc_id", held_out().alias("held_out"), "score", "predicted")
