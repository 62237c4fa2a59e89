"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Terms (words and word stems) that go with the toxic label are mined from a
bounded sample of labelled documents.  Many voters - lexicons dealt from the
mined words, stem lists, hit counts and densities, and general patterns - vote
on every sampled document.  A latent-class model with a dependency tree among
the voters estimates, by expectation maximisation, how often each voter fires
in either class (its accuracy) and how it depends on the voter it is most
correlated with; the given label is one of the voters.  Its posteriors are the
soft labels of a logistic regression over term counts and text patterns, which
scores every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import discard, stored, workspace
from gridlens.llm.langid import held_out

#: Labelled documents learned from, at most, of each class: those of the smallest hashes of doc_id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
#: Stem lengths; a term must be in this many sampled toxic texts and this far (signed root of G) from chance.
STEMS, LEAST_TEXTS, LEAST_ROOT, TERMS = (4, 5, 6, 7, 8), 4, 4.5, 512
LEXICONS, STEM_LISTS = 12, 8
EM_ROUNDS, TREE_EVERY, LEAST_INFORMATION = 24, 6, 0.002
STEPS, RATE, DECAY = 400, 0.1, 2e-4
THRESHOLD = 0.5

_words = re.compile(r"[^\W_]+").findall
_marks = re.compile(r"[!?]{2,}").findall
_codes = re.compile(r"[#$%&*@]{2,}").findall
PATTERNS = ("marks", "shouting", "address", "codes", "repeats")


def stems(word: str) -> list[str]:
    """Stem terms of a word: its proper prefixes of the stem lengths, with a dash."""
    return [word[:n] + "-" for n in STEMS if n < len(word)]


def patterns(text: str, words: list[str], counts: Counter) -> list[float]:
    """General pattern features of a text: shares of runs of marks, capitals, second person, runs of symbols, repeated words."""
    n = max(1, len(words))
    return [len(_marks(text)) / n, sum(map(str.isupper, text.split())) / n, (counts["you"] + counts["your"]) / n, len(_codes(text)) / n,
            sum(map(eq, words, words[1:])) / n]


def likeness_key(words: list[str]) -> int:
    """Least hash of the five-word shingles: copies and near copies mostly share it."""
    runs = [" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))]
    return min(xxhash.xxh64_intdigest(r) for r in set(runs)) - (1 << 63)


def signed_root(a, b, n1, n0):
    """Signed root of the G statistic of a term in ``a`` of n1 toxic and ``b`` of n0 clean texts."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    total, seen = n1 + n0, a + b
    g = np.zeros_like(a)
    for got, size in ((a, n1), (b, n0)):
        for part, margin in ((got, seen), (size - got, total - seen)):
            expect = margin * size / total
            g += np.where(part > 0, part * np.log(np.maximum(part, 1e-12) / np.maximum(expect, 1e-12)), 0)
    return np.sign(a / n1 - b / n0) * np.sqrt(np.maximum(2 * g, 0))


class Terms:
    """Counts of the mined terms and the pattern features of texts."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.index = {t: i for i, t in enumerate(terms)}
        self.is_stem = np.array([t.endswith("-") for t in terms], bool)
        self.starts = {t[:n] for t in terms for n in range(1, min(STEMS) + 1)}

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: counts of the terms, pattern features and the number of words."""
        out = np.zeros((len(texts), len(self.terms) + len(PATTERNS) + 1), np.float32)
        for row, text in zip(out, texts):
            words = _words(text.lower())
            counts = Counter(words)
            for word, n in counts.items():
                if word[:min(STEMS)] in self.starts:  # few words share their beginning with a term
                    for t in (word, *stems(word)):
                        if t in self.index:
                            row[self.index[t]] += n
            row[-1 - len(PATTERNS):-1] = patterns(text, words, counts)
            row[-1] = len(words)
        return out

    def votes(self, x: np.ndarray) -> np.ndarray:
        """0/1 votes of every voter (columns) on texts with features ``x``."""
        k, n = len(self.terms), np.maximum(x[:, -1], 1)
        counts, general = x[:, :k], x[:, k:-1]
        words, some = np.flatnonzero(~self.is_stem), np.flatnonzero(self.is_stem)
        hits = counts[:, words].sum(1)
        most = counts[:, some].max(1, initial=0)
        cols = [counts[:, words[i::LEXICONS]].sum(1) > 0 for i in range(LEXICONS)]
        for i in range(STEM_LISTS):
            peak = counts[:, some[i::STEM_LISTS]].max(1, initial=0)
            cols += [peak >= 2, peak >= 3]
        cols += [hits >= 1, hits >= 2, hits >= 4, most >= 2, most >= 3, most >= 5, hits / n > 0.005, hits / n > 0.02,
                 most / n > 0.01, most / n > 0.03, (counts[:, words] > 0).sum(1) >= 2, (hits == 0) & (most <= 1), most == 0]
        cols += [general[:, i] > cut for i in range(len(PATTERNS)) for cut in (0.0, 0.2)]
        return np.stack(cols, axis=1).astype(np.float64)

    def inputs(self, x: np.ndarray) -> np.ndarray:
        """Inputs of the linear classifier."""
        k, n = len(self.terms), np.maximum(x[:, -1:], 1)
        hits = x[:, :k][:, ~self.is_stem].sum(1, keepdims=True)
        most = x[:, :k][:, self.is_stem].max(1, keepdims=True, initial=0)
        return np.concatenate([np.log1p(x[:, :k]), np.log1p(hits), np.log1p(most), np.minimum(1, 20 * hits / n), np.minimum(1, 20 * most / n),
                               hits > 0, most > 1, most > 2, x[:, k:-1]], axis=1).astype(np.float64)


class LabelModel:
    """Latent class with a tree of voters: P(y) times P(vote | y, vote of the parent) for every voter.

    The given label takes part as one more voter, the last column: a careful
    but not unfailing one, whose accuracy is estimated like the others'.  It
    neither has a parent nor is one.
    """

    def __init__(self, prior: float):
        self.prior = min(max(prior, 1e-3), 1 - 1e-3)

    def _tree(self, v: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Parent of each voter (-1: none) in the maximum spanning forest of conditional mutual information given y."""
        m = v.shape[1]
        info = np.zeros((m, m))
        for w in (q, 1 - q):
            total = w.sum() + 2
            one = (v * w[:, None]).sum(0) + 1
            both = (v.T * w) @ v + 0.5
            for pij, pi, pj in ((both, one[:, None], one[None]), (one[:, None] - both, one[:, None], total - one[None]),
                                (one[None] - both, total - one[:, None], one[None]),
                                (total - one[:, None] - one[None] + both, total - one[:, None], total - one[None])):
                pij = np.maximum(pij, 1e-6)
                info += pij / len(v) * np.log(pij * total / (pi * pj))
        parent, best, source = np.full(m, -1), np.full(m, -np.inf), np.full(m, -1)
        free = np.ones(m, bool)
        info[-1] = info[:, -1] = 0
        for _ in range(m):
            i = int(np.argmax(np.where(free, best, -np.inf))) if np.isfinite(best[free]).any() else int(np.flatnonzero(free)[0])
            free[i] = False
            parent[i] = source[i] if best[i] > LEAST_INFORMATION else -1
            closer = free & (info[i] > best)
            best[closer], source[closer] = info[i][closer], i
        return parent

    def _fit(self, v, q):
        """Smoothed P(vote = 1 | y, parent's vote), (2, 2, voters)."""
        up = np.where(self.parent[None] >= 0, v[:, np.maximum(self.parent, 0)], 0)
        self.table = np.empty((2, 2, v.shape[1]))
        for y, w in ((0, 1 - q), (1, q)):
            for b in (0, 1):
                weight = w[:, None] * (up == b)
                self.table[y, b] = ((weight * v).sum(0) + 1) / (weight.sum(0) + 2)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        up = np.where(self.parent[None] >= 0, v[:, np.maximum(self.parent, 0)], 0)
        logs = []
        for y, p in ((0, 1 - self.prior), (1, self.prior)):
            fire = np.where(up == 1, self.table[y, 1], self.table[y, 0])
            logs.append(np.log(p) + np.log(np.where(v == 1, fire, 1 - fire)).sum(1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))

    def fit(self, v: np.ndarray, start: np.ndarray) -> LabelModel:
        """Expectation maximisation from the posteriors ``start``."""
        q = start
        for i in range(EM_ROUNDS):
            if i % TREE_EVERY == 0:
                self.parent = self._tree(v, q)
            self._fit(v, q)
            q = self.posterior(v)
        self.accuracy = np.stack([((1 - q)[:, None] * (1 - v)).sum(0) / max((1 - q).sum(), 1e-9), (q[:, None] * v).sum(0) / max(q.sum(), 1e-9)])
        return self


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft targets (Adam on the whole sample, ridge)."""
    w, b = np.zeros(x.shape[1]), 0.0
    m, s = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    weight = weight / weight.sum()
    for i in range(1, STEPS + 1):
        d = (1 / (1 + np.exp(-np.clip(x @ w + b, -60, 60))) - target) * weight
        g = np.append(x.T @ d + DECAY * w, d.sum())
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        step = RATE * (1 - (i - 1) / STEPS) * (m / (1 - 0.9 ** i)) / (np.sqrt(s / (1 - 0.99 ** i)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


class Model:
    """Mined terms and the linear classifier over them."""

    def __init__(self, terms: Terms, x: np.ndarray, toxic: np.ndarray, prior: float):
        self.terms = terms
        votes = np.concatenate([terms.votes(x), toxic[:, None]], axis=1)
        self.labels = LabelModel(toxic.mean()).fit(votes, np.where(toxic == 1, 0.95, 0.05))
        soft = self.labels.posterior(votes)
        weight = np.where(toxic == 1, prior / max(toxic.mean(), 1e-9), (1 - prior) / max(1 - toxic.mean(), 1e-9))
        self.w, self.b = logistic(terms.inputs(x), soft, weight)

    def score(self, texts: list[str], block_chars: int = 1 << 21) -> np.ndarray:
        """Scores of whole texts, a few MB at a time."""
        out, at = [np.zeros(0)], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= block_chars) and end - at < 1024:
                size += len(texts[end])
                end += 1
            x = self.terms.inputs(self.terms.features(texts[at:end]))
            out.append(1 / (1 + np.exp(-np.clip(x @ self.w + self.b, -60, 60))))
            at = end
        return np.concatenate(out)


def sample(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> tuple[DataFrame, float]:
    """(toxic, text) of the labelled documents learned from, and the share of toxic ones among all that could be."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, ones = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(toxic).unionByName(known.where("toxic = 0").orderBy(*order).limit(clean))
    text = docs.where("text IS NOT NULL").select("doc_id", "text")
    return text.join(F.broadcast(chosen), "doc_id").select("toxic", "text"), (ones / n if n else 0.0)  # at most 12,000 ids are broadcast


def _term_rows(batches):
    """Per batch: texts with their likeness key, and the distinct terms of each."""
    for batch in batches:
        toxic, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for at in range(0, len(texts), 64):
            part = [_words(t.lower()) for t in texts[at:at + 64]]
            terms = [sorted(set(chain(w, chain.from_iterable(map(stems, set(w)))))) for w in part]
            yield pa.RecordBatch.from_arrays([pa.array(toxic[at:at + 64], pa.int32()), pa.array([likeness_key(w) for w in part], pa.int64()),
                                              pa.array(terms, pa.list_(pa.string()))], names=["toxic", "alike", "terms"])


def mine(rows: DataFrame) -> list[str]:
    """The terms that most go with the toxic label; one text of each group of near copies counts."""
    terms = rows.mapInArrow(_term_rows, "toxic int, alike long, terms array<string>")
    folder = workspace(rows.sparkSession, "toxicity")
    one = stored(terms.groupBy("alike", "toxic").agg(F.max_by("terms", F.struct(F.size("terms"), "terms")).alias("terms")), folder)
    n1, n0 = one.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not n1 or not n0:
        discard(rows.sparkSession, folder)
        return []
    counts = one.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where(
        (F.col("a") >= LEAST_TEXTS) & (F.col("a") * n0 > 2 * F.col("b") * n1) & (F.length("term") >= 3))
    got = counts.orderBy((F.col("a") * n0 - F.col("b") * n1).desc(), "term").limit(20 * TERMS).collect()  # bounded by the limit
    discard(rows.sparkSession, folder)
    if not got:
        return []
    root = signed_root([r["a"] for r in got], [r["b"] for r in got], n1, n0)
    ranked = sorted((-z, r["term"]) for z, r in zip(root, got) if z >= LEAST_ROOT)
    return [t for _, t in ranked[:TERMS]]


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model learned from labelled rows that are not held out; None if a class or any telling term is missing."""
    rows, prior = sample(docs, labels)
    terms = mine(rows)
    if not terms:
        return None
    book = Terms(terms)

    def features(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 256):
                x = book.features(texts[at:at + 256])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256).cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], names=["toxic", "x"])
    got = rows.mapInArrow(features, "toxic int, x binary").collect()  # at most 12,000 rows of some 2 kB
    got = sorted((r["toxic"], bytes(r["x"])) for r in got)
    x = np.frombuffer(b"".join(r[1] for r in got), np.float32).reshape(len(got), -1)
    return Model(book, x, np.array([r[0] for r in got], np.float64), prior)


def _scorer(handle):
    def run(batches):
        model = handle.value
        for batch in batches:
            scores = model.score([t or "" for t in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()), batch.column(1)], names=["_score", "_doc"])
    return run


def score_toxicity(docs: DataFrame, model: Model | None, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` of ``docs`` (all by default), ``score`` and ``predicted``.

    Null and empty texts are texts without words and get the score of those;
    without a model (no labels, one class only, or no telling term) every
    score is 0.  Whole texts are read, a few MB at a time.  Every row is scored
    for itself, so repeated rows and null ids are kept; an empty table gives
    no row.  A column of ``docs`` called ``score`` or ``predicted`` gives way
    to the new one.
    """
    own = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry) if c not in ("score", "predicted")]
    if model is None:
        return docs.select(*own, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    work = docs.select(F.col("text").alias("_text"), F.struct(*own).alias("_doc"))
    handle = docs.sparkSession.sparkContext.broadcast(model)  # at most TERMS words and weights
    kind = work.schema["_doc"].dataType.simpleString()
    got = work.mapInArrow(_scorer(handle), f"_score double, _doc {kind}")
    return got.select("_doc.*", F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of the registered query."""
    got = score_toxicity(docs, train(docs, labels), carry=["doc_id"])
    return got.select("doc_id", held_out().alias("held_out"), "score", "predicted")
