"""A quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE words.  Every passage is encoded by a learned layer, h = tanh(W x + b): x holds counts of its characters
and words, and how often it has the words of each of BUCKETS hash buckets, so the layer's rows for these are a learned embedding of hashed words, averaged
over the passage.  Gated attention, a = softmax(w . (tanh(V h) * sigmoid(U h))), weighs the passages, and the score is a logistic function of the
weighted encoding.  All weights are learned together from labels of whole documents, by Adam on a bounded sample of documents;
fitting and scoring encode every passage of every whole text.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.llm.common import PLAIN_CODES, WordHasher, bounded_sample, learned_split, prepare, texts, tidy

#: Labelled documents of each label in the sample, at most.  For fitting alone.
SAMPLE = 2000
PASSAGE, WIDTH, GATE, EPOCHS, SEED, BUCKETS = 64, 16, 8, 40, 5, 512
THRESHOLD = 0.3
#: Passages that are scored at a time.
STRETCH = 2048
_MARKS = [bytes([c]) for c in b"#*$%&|<>!?.,;:@=_/-()[]{}\"'\\~^+"]
_UPPER, _LOWER, _DIGIT, _HIGH = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), bytes(range(128, 256))
COUNTS = len(_MARKS) + 13
FEATURES = COUNTS + BUCKETS


@functools.cache
def hasher() -> WordHasher:
    return WordHasher(PLAIN_CODES, seed=8)


def encode(text: str) -> np.ndarray:
    """A row of FEATURES numbers for each passage; one of zeros for a text without words."""
    data = text.encode()
    words = data.split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    seen = Counter(words)
    starts = range(0, max(1, len(words) - PASSAGE // 4), PASSAGE)  # a last stretch under a quarter joins the one before
    lines = Counter(x for x in data.split(b"\n") if x.strip())
    repeated = 1 - len(lines) / max(1, sum(lines.values()))
    counts = []
    for k, at in enumerate(starts):
        own = words[at : at + PASSAGE] if k + 1 < len(starts) else words[at:]
        n = len(own)
        joined = b" ".join(own)
        size = len(joined) - n + 1
        upper, lower, digit, high = (len(joined) - len(joined.translate(None, x)) for x in (_UPPER, _LOWER, _DIGIT, _HIGH))
        distinct = len(set(own))
        twice = sum(a == b for a, b in zip(own, own[1:], strict=False))
        pairs = len(set(zip(own, own[1:], strict=False)))
        again = sum(map(seen.__getitem__, own)) / n
        counts.append([*(joined.count(m) / n for m in _MARKS), np.log1p(n) / 5, np.log1p(len(words)) / 8, size / n / 8, max(map(len, own)) / 40, upper / size, lower / size, digit / size, high / size, distinct / n, twice / n, pairs / max(1, n - 1), np.log1p(again) / 5, repeated])
    sizes = np.diff([*starts, len(words)])
    passage = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), FEATURES), np.float32)
    out[:, :COUNTS] = counts
    place = passage * BUCKETS + (hasher()(data) % np.uint64(BUCKETS)).astype(np.int64)
    out[:, COUNTS:] = np.bincount(place, minlength=len(sizes) * BUCKETS).reshape(-1, BUCKETS) / sizes[:, None]
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """The weights; fit() on bags of passages, score() of one bag."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fit(cls, bags: list[np.ndarray], labels: list[int], seed: int = SEED) -> Model:
        rng = np.random.default_rng(seed)
        every = np.concatenate(bags) if bags else np.zeros((1, FEATURES), np.float32)
        first_rows = rng.normal(0, 0.3, (COUNTS, WIDTH))
        w = {"mean": every.mean(0), "scale": every.std(0) + 0.05, "W": np.concatenate([first_rows, np.zeros((BUCKETS, WIDTH))]), "b": np.zeros(WIDTH), "V": rng.normal(0, 0.3, (WIDTH, GATE)), "U": rng.normal(0, 0.3, (WIDTH, GATE)), "g": np.zeros(GATE), "c": rng.normal(0, 0.3, WIDTH), "d": np.zeros(1)}
        model = cls(w)
        y = np.array(labels, float)
        if len(set(labels)) < 2:
            w["c"][:], w["d"][:] = 0, 4.0 * (2 * y.mean() - 1) if len(y) else 0
            return model
        learned = ("W", "b", "V", "U", "g", "c", "d")
        first, second, step = {k: np.zeros_like(w[k]) for k in learned}, {k: np.zeros_like(w[k]) for k in learned}, 0
        bags = [(b - w["mean"]) / w["scale"] for b in bags]
        for epoch in range(EPOCHS):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), 64):
                batch = order[at : at + 64]
                x = np.concatenate([bags[i] for i in batch])
                lengths = np.array([len(bags[i]) for i in batch])
                gradient = model._gradient(x, lengths, y[batch])
                step += 1
                rate = 0.01 * (1 - epoch / EPOCHS) + 0.0005
                for k in learned:
                    d = gradient[k] + 1e-4 * w[k]
                    first[k] = 0.9 * first[k] + 0.1 * d
                    second[k] = 0.999 * second[k] + 0.001 * d * d
                    w[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return model

    def _forward(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray):
        w = self.w
        h = np.tanh(x @ w["W"] + w["b"])
        t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        e = (t * s) @ w["g"]
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, s, a, z, _sigmoid(z @ w["c"] + w["d"])

    def _gradient(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, n = self.w, len(lengths)
        starts, bag = np.cumsum(lengths) - lengths, np.repeat(np.arange(n), lengths)
        h, t, s, a, z, p = self._forward(x, starts, bag)
        dz_score = (p - y) / n
        dz = dz_score[:, None] * w["c"]
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, starts)[bag])
        dg = (t * s).T @ de
        dt, ds = de[:, None] * w["g"] * s * (1 - t * t), de[:, None] * w["g"] * t * s * (1 - s)
        dh = a[:, None] * dz[bag] + dt @ w["V"].T + ds @ w["U"].T
        du = dh * (1 - h * h)
        return {"W": x.T @ du, "b": du.sum(0), "V": h.T @ dt, "U": h.T @ ds, "g": dg, "c": z.T @ dz_score, "d": np.array([dz_score.sum()])}

    def score(self, bag: np.ndarray) -> float:
        """Of a bag of any length, a stretch of passages at a time: their sums weighted by exp(e) add up."""
        w, top, total, z = self.w, -np.inf, 0.0, np.zeros(WIDTH)
        for at in range(0, len(bag), STRETCH):
            h = np.tanh((bag[at : at + STRETCH] - w["mean"]) / w["scale"] @ w["W"] + w["b"])
            e = (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["g"]
            new = max(top, float(e.max()))
            a = np.exp(e - new)
            total, z, top = total * np.exp(top - new) + a.sum(), z * np.exp(top - new) + a @ h, new
        return float(_sigmoid((z / total) @ w["c"] + w["d"])[0])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits the model on at most SAMPLE documents of each label, none of them held out; of rows that share a doc_id, and have a text, on one, the least by a hash of its text."""
    rows = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~learned_split(F.col("doc_id"), 5, 0))
    label = {r["doc_id"]: r["quality"] for r in reversed(bounded_sample(rows, "quality", SAMPLE, ["doc_id", "quality"]))}
    prepare(docs.sparkSession)

    def bags(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([zlib.compress(encode(t).tobytes(), 1) for t in texts(batch)], pa.binary())], ["doc_id", "bag"])

    rows = docs.where(F.col("doc_id").isin([*label]) & F.col("text").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")).select("doc_id", "x.text")
    found = sorted((r["doc_id"], bytes(r["bag"])) for r in rows.mapInArrow(tidy(bags), "doc_id long, bag binary").collect()) if label else []
    return Model.fit([np.frombuffer(zlib.decompress(bag), np.float32).reshape(-1, FEATURES) for _, bag in found], [label[i] for i, _ in found])


def _shared(spark: SparkSession, docs: DataFrame, labels: DataFrame, model: Model | None):
    prepare(spark)
    return spark.sparkContext.broadcast((model or learn(docs, labels)).w)  # FEATURES * (WIDTH + 2) numbers and some


def score_quality(docs: DataFrame, labels: DataFrame, model: Model | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for each document.

    Null and empty texts are scored as a bag with one passage of zeros.  Null doc_ids count as not held out.  Labels of unknown
    documents, null or other labels teach nothing; with fewer than two kinds of label the score is a constant.  Very long texts are scored whole; repeated rows
    alike; other columns don't matter; an empty table gives no rows.
    """
    shared = _shared(docs.sparkSession, docs, labels, model)

    def run(batches):
        m = Model(shared.value)
        for batch in batches:
            scores = [m.score(encode(t)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), learned_split(F.col("doc_id"), 5, 0).alias("held_out"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")


def keep_quality(docs: DataFrame, labels: DataFrame, model: Model | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least threshold, with all their columns, whatever their names.

    As score_quality() says: a null or empty text has the score of a passage without words; repeated rows stay or go together; null ids and nulls in other columns
    don't matter; an empty table stays empty.
    """
    shared = _shared(docs.sparkSession, docs, labels, model)

    def run(batches):
        m = Model(shared.value)
        for batch in batches:
            yield batch.filter(pa.array([m.score(encode(t)) >= threshold for t in texts(batch)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
