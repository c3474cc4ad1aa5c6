"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Every text becomes a sparse vector of its hashed words (scaled to length one) and of the bins its
statistics and its size fall into. A linear part and, for each pair of features, the product of their
short vectors make the score. The sum over all pairs takes linear time by the identity

    sum over i < j of <v_i, v_j> x_i x_j  =  1/2 sum over f of ((sum v_if x_i)^2 - sum (v_if x_i)^2).

Labels are learnt from a sample of bounded size in one task; scoring is a scan.
"""

from __future__ import annotations

import io
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from signalflow.llm.common import map_batches

# Labelled documents that a model is fitted on, about so many whatever the size of the corpus.
TRAIN_ROWS = 10_000
# Buckets of hashed words, length of a feature's vector.
BUCKETS = 1 << 14
RANK = 8
EPOCHS, BATCH_ROWS, RATE, PENALTY = 30, 128, 0.02, 1e-5
SEED = 17
# From this score on a document is predicted to be good.
GOOD = 0.7
# Documents of this remainder of crc32(id) by four are held out.
FOLDS, HELD_OUT = 4, 2

SYMBOLS = "#*$%&|<>{}[]^~_=+\\/@"
# Upper ends of the bins of a share; sizes are binned by powers of two.
SHARES = (0.0, 0.003, 0.01, 0.02, 0.04, 0.07, 0.11, 0.16, 0.23, 0.32, 0.43, 0.55, 0.68, 0.8, 0.9, 0.97)
STATISTICS = (
    "chars", "words", "word_length", "symbols", "marks", "questions", "upper", "title", "plain", "numbers",
    "distinct", "stutter", "top_word", "lines", "repeated_lines", "beyond_ascii",
)
BINS = 24
FEATURES = BUCKETS + len(STATISTICS) * BINS
_KEPT_WORDS, _KEPT_LENGTH = 150_000, 40
_buckets: dict[str, int] = {}


def _forget() -> None:
    _buckets.clear()


def _bucket(word: str) -> int:
    known = _buckets.get(word)
    if known is None:
        known = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        if len(word) <= _KEPT_LENGTH:
            if len(_buckets) >= _KEPT_WORDS:
                _buckets.clear()
            _buckets[word] = known
    return known


def statistics(text: str, words: list[str], counts: Counter) -> list[int]:
    """The bin of each of :data:`STATISTICS`."""
    n, chars = max(len(words), 1), max(len(text), 1)
    lines = [line for line in text.split("\n") if line]

    def share(part: float, whole: float) -> int:
        return bisect_right(SHARES, part / whole)

    return [
        min(len(text).bit_length(), BINS - 1),
        min(len(words).bit_length(), BINS - 1),
        min(len(text) // n, BINS - 1),
        share(sum(map(text.count, SYMBOLS)), chars),
        share(text.count("!"), n),
        share(text.count("?"), n),
        share(sum(map(str.isupper, words)), n),
        share(sum(map(str.istitle, words)), n),
        share(sum(map(str.isalnum, words)), n),
        share(sum(map(str.isdigit, words)), n),
        share(len(counts), n),
        share(sum(map(eq, words, words[1:])), n),
        share(max(counts.values(), default=0), n),
        share(len(lines), n),
        share(len(lines) - len(set(lines)), max(len(lines), 1)),
        share(len(text.encode("utf-8", "surrogatepass")) - len(text), chars),
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a whole text; NULL is an empty one. No number occurs twice."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    held = np.fromiter(map(_bucket, counts), np.int64, len(counts))
    weight = np.bincount(held, weights=np.log1p(np.fromiter(counts.values(), np.float64, len(counts))), minlength=0)
    index = np.flatnonzero(weight)
    value = weight[index]
    if len(value):
        value = value / np.sqrt((value**2).sum())
    bins = BUCKETS + np.arange(len(STATISTICS)) * BINS + np.array(statistics(text, words, counts))
    return np.concatenate((index, bins)), np.concatenate((value, np.full(len(bins), 1 / np.sqrt(len(bins)))))


@dataclass
class Model:
    """Bias, one weight and one vector a feature."""

    bias: float
    weight: np.ndarray
    vector: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        """Score before the logistic function, in time linear in the features that are there."""
        scaled = self.vector[index] * value[:, None]
        pairs = 0.5 * ((scaled.sum(axis=0) ** 2).sum() - (scaled**2).sum())
        return self.bias + float(self.weight[index] @ value) + float(pairs)

    def score(self, text: str | None) -> float:
        return float(_logistic(np.array([self.margin(*features(text))]))[0])

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bias=self.bias, weight=self.weight, vector=self.vector)
        return out.getvalue()

    @staticmethod
    def unpacked(data: bytes) -> Model:
        held = np.load(io.BytesIO(data))
        return Model(float(held["bias"]), held["weight"], held["vector"])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: Sequence[int], epochs: int = EPOCHS) -> Model:
    """Logistic loss by Adam over small batches, the same for the same rows in the same order.

    Without rows of both labels the model is the smoothed share of good ones.
    """
    y = np.array(labels, np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    rng = np.random.default_rng(SEED)
    parts = [np.zeros(1), np.zeros(FEATURES), rng.normal(0, 0.1, (FEATURES, RANK))]
    parts[0][0] = np.log(share / (1 - share))
    if not 0 < y.sum() < len(y):
        return Model(float(parts[0][0]), parts[1], np.zeros((FEATURES, RANK)))
    moments, squares, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH_ROWS):
            batch = order[start : start + BATCH_ROWS]
            sizes = np.array([len(rows[i][0]) for i in batch])
            index, value = (np.concatenate([rows[i][k] for i in batch]) for k in (0, 1))
            row = np.repeat(np.arange(len(batch)), sizes)
            firsts = np.cumsum(sizes) - sizes
            bias, weight, vector = parts
            scaled = vector[index] * value[:, None]
            sums = np.add.reduceat(scaled, firsts, axis=0)
            margin = bias[0] + np.bincount(row, weights=weight[index] * value, minlength=len(batch))
            margin += 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((scaled**2).sum(axis=1), firsts))
            slope = (_logistic(margin) - y[batch]) / len(batch)
            each = slope[row] * value
            inner = each[:, None] * (sums[row] - scaled)
            slopes = [
                np.array([slope.sum()]),
                np.bincount(index, weights=each, minlength=FEATURES) + PENALTY * weight,
                np.stack([np.bincount(index, weights=inner[:, f], minlength=FEATURES) for f in range(RANK)], axis=1) + PENALTY * vector,
            ]
            step += 1
            for p, g, m, s in zip(parts, slopes, moments, squares):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Model(float(parts[0][0]), parts[1], parts[2])


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is kept from every model; a NULL id has none to keep."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, label, text)`` of about ``most`` labelled documents that are not held out.

    They are chosen by a hash of the id, in proportion to how many there are, so the table of chosen labels
    is small whatever the corpus and meets the documents where they are read. Labels that are NULL are left
    out; of several labels of an id the largest counts, of several texts the least.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").alias("label")).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.filter(~held_out()).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    total = known.count()
    parts = 1 << 20
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(parts)) < int(parts * min(1.0, most / max(total, 1))))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """Fit on :func:`training_rows` in one task; only the model, of fixed size, comes to the driver."""
    rows = training_rows(docs, labels, most)

    def compute(batches):
        made, wanted, order = [], [], []
        for batch in batches:
            for doc_id, label, text in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), batch.column("text")):
                index, value = features(text.as_py())
                made.append((index.astype(np.int32), value.astype(np.float32)))
                wanted.append(label)
                order.append((zlib.crc32(str(doc_id).encode()), str(doc_id)))
        place = sorted(range(len(made)), key=order.__getitem__)
        model = fit([made[i] for i in place], [wanted[i] for i in place])
        yield pa.RecordBatch.from_arrays([pa.array([model.packed()], pa.binary())], names=["model"])

    found = rows.repartition(1).mapInArrow(compute, "model binary").collect()
    return Model.unpacked(bytes(found[0].model)) if found else fit([], [])


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Append ``score``, 0 to 1, to every row; a column of that name is replaced. Texts are read whole, also NULL and empty ones."""
    return map_batches(df, lambda batch: {"score": [model.score(t.as_py()) for t in batch.column(text)]}, [StructField("score", DoubleType())], _forget)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document by a model that has not seen the labels held out."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))
