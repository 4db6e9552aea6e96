"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Tokens are words and runs of signs; words in capitals and words that repeat the one before count as two
tokens of their own kind. Tokens are hashed into BUCKETS. Each bucket has a fixed sparse index vector (a few
+1 and -1 from a seed); its context vector is the sum of the index vectors of its neighbours in the labelled
sample. A document is the mean of both vectors over all its tokens. A network with one hidden layer is
trained on the sample in numpy, and a temperature is fitted on a part of it held back.

``most_labelled`` bounds the sample (by a hash of the id), hence all that reaches the driver; every document is scored in
tasks, by a model of fixed size (BUCKETS * DIMENSIONS numbers) that is broadcast.

Defined results: null and empty texts are the zero vector and get the score the network has for it; of an id with several
labels the mean counts; null labels and ids are no examples; with no example, or only one kind, every score is the smoothed
share of label 1; repeated rows are scored each; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millwright.llm.arrow import decoded, pa_schema
from millwright.session import materialize

BUCKETS, DIMENSIONS, NONZERO, WINDOW, SEED = 1 << 15, 48, 6, 2, 11
CAPITALS, AGAIN, RESERVED = 0, 1, 2
TOKENS = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def index_vectors() -> np.ndarray:
    """Sparse vectors of +1 and -1; the seed fixes them, so they are never sent."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS, DIMENSIONS), np.int8)
    places = np.argsort(rng.random((BUCKETS, DIMENSIONS), dtype=np.float32), axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.int8), (BUCKETS, NONZERO)), axis=1)
    return out


class Buckets(dict):
    """Bucket of each token; forgets all when full."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        if len(token) > 1 and token.isupper():
            value = CAPITALS
        else:
            value = RESERVED + zlib.crc32(token.encode("utf-8", "replace")) % (BUCKETS - RESERVED)
        self[token] = value
        return value


def tokens(raw: bytes | None, buckets: Buckets) -> np.ndarray:
    found = TOKENS.findall(decoded(raw))
    out = np.fromiter(map(buckets.__getitem__, found), np.int32, len(found))
    again = np.flatnonzero((out[1:] == out[:-1]) & (out[1:] != CAPITALS)) + 1
    out[again] = AGAIN
    return out


def contexts(texts: list[np.ndarray], index: np.ndarray) -> np.ndarray:
    """Sums of the index vectors of neighbours, by bucket."""
    out = np.zeros((BUCKETS, DIMENSIONS), np.int32)
    for t in texts:
        for start in range(0, len(t), 50_000):
            part = t[start : start + 50_000 + WINDOW]
            for away in range(1, WINDOW + 1):
                for own, other in ((part[:-away], part[away:]), (part[away:], part[:-away])):
                    if len(own):
                        order = np.argsort(own, kind="stable")
                        cuts = np.flatnonzero(np.append(True, own[order][1:] != own[order][:-1]))
                        out[own[order][cuts]] += np.add.reduceat(index[other[order]], cuts, axis=0, dtype=np.int32)
    return out


@dataclass
class Model:
    vectors: np.ndarray  # BUCKETS x 2 * DIMENSIONS
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def features(self, t: np.ndarray) -> np.ndarray:
        if not len(t):
            return np.zeros(self.vectors.shape[1], np.float32)
        total = np.zeros(self.vectors.shape[1], np.float64)
        for start in range(0, len(t), 20_000):
            total += self.vectors[t[start : start + 20_000]].sum(axis=0, dtype=np.float64)
        return (total / len(t)).astype(np.float32)

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def train(model: Model, x: np.ndarray, y: np.ndarray, hidden: int = 32, steps: int = 600, rate: float = 0.01) -> Model:
    """Adam on the cross-entropy; every fifth example is held back for the temperature.

    Weights have a normal prior of variance 1, so the decay is one over the number of examples: few examples move them little.
    """
    if len(y) < 10 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        model.second_bias, model.second = float(np.log(share / (1 - share))), model.second * 0
        return model
    held = np.arange(len(y)) % 5 == 4
    tx, ty = x[~held], y[~held]
    model.mean, model.scale = tx.mean(0), tx.std(0) + 1e-3
    z = (tx - model.mean) / model.scale
    rng = np.random.default_rng(SEED)
    w1, b1 = rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden)
    w2, b2 = rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)
    values = [w1, b1, w2, b2]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    decay = 1 / len(ty)
    for step in range(1, steps + 1):
        h = np.tanh(z @ w1 + b1)
        wrong = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -50, 50))) - ty) / len(ty)
        back = np.outer(wrong, w2) * (1 - h * h)
        slopes = [z.T @ back + decay * w1, back.sum(0), h.T @ wrong + decay * w2, wrong.sum(keepdims=True)]
        for v, s, (m, q) in zip(values, slopes, moments):
            m += 0.1 * (s - m)
            q += 0.001 * (s * s - q)
            v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
    model.first, model.first_bias, model.second, model.second_bias = w1, b1, w2, float(b2[0])
    logits, ly = model.logits(x[held]), y[held]

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, -np.where(ly > 0.5, 1, -1) * logits / t)))

    model.temperature = min(np.geomspace(0.25, 8, 81), key=loss)
    return model


def held_out(id_column: Column) -> Column:
    """Whether the crc32 of the id, as text, leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most_labelled: int = 12_000, id_column: str = "doc_id", label: str = "quality") -> Model:
    """A model from documents with labels (id, label); the caller leaves out what must not be learnt from."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
              .groupBy(F.col(id_column).cast("long").alias("id")).agg(F.avg(F.col(label).cast("double")).alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(most_labelled))
    sample = (docs.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("binary").alias("raw"))
              .join(F.broadcast(chosen), "id"))  # at most most_labelled rows of two numbers
    # few tasks, as each sends a whole table of context vectors
    sample = materialize(sample.repartition(4, "id").sortWithinPartitions("id", "raw"), "quality-sample")

    def sum_contexts(batches):
        index, buckets, out = index_vectors(), Buckets(), np.zeros((BUCKETS, DIMENSIONS), np.int32)
        for batch in batches:
            for raw in batch.column(0):
                out += contexts([tokens(raw.as_py(), buckets)], index) if len(raw.as_py() or b"") > 100_000 else 0
            out += contexts([t for raw in batch.column(0) if len(raw.as_py() or b"") <= 100_000
                             for t in (tokens(raw.as_py(), buckets),)], index)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["sums"])

    sums = np.zeros((BUCKETS, DIMENSIONS), np.int64)
    for row in sample.select("raw").coalesce(4).mapInArrow(sum_contexts, "sums binary").toLocalIterator():
        sums += np.frombuffer(row["sums"], np.int32).reshape(BUCKETS, DIMENSIONS)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    vectors = np.hstack([sums / np.maximum(length, 1), index_vectors() / np.sqrt(NONZERO)]).astype(np.float16)
    width = vectors.shape[1]
    model = Model(vectors.astype(np.float32), np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    pooled = sample.mapInArrow(_pool(shared, pa.schema({"id": pa.int64(), "label": pa.float64(), "x": pa.binary()})), "id long, label double, x binary")
    rows = sorted((r["id"], r["label"], bytes(r["x"])) for r in pooled.collect())  # at most the sample
    x = np.frombuffer(b"".join(r[2] for r in rows), np.float32).reshape(len(rows), width)
    return train(model, x.astype(np.float64), np.array([r[1] for r in rows]))


def _pool(shared, schema: pa.Schema):
    def run(batches):
        buckets, model = Buckets(), shared.value
        for batch in batches:
            x = [model.features(tokens(raw.as_py(), buckets)).tobytes() for raw in batch.column("raw")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(x, pa.binary())], schema=schema)

    return run


def score(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """(id, score) of every document; the chance of label 1."""
    schema = "id long, score double"
    kind, shared = pa_schema(docs, schema), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        buckets, model = Buckets(), shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                x = np.stack([model.features(tokens(raw.as_py(), buckets)) for raw in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(x.astype(np.float64)))], schema=kind)

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("binary").alias("raw"))
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_column)
