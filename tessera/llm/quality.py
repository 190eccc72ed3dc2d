"""Quality classifier: random-indexing word vectors pooled per document, then a small network.

Random indexing (Kanerva et al. 2000): each word has a sparse random index
vector of +1 and -1 entries; a word's context vector is the sum of the index
vectors of the words near it (``REACH`` to either side) over all documents.
Words and runs of punctuation count as words, with their case; they are hashed
to ``BUCKETS`` rows, so the vectors take 2 MB whatever the vocabulary. Each
task sums its own share, and Spark adds the shares up, one slice of the rows
per key, as a stream.

A document is pooled to the mean and the spread of its words' context vectors
(scaled to unit length). A network of two layers in numpy turns these into a
logit, and a temperature fitted on rows that the network did not see divides it
before the logistic function. The fit reads at most ``SAMPLE`` labelled rows,
chosen by a hash of the id, one row of each id (that of the smallest text);
only their pooled vectors come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import held_out, mapped, named, sampled_texts, text_bytes
from .words import SAME, WORDS_AND_MARKS, mixed, words

BUCKETS = 1 << 14
SIZE = 32
ENTRIES = 4
REACH = 2
SLICE = 256  # rows of a share that travel together
# Bound of the fit: labelled rows, and the share of them kept for the temperature.
SAMPLE = 8000
VALIDATION = 0.2
HIDDEN, STEPS, RATE, RIDGE = 32, 400, 0.01, 1e-4


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's ``ENTRIES`` non-zero entries."""
    draw = mixed(np.arange(BUCKETS * ENTRIES, dtype=np.uint64) + np.uint64(1)).reshape(BUCKETS, ENTRIES)
    return (draw % np.uint64(SIZE)).astype(np.int64), np.where(draw >> np.uint64(63), 1.0, -1.0)


def buckets(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bucket of each word, bounds of each text) for some texts at a time."""
    for part in words(texts, WORDS_AND_MARKS, SAME):
        yield part.first_text, (part.hashes & np.uint64(BUCKETS - 1)).astype(np.int64), part.bounds


class Contexts:
    """Sums of context vectors over texts."""

    def __init__(self):
        self.places, self.signs = index_vectors()
        self.sums = np.zeros(BUCKETS * SIZE)

    def add(self, texts: list[bytes]) -> None:
        for _, bucket, bounds in buckets(texts):
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            for reach in range(1, REACH + 1):
                same = np.flatnonzero(owner[reach:] == owner[:-reach])
                for word, near in ((bucket[same], bucket[same + reach]), (bucket[same + reach], bucket[same])):
                    at = word[:, None] * SIZE + self.places[near]
                    self.sums += np.bincount(at.ravel(), self.signs[near].ravel(), BUCKETS * SIZE)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all buckets from all rows of ``docs`` (zero rows for buckets without context)."""
    def shares(batches):
        held = Contexts()
        for batch in batches:
            held.add(list(text_bytes(batch)))
        rows = held.sums.reshape(-1, SLICE * SIZE)
        some = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)),
                                          pa.array([rows[i].astype(np.float32).tobytes() for i in some], pa.binary())],
                                         names=["slice", "sums"])

    def added(batches):
        total: dict[int, np.ndarray] = {}  # as many slices at most as there are keys
        for batch in batches:
            for key, sums in zip(batch.column("slice").to_pylist(), batch.column("sums")):
                own = np.frombuffer(sums.as_py(), np.float32)
                total[key] = total[key] + own if key in total else own.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                         names=["slice", "sums"])

    schema = "slice int, sums binary"
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = mapped(docs.select("text"), shares, schema).repartition(parts, "slice")
    out = np.zeros((BUCKETS // SLICE, SLICE * SIZE))
    for row in mapped(dealt, added, schema).collect():  # 4 MB at most
        out[row.slice] = np.frombuffer(row.sums, np.float64)
    return unit(out.reshape(BUCKETS, SIZE))


def unit(sums: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.divide(sums, length, out=np.zeros_like(sums), where=length > 0).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the context vectors of each text's words; zeros without words."""
    out = np.zeros((len(texts), 2 * SIZE))
    for first, bucket, bounds in buckets(texts):
        n = np.diff(bounds)
        some = np.flatnonzero(n)
        if len(some):
            own = vectors[bucket]
            begins = bounds[some]
            mean = np.add.reduceat(own, begins, axis=0, dtype=np.float64) / n[some, None]
            square = np.add.reduceat(own * own, begins, axis=0, dtype=np.float64) / n[some, None]
            out[first + some, :SIZE] = mean
            out[first + some, SIZE:] = np.sqrt(np.maximum(square - mean * mean, 0))
    return out


@dataclass
class Network:
    """Standardised inputs, a hidden layer, a logit, a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.logits(x) / self.temperature)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit_network(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit on all but the last rows, then the temperature on these; rows come in a random order.

    Without rows of both labels the score is the smoothed share of label 1.
    """
    n, d = len(y), x.shape[1]
    share = (y.sum() + 0.5) / (n + 1) if n else 0.5
    constant = Network(np.zeros(d), np.ones(d), np.zeros((d, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN),
                       float(np.log(share / (1 - share))))
    kept = n - int(n * VALIDATION)
    train, t = x[:kept], y[:kept]
    if not 0 < t.sum() < len(t):
        return constant
    centre, scale = train.mean(axis=0), np.maximum(train.std(axis=0), 1e-6)
    rng = np.random.default_rng(7)
    params = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
              np.array([constant.b2])]
    inputs = (train - centre) / scale
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        hidden = np.tanh(inputs @ params[0] + params[1])
        error = (_logistic(hidden @ params[2] + params[3][0]) - t) / len(t)
        back = error[:, None] * params[2] * (1 - hidden * hidden)
        grads = [inputs.T @ back + RIDGE * params[0], back.sum(axis=0), hidden.T @ error + RIDGE * params[2],
                 np.array([error.sum()])]
        for p, g, a, b in zip(params, grads, first, second):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    net = Network(centre, scale, params[0], params[1], params[2], float(params[3][0]))
    if kept < n:
        z, v = net.logits(x[kept:]), y[kept:]
        choices = np.exp(np.linspace(np.log(0.25), np.log(16), 121))
        net.temperature = float(min(choices, key=lambda c: _loss(z / c, v)))
    return net


def training_labels(labels: DataFrame, label: str = "quality", rows: int = SAMPLE) -> DataFrame:
    """(doc_id, y, place) of ``rows`` training rows at most, placed by a hash of the id.

    Held-out ids, null ids and null labels are left out; an id labelled twice
    counts once, with its larger label.
    """
    usable = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
              .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("y").alias("y")))
    place = F.xxhash64(F.lit("quality"), "doc_id")
    return usable.withColumn("place", place).orderBy("place", "doc_id").limit(rows)


@dataclass
class Model:
    vectors: np.ndarray
    network: Network

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return self.network.probabilities(pooled(texts, self.vectors))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Context vectors from all rows of ``docs``, the network from the sampled labelled ones.

    Rows are sampled by a hash of their ids, ties by the id; an id with several
    rows counts with its smallest text. Empty tables give a model, too.
    """
    vectors = context_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches):
        for batch in batches:
            x = pooled(list(text_bytes(batch)), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("y"), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["place", "y", "x"])

    chosen = sampled_texts(docs, training_labels(labels, rows=sample))  # ``sample`` rows at most
    rows = mapped(chosen.select("place", "y", "text"), features, "place long, y int, x binary").collect()
    rows.sort(key=lambda r: (r.place, r.x))
    x = np.array([np.frombuffer(r.x, np.float64) for r in rows]).reshape(len(rows), 2 * SIZE)
    return Model(vectors, fit_network(x, np.array([r.y for r in rows], float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``quality_score`` (0 to 1; replaces one of that name).

    Null and empty texts get the score of a document without words, equal texts
    equal scores; texts of any length are read as a whole. An empty table gives
    no rows; other columns stay, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != "quality_score"]
    plain = docs.select(*map(named, names))

    def scored(batches):
        for batch in batches:
            out = pa.array(shared.value.scores(list(text_bytes(batch))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*names, "quality_score"])

    return mapped(plain, scored, StructType([*plain.schema.fields, StructField("quality_score", DoubleType())]))
