"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the character n-grams (3 to 5 code points of the lower-cased text
with a blank at either end) that occur in a text, hashed to 2^20 buckets. Each
feature's value is its log-count ratio between toxic and other training texts
(Wang & Manning 2012); a logistic regression on these values gives the score.

The fit reads a bounded sample of the labelled rows: at most
``SAMPLE_PER_CLASS`` rows of either label, chosen by a hash of the id, one row
of each id (that of the smallest text). Spark selects them, cuts their n-grams
in tasks and counts the texts of each label that have a bucket; of a text, the
driver gets the buckets of the features chosen by these counts. A label with more rows is sampled at a lower rate; the intercept
takes the two rates back, so that scores follow the labels' real share whatever
the bound. The weights (4 MB whatever the input) are broadcast; scoring is
one pass over all rows without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import checkpointed, held_out, mapped, named, sampled_texts, texts

LENGTHS = (3, 4, 5)
BITS = 20
# Bound of the fit: labelled rows of each class.
SAMPLE_PER_CLASS = 1500
# A feature is used if it occurs in so many sampled texts (and this share) and its ratio is this far from even.
SLICE = 1 << 14  # buckets whose counts travel together
LEAST_TEXTS, LEAST_SHARE, LEAST_RATIO = 5, 0.003, 1.0
RIDGE, STEPS, RATE = 1e-3, 200, 0.05
REJECT_AT = 0.5


def ngram_buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram of the text, repeats included."""
    chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    rolled, out = chars, []
    for n in range(2, max(LENGTHS) + 1):
        if len(chars) < n:
            break
        rolled = rolled[:-1] * np.uint32(0x9E3779B1) + chars[n - 1:]
        if n in LENGTHS:
            h = rolled * np.uint32(0x85EBCA6B) + np.uint32(n)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out.append(h >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


@dataclass
class Model:
    """Weight of each bucket (ratio times coefficient) and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        buckets = ngram_buckets(text)
        used = np.unique(buckets[self.weights[buckets] != 0])
        z = self.intercept + float(self.weights[used].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def usable_labels(labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, y) of all training rows.

    Held-out ids, null ids and null labels are left out; an id labelled twice
    counts once, with its larger label.
    """
    return (labels.select("doc_id", F.col(label).cast("int").alias("y"))
            .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("y").alias("y")))


def training_labels(labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, y) of the sampled training rows: ``per_class`` of each label at most."""
    usable = usable_labels(labels, label)
    order = (F.xxhash64(F.lit("sample"), "doc_id"), F.col("doc_id"))
    return (usable.where("y = 1").orderBy(*order).limit(per_class)
            .unionAll(usable.where("y = 0").orderBy(*order).limit(per_class)))


def share_shift(labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> float:
    """Log odds of label 1 among all training rows less those among the sampled ones."""
    rows = {r.y: r["count"] for r in usable_labels(labels, label).groupBy("y").count().collect()}
    thinned = {y: np.log(max(1.0, rows.get(y, 0) / per_class)) for y in (0, 1)}
    return float(thinned[1] - thinned[0])


def _sampled_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = [np.unique(ngram_buckets(t)) for t in texts(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("y"), pa.array([g.astype(np.int32).tobytes() for g in grams], pa.binary())],
            names=["y", "buckets"])


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """For each label, how many of ``rows`` (y, buckets) have each bucket."""
    def shares(batches):
        counts = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for y, own in zip(batch.column("y").to_pylist(), batch.column("buckets")):
                counts[y, np.frombuffer(own.as_py(), np.int32)] += 1  # a text has each bucket once
        for y in (0, 1):
            for k, part in enumerate(counts[y].reshape(-1, SLICE)):
                some = np.flatnonzero(part)
                if len(some):
                    yield pa.RecordBatch.from_pydict({
                        "y": pa.array([y], pa.int32()), "slice": pa.array([k], pa.int32()),
                        "places": [some.astype(np.int32).tobytes()], "counts": [part[some].tobytes()]})

    def added(batches):
        total: dict[tuple[int, int], np.ndarray] = {}  # as many slices at most as there are keys
        for batch in batches:
            for y, k, places, counts in zip(*(batch.column(c).to_pylist() for c in ("y", "slice", "places", "counts"))):
                held = total.setdefault((y, k), np.zeros(SLICE, np.int32))
                held[np.frombuffer(places, np.int32)] += np.frombuffer(counts, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in total], pa.int32()),
                                          pa.array([k for _, k in total], pa.int32()),
                                          pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                         names=["y", "slice", "counts"])

    dealt = mapped(rows, shares, "y int, slice int, places binary, counts binary").repartition("y", "slice")
    out = np.zeros((2, (1 << BITS) // SLICE, SLICE), np.int32)
    for r in mapped(dealt, added, "y int, slice int, counts binary").collect():  # 8 MB at most
        out[r.y, r.slice] = np.frombuffer(r.counts, np.int32)
    return out.reshape(2, -1)


def chosen_features(counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets the fit uses, and the log-count ratio of every bucket, from ``n`` texts."""
    in_other, in_toxic = counts
    size = len(in_other)
    ratio = (np.log((in_toxic + 1) / (in_toxic.sum() + size))
             - np.log((in_other + 1) / (in_other.sum() + size)))
    return (in_toxic + in_other >= max(LEAST_TEXTS, LEAST_SHARE * n)) & (np.abs(ratio) >= LEAST_RATIO), ratio


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on the sampled training rows. With no row of either label, every score is the other's share.

    Which rows are sampled depends on their ids alone; an id with several rows
    counts with its smallest text. Empty tables give a model, too.
    """
    chosen = sampled_texts(docs, training_labels(labels, "toxic", per_class))  # 2 * per_class rows at most
    rows = checkpointed(mapped(chosen.select("text", "y"), _sampled_buckets, "y int, buckets binary"))
    seen = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n, positive, size = sum(seen.values()), seen.get(1, 0), 1 << BITS
    shift = share_shift(labels, "toxic", per_class)
    if not 0 < positive < n:
        share, shift = ((positive + 0.5) / (n + 1), shift) if n else (1e-3, 0.0)
        return Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))) + shift)
    used, ratio = chosen_features(bucket_counts(rows), n)
    shared = docs.sparkSession.sparkContext.broadcast(used)

    def features(batches):
        for batch in batches:
            owns = [np.frombuffer(b.as_py(), np.int32) for b in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([own[shared.value[own]].tobytes() for own in owns], pa.binary())],
                names=["y", "buckets"])

    found = mapped(rows, features, "y int, buckets binary").collect()
    number = np.cumsum(used) - 1  # of each used bucket
    w = fit_ratios([number[np.frombuffer(r.buckets, np.int32)] for r in found], np.array([r.y for r in found], float), ratio[used])
    weights = np.zeros(size, np.float32)
    weights[used] = w[:-1] * ratio[used]
    return Model(weights, float(w[-1]) + shift)


def fit_ratios(features: list[np.ndarray], y: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Coefficient of each feature, then the intercept of the sampled rows' odds."""
    n, m = len(y), len(scale)
    col = np.concatenate(features)
    row = np.repeat(np.arange(n), [len(own) for own in features])
    w = np.zeros(m + 1)
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, STEPS + 1):
        z = w[m] + np.bincount(row, weights=(w[:m] * scale)[col], minlength=n)
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / n
        grad = np.append(np.bincount(col, weights=error[row], minlength=m)[:m] * scale + RIDGE * w[:m], error.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        w -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``toxicity`` (0 to 1; replaces one of that name).

    Null and empty texts get the score of the n-grams of an empty text, equal
    texts equal scores; texts of any length are read as a whole. An empty table
    gives no rows; other columns stay, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != "toxicity"]
    plain = docs.select(*map(named, names))

    def scored(batches):
        for batch in batches:
            out = pa.array([shared.value.score(t) for t in texts(batch)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*names, "toxicity"])

    return mapped(plain, scored, StructType([*plain.schema.fields, StructField("toxicity", DoubleType())]))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose score is below ``REJECT_AT``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches):
        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(t) < REJECT_AT for t in texts(batch)], pa.bool_()))

    return mapped(docs, kept, docs.schema)
