"""Toxicity: a linear classifier on character n-grams whose features are scaled by naive Bayes log-count ratios.

A text is lower-cased and its white space made single spaces. Its features are the hashed n-grams it holds, with the
logarithm of one more than their count. From labelled texts come the log ratios of how often each n-gram occurs in
either class; a logistic regression is fitted on the features times their ratios. Its penalty is the one of PENALTIES
with the least loss on texts that were left out in turn. The product of ratio and weight is one number per n-gram, so
scoring a text sums these numbers times its features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import lean, trim

#: Lengths of the n-grams, and places that they are hashed to.
GRAMS, BITS = (4, 5, 6), 20
#: Most labelled texts of either class that the classifier is fitted on, and their code points in all; equal texts count once.
MOST_TOXIC, MOST_CLEAN, MOST_CHARS = 2000, 3000, 6_000_000
#: Penalties to choose from, and into how many parts the labelled texts are cut for that.
PENALTIES, FOLDS = (1e-3, 1e-2, 1e-1), 2
_MIX = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, max(GRAMS) + 1)]


def grams(text: str | None) -> np.ndarray:
    """The hashed n-grams of a text. None for null and for texts of white space."""
    plain = " ".join((text or "").lower().split())
    if not plain:
        return np.empty(0, np.uint32)
    points = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, h = [], np.zeros(len(points), np.uint64)
    for k, factor in enumerate(_MIX[: len(points)]):
        h = h[: len(points) - k] + points[k:] * np.uint64(factor)
        if k + 1 in GRAMS:
            g = h + np.uint64(k + 1)
            g = (g ^ (g >> np.uint64(29))) * np.uint64(_MIX[1])
            found.append((g >> np.uint64(64 - BITS)).astype(np.uint32))
    return np.concatenate(found) if found else np.empty(0, np.uint32)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text, ascending, each once, and how often it holds them (255 stands for more)."""
    seen, counts = np.unique(grams(text), return_counts=True)
    return seen, np.minimum(counts, 255).astype(np.uint8)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        all_grams = grams(text)
        seen, counts = np.unique(all_grams[self.weights[all_grams] != 0], return_counts=True)
        x = self.bias + float((self.weights[seen] * np.log1p(np.minimum(counts, 255))).sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


Examples = list[tuple[np.ndarray, np.ndarray]]


def fit(examples: Examples, labels: np.ndarray, penalty: float | None = None, rounds: int = 150) -> Model:
    """The classifier of these features. Both classes weigh alike; with one class alone it gives its prior. Without a penalty,
    the best one for these examples is taken."""
    size, toxic = 1 << BITS, labels.astype(bool)
    if not len(labels) or toxic.all() or not toxic.any():
        prior = (toxic.sum() + 1) / (len(labels) + 2) if len(labels) else 0.25
        return Model(np.zeros(size, np.float32), float(np.log(prior / (1 - prior))))
    if penalty is None:
        penalty = best_penalty(examples, labels)
    texts, times = np.zeros(size, np.int32), np.zeros((2, size))
    for (x, count), label in zip(examples, toxic, strict=True):
        texts[x] += 1  # a text holds each of its features once
        times[int(label), x] += count
    shares = (times + 0.5) / times.sum(1, keepdims=True).clip(1)
    ratios = np.log(shares[1] / shares[0])
    # n-grams of one or two texts, or as frequent in either class, say nothing of other texts
    useful = (texts >= 3) & (np.abs(ratios) > 0.7)
    place = (np.cumsum(useful) - 1).astype(np.int32)
    kept = [useful[x] for x, _ in examples]
    rows = np.repeat(np.arange(len(kept), dtype=np.int32), [int(k.sum()) for k in kept])
    columns = place[np.concatenate([x[k] for (x, _), k in zip(examples, kept, strict=True)])]
    values = np.log1p(np.concatenate([c[k] for (_, c), k in zip(examples, kept, strict=True)]).astype(np.float32)) * ratios[useful].astype(np.float32)[columns]
    norm = float(np.sqrt(np.bincount(rows, values**2, len(examples)).mean())) or 1.0
    values /= norm
    balance = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum())
    w, b, target = np.zeros(int(useful.sum())), 0.0, toxic.astype(float)
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):  # Adam on the whole sample
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, values * w[columns], len(examples)) + b, -500, 500)))
        error = balance * (p - target)
        slope = np.append(np.bincount(columns, values * error[rows], len(w)) + penalty * w / max(1, len(w)) ** 0.5, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        step = 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        w -= step[:-1]
        b -= step[-1]
    weights = np.zeros(size, np.float32)
    weights[useful] = w * ratios[useful] / norm
    return Model(weights, float(b))


def best_penalty(examples: Examples, labels: np.ndarray) -> float:
    """The penalty of least balanced log loss on each part of the examples for a fit on the others."""
    if min((labels > 0).sum(), (labels <= 0).sum()) < 2 * FOLDS:
        return PENALTIES[len(PENALTIES) // 2]
    parts = np.zeros(len(labels), int)
    for label in (False, True):  # parts have both classes alike
        own = np.flatnonzero((labels > 0) == label)
        parts[own] = np.arange(len(own)) % FOLDS
    losses = []
    for penalty in PENALTIES:
        loss = 0.0
        for fold in range(FOLDS):
            inside = np.flatnonzero(parts != fold)
            model = fit([examples[i] for i in inside], labels[inside], penalty, rounds=60)
            for label in (0, 1):
                out = np.flatnonzero((parts == fold) & ((labels > 0) == label))
                x = np.array([model.bias + (model.weights[examples[i][0]] * np.log1p(examples[i][1].astype(np.float32))).sum() for i in out])
                loss += np.logaddexp(0, -x if label else x).mean()
        losses.append(loss)
    return PENALTIES[int(np.argmin(losses))]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: tuple[int, int] = (MOST_CLEAN, MOST_TOXIC), most_chars: int = MOST_CHARS) -> Model:
    """Fits the classifier on at most so many clean and toxic texts of docs that labels marks, of at most so many code points for
    either class, chosen by a hash of the text. Rows without a label or doc_id are not used; of differing labels of a
    document or text the highest counts. Only the ids of the chosen and their features come to the driver."""
    marks = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
    own = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("_hash"), F.coalesce(F.length("text"), F.lit(0)).alias("_size"))
    once = own.join(marks, "doc_id").groupBy("_hash").agg(F.max("_label").alias("_label"), F.min("doc_id").alias("doc_id"), F.max("_size").alias("_size"))
    chosen = []
    for toxic, n in enumerate(most):
        room = most_chars
        for row in once.filter((F.col("_label") > 0) == bool(toxic)).orderBy("_hash").limit(n).collect():
            if row["_size"] <= room:
                room -= row["_size"]
                chosen.append((row["doc_id"], row["_hash"], toxic))
    if not chosen:
        return fit([], np.empty(0))
    picked = docs.sparkSession.createDataFrame(chosen, "doc_id long, _hash long, _label int")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(x) for x in b.column(2).to_pylist()]
            columns = [pa.array([x[i].tobytes() for x in found], pa.binary()) for i in (0, 1)]
            yield pa.record_batch([b.column(0), b.column(1), *columns], names=["hash", "label", "grams", "counts"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("_hash"), "text")
    rows = texts.join(F.broadcast(picked), ["doc_id", "_hash"]).select("_hash", "_label", "text")
    found = {}
    for row in rows.mapInArrow(lean(gathered), "hash long, label int, grams binary, counts binary").toLocalIterator():
        found[row["hash"]] = (np.frombuffer(row["grams"], np.uint32), np.frombuffer(row["counts"], np.uint8)), row["label"]
    order = sorted(found)
    model = fit([found[i][0] for i in order], np.array([found[i][1] for i in order]))
    found.clear()
    trim()  # the driver has other work to do
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: toxic likelier) of every row. Null and empty texts have the score of a text
    without features. Repeated rows are scored each; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([own.score(x) for x in b.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(lean(scored), "doc_id long, score double")


def reject(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """docs without the rows whose score reaches the threshold; columns and their order stay, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            yield b.filter(pa.array([own.score(x) < threshold for x in b.column(place).to_pylist()], pa.bool_()))

    # columns go by their places: a name may hold dots
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(lean(kept), plain.schema).toDF(*docs.columns)


def held_out(doc_id: str) -> Column:
    """Whether crc32 of the id's text is divisible by 5. Null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
