"""Quality classifier: a factorisation machine over words and structure.

Features are hashed words, weighted by damped frequency, and statistics of the
text's structure and size. Every feature has a weight and a low-rank vector;
the interactions of all pairs are summed in linear time as half of the squared
sum of the vectors less the sum of their squares.

The model is fitted in one task on at most ``max_rows`` labelled documents, those
of the smallest seeded hashes, and none whose crc32 marks it as held out. Labels,
language, source and id are never inputs.

Cases: a null or empty text is scored by its structure alone (no words, size 0);
long texts are read whole; without any labelled row, or with one class only, the
model still is a constant near the share of that class (0.5 without rows);
repeated rows get equal scores; other columns are kept, but for score and
predicted, which are replaced.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.common import gives_back, held_out, small_batches

BUCKETS = 1 << 15
RANK = 8
EPOCHS = 6
BATCH = 128
RATE = 0.05
DECAY = 1e-4
REMEMBERED = 150_000
STATISTICS = 16
#: Documents scored at a time.
BLOCK = 128


class Buckets(dict):
    """Bucket of each word met so far."""

    def __missing__(self, word: str) -> int:
        bucket = self[word] = zlib.crc32(word.encode()) % BUCKETS
        return bucket


_KIND = np.zeros(256, dtype=np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 mark, 6 symbol
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[[32, 9, 10, 11, 12, 13]] = 4
_KIND[[ord(c) for c in ".,;:'\"()-"]] = 5
_KIND[[ord(c) for c in "!#$%&*+/<=>?@[\\]^_`{|}~"]] = 6


def describe(text: str | None, buckets: Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their values and the statistics of one text."""
    text = text or ""
    words = text.lower().split()
    n = len(words)
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    kinds = np.bincount(_KIND[raw], minlength=7) / max(1, len(raw))
    ids = np.fromiter(map(buckets.__getitem__, words), dtype=np.int64, count=n)
    found, counts = np.unique(ids, return_counts=True)
    values = np.log1p(counts)
    values /= np.sqrt((values * values).sum()) if n else 1.0
    lines = text.split("\n")
    letters = kinds[1] + kinds[2]
    statistics = np.array(
        [
            np.log1p(n), np.log1p(len(text)), np.log1p(len(lines)),
            kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6],
            kinds[2] / letters if letters else 0.0,
            len(raw) * kinds[6] / max(1, n),
            len(text) / max(1, n),
            len(found) / max(1, n),
            counts.max() / n if n else 0.0,
            np.count_nonzero(ids[1:] == ids[:-1]) / n if n else 0.0,
            len(set(lines)) / len(lines),
        ]
    )
    return found, values, statistics


@gives_back
def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets = Buckets()
    for batch in batches:
        for label, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            ids, values, statistics = describe(text, buckets)
            yield pa.RecordBatch.from_pydict(
                {
                    "label": pa.array([label], pa.int32()),
                    "key": pa.array([key], pa.int64()),
                    "ids": pa.array([ids.astype(np.int32)], pa.list_(pa.int32())),
                    "values": pa.array([values.astype(np.float32)], pa.list_(pa.float32())),
                    "statistics": pa.array([statistics.astype(np.float32)], pa.list_(pa.float32())),
                }
            )


class Machine:
    """Weights, vectors and the scale of the statistics."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        width = BUCKETS + STATISTICS
        self.bias = 0.0
        self.weights = np.zeros(width)
        self.vectors = rng.normal(0.0, 0.01, (width, RANK))
        self.mean, self.spread = np.zeros(STATISTICS), np.ones(STATISTICS)

    def rows(self, described: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature, value and first position of each row, end to end."""
        statistic = np.arange(BUCKETS, BUCKETS + STATISTICS)
        features = [np.concatenate([ids, statistic]) for ids, _, _ in described]
        values = [
            np.concatenate([v, np.clip((s - self.mean) / self.spread, -4.0, 4.0) / 4.0]) for _, v, s in described
        ]
        starts = np.cumsum([0] + [len(f) for f in features[:-1]])
        return np.concatenate(features), np.concatenate(values), starts

    def margin(self, features, values, starts):
        """Margin of each row, and the sums its gradient needs."""
        scaled = self.vectors[features] * values[:, None]
        total = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat(scaled * scaled, starts)
        linear = np.add.reduceat(self.weights[features] * values, starts)
        return self.bias + linear + 0.5 * (total * total - squares).sum(axis=1), scaled, total

    def fit(self, labels: np.ndarray, described: list, seed: int) -> None:
        if not len(labels):
            return
        share = (labels.sum() + 0.5) / (len(labels) + 1.0)
        self.bias = float(np.log(share / (1.0 - share)))
        if labels.min() == labels.max():
            return
        statistics = np.stack([s for _, _, s in described])
        self.mean, self.spread = statistics.mean(axis=0), statistics.std(axis=0) + 1e-6
        rng = np.random.default_rng(seed)
        grown_w, grown_v = np.full(len(self.weights), 1e-6), np.full(self.vectors.shape, 1e-6)
        for _ in range(EPOCHS):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                features, values, starts = self.rows([described[i] for i in chosen])
                margin, scaled, total = self.margin(features, values, starts)
                error = (1.0 / (1.0 + np.exp(-margin)) - labels[chosen]) / len(chosen)
                row = np.repeat(np.arange(len(chosen)), np.diff(np.append(starts, len(features))))
                slope = error[row] * values
                touched, place = np.unique(features, return_inverse=True)
                gw = np.bincount(place, weights=slope) + DECAY * self.weights[touched]
                by_vector = slope[:, None] * (total[row] - scaled)
                gv = np.stack([np.bincount(place, weights=c) for c in by_vector.T], axis=1)
                gv += DECAY * self.vectors[touched]
                grown_w[touched] += gw * gw
                grown_v[touched] += gv * gv
                self.weights[touched] -= RATE * gw / np.sqrt(grown_w[touched])
                self.vectors[touched] -= RATE * gv / np.sqrt(grown_v[touched])
                self.bias -= RATE * float(error.sum())

    def scores(self, described: list) -> np.ndarray:
        if not described:
            return np.zeros(0)
        margin, _, _ = self.margin(*self.rows(described))
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -30.0, 30.0)))


def _fit(seed: int):
    @gives_back
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for label, key, *lists in zip(*batch.columns):
                rows.append((key.as_py(), label.as_py(), tuple(x.values.to_numpy().copy() for x in lists)))
        rows.sort(key=lambda r: r[:2])
        described = [d for _, _, d in rows]
        machine = Machine(seed)
        machine.fit(np.array([r[1] for r in rows], dtype=float), described, seed)
        machine.weights = machine.weights.astype(np.float32)
        machine.vectors = machine.vectors.astype(np.float32)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(machine.__dict__)], pa.binary())})

    return fit


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, seed: int, per_class: bool = False
) -> DataFrame:
    """label, key and text of at most ``max_rows`` labelled rows outside the held-out fold.

    The rows of the smallest seeded hashes; ``per_class`` draws half of them from
    each class. A document id is taken once.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    known = known.withColumn("key", F.xxhash64(F.lit(seed), "doc_id"))
    if per_class:
        parts = [known.where(F.col("label") == c).orderBy("key").limit(max_rows // 2) for c in (0, 1)]
        known = parts[0].unionByName(parts[1])
    else:
        known = known.orderBy("key").limit(max_rows)
    # Bounded by max_rows: the documents are not shuffled.
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return found.select("label", "key", "text")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 8000, seed: int = 7) -> bytes:
    """A fitted machine, pickled: at most a few megabytes whatever the input."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, max_rows, seed)
    schema = "label int, key long, ids array<int>, values array<float>, statistics array<float>"
    # Of a repeated key the row of least content stays, whatever the partitioning.
    content = F.md5(F.to_json(F.struct("label", "ids", "values", "statistics")))
    first = Window.partitionBy("key").orderBy("content")
    described = sample.mapInArrow(_described, schema).withColumn("content", content).withColumn(
        "at", F.row_number().over(first)
    ).where(F.col("at") == 1).drop("content", "at")
    return described.repartition(1).mapInArrow(_fit(seed), "model binary").first()["model"]


def score(docs: DataFrame, model: bytes, threshold: float = 0.3) -> DataFrame:
    """``docs`` with score, from 0 to 1, and predicted: 1 from ``threshold`` on."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    @gives_back
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = Machine.__new__(Machine)
        machine.__dict__ = pickle.loads(held.value)
        buckets = Buckets()
        for batch in texts:
            out = []
            for at in range(0, len(batch), BLOCK):
                out.append(machine.scores([describe(t, buckets) for t in batch.iloc[at : at + BLOCK]]))
                if len(buckets) > REMEMBERED:
                    buckets.clear()
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn("score", scored("text")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 8000) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, max_rows=max_rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
