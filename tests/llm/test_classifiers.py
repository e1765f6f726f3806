from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import quality, toxicity
from ledgerlint.llm.common import held_out

SCHEMA = "doc_id long, text string, lang string, source string, score string, predicted string"


def corpus(seed=1, n=1200):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "tu", "ra") for b in ("n", "ss", "rt", "lo", "ven", "dal")]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        good, toxic = int(rng.random() < 0.8), int(rng.random() < 0.15)
        if not good:
            text = rng.choice([[w.upper() + "!!" for w in text], [w + "$$$" for w in text], [text[0]] * len(text)])
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["zorgul", "zorgan", "idiot"]))
        docs.append((i, " ".join(text), "en", "s", "x", "y"))
        labels.append((i, good, toxic, "z"))
    docs += [(None, None, None, None, None, None), (9001, "", "en", "s", "", ""), (9001, "", "en", "s", "", ""),
             (9002, "long word " * 60000, "en", "s", "", "")]
    labels += [(None, 1, 1, "z"), (9003, 1, 0, "z"), (5, None, None, "z")]
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return (
        spark.createDataFrame(docs, SCHEMA),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"),
    )


@pytest.mark.parametrize("operator,column", [(quality, 1), (toxicity, 2)])
def test_held_out_accuracy(tables, operator, column):
    docs, labels = tables
    rows = operator.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r[0]: r[column] for r in corpus()[1]}
    assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] in (0, 1) for r in rows)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert test and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in test)
    right = {0: [], 1: []}
    for r in test:
        right[truth[r["doc_id"]]].append(r["predicted"] == truth[r["doc_id"]])
    assert all(np.mean(x) > 0.93 for x in right.values())
    assert len({r["score"] for r in rows if r["doc_id"] == 9001}) == 1


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_held_out_labels_are_not_learnt(tables, operator):
    docs, labels = tables
    label = "quality" if operator is quality else "toxic"
    flipped = labels.withColumn(label, F.when(held_out(F.col("doc_id")), 1 - F.col(label)).otherwise(F.col(label)))
    a, b = operator.train(docs, labels), operator.train(docs.repartition(3), flipped)
    one = operator.score(docs, a).select("doc_id", "score").orderBy("doc_id", "score").collect()
    assert one == operator.score(docs, b).select("doc_id", "score").orderBy("doc_id", "score").collect()


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_without_labels_and_without_rows(tables, operator):
    docs, labels = tables
    none = operator.classify(docs, labels.where("doc_id < 0"))
    assert all(0.0 <= r["score"] <= 1.0 for r in none.collect())
    assert operator.classify(docs.where("doc_id < 0"), labels).collect() == []
    kept = operator.score(docs, operator.train(docs, labels.where(f"{'quality' if operator is quality else 'toxic'} = 1")))
    assert set(docs.columns) == set(kept.columns) and kept.count() == docs.count()


def test_interactions_equal_all_pairs():
    rng = np.random.default_rng(2)
    machine = quality.Machine(1)
    machine.vectors = rng.normal(size=machine.vectors.shape)
    machine.weights = rng.normal(size=machine.weights.shape)
    features, values = np.array([3, 77, 200, 5]), rng.normal(size=4)
    margin, _, _ = machine.margin(features, values, np.array([0]))
    pairs = sum(
        machine.vectors[features[i]] @ machine.vectors[features[j]] * values[i] * values[j]
        for i, j in itertools.combinations(range(4), 2)
    )
    assert margin[0] == pytest.approx(machine.weights[features] @ values + pairs)


def test_label_model_discounts_repeated_voters():
    rng = np.random.default_rng(4)
    truth = (rng.random(3000) < 0.3).astype(int)
    good = [np.where(truth == 1, rng.random(3000) < 0.6, rng.random(3000) < 0.02) for _ in range(3)]
    noise = rng.random(3000) < 0.2
    votes = np.stack(good + [noise] * 6, axis=1).astype(float)
    wrong = np.where(rng.random(3000) < 0.04, 1 - truth, truth)
    post = toxicity.label_model(votes, wrong, np.ones(3000))
    assert ((post > 0.5) == truth).mean() > 0.95
