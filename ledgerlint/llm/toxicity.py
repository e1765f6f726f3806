"""Toxicity by weak supervision.

Voters are words and word beginnings that lean to toxic documents, a short
lexicon and a few patterns; each votes "toxic" or abstains. A generative label
model estimates, by expectation maximisation, how often a voter fires on toxic
and on clean documents, and how voters correlate given the label; correlated
voters share their weight. A linear classifier is trained on the posterior
labels and scores every document.

Voters and models are fitted in one task on at most ``max_rows`` labelled
documents (half of each class, so far as there are), none of them held out.
Labels, language, source and id are never inputs.

Cases: a null or empty text has no voter and gets the score of the intercept;
long texts are read whole; without toxic examples only the lexicon votes, and
without any labelled row its voters have fixed weights; repeated rows get equal
scores; other columns are kept, but for score and predicted, which are replaced.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import held_out, small_batches
from ledgerlint.llm.quality import labelled_sample

#: Voters at most, and the toxic documents a voter must be seen in: so many and such a
#: share, lest the words of one much-copied document vote.
VOTERS = 600
SUPPORT = 4
SUPPORT_SHARE = 0.008
#: How much likelier a voter must be in toxic documents.
LEAN = 10.0
#: Odds that a training label is right: it is one more voter.
LABEL_ODDS = 50.0
BEGINNINGS = (4, 5, 6)
REMEMBERED = 150_000

LEXICON = frozenset(
    "arse bastard clown coward creep crap disgusting dumb fool freak garbage hate idiot "
    "imbecile jerk kill loser moron pathetic pig scum shit stupid trash ugly vermin worthless".split()
)
_STRIP = " \t\r\n.,;:!?\"'()[]{}<>*#$%&|_-+=/\\~`@^"
_MASKED = regex.compile(r"\p{L}[*@#$]{2,}\p{L}")
_PATTERNS = ("\0lexicon", "\0lexicon twice", "\0masked", "\0shouted insult")


def term_id(term: str) -> int:
    return zlib.crc32(term.encode()) - (1 << 31)


class Terms(dict):
    """Ids of the terms of each word: the word and its beginnings."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        terms = [word] + [word[:n] + "\0" for n in BEGINNINGS if len(word) >= n]
        found = self[word] = tuple(map(term_id, terms))
        return found


def patterns(text: str, words: set[str]) -> list[int]:
    """Ids of the pattern voters that fire."""
    out = []
    insults = LEXICON & words
    if insults:
        out.append(_PATTERNS[0])
        if len(insults) > 1:
            out.append(_PATTERNS[1])
        if any(w.upper() in text for w in insults):
            out.append(_PATTERNS[3])
    if _MASKED.search(text):
        out.append(_PATTERNS[2])
    return [term_id(x) for x in out]


def words_of(text: str) -> set[str]:
    words = {w.strip(_STRIP) for w in set(text.lower().split())}
    words.discard("")
    return words


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms = Terms()
    for batch in batches:
        for label, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = words_of(text or "")
            found = {t for w in words for t in terms[w]}
            found.update(patterns(text or "", words))
            yield pa.RecordBatch.from_pydict(
                {
                    "label": pa.array([label], pa.int32()),
                    "key": pa.array([key], pa.int64()),
                    "terms": pa.array([np.array(sorted(found), dtype=np.int32)], pa.list_(pa.int32())),
                }
            )


def mine(labels: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Ids of the terms that vote: those that lean most to toxic documents."""
    fixed = np.array(sorted(map(term_id, _PATTERNS)), dtype=np.int64)
    toxic = labels == 1
    if not toxic.any() or not len(lists):
        return fixed
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    ids, place = np.unique(np.concatenate(lists), return_inverse=True)
    in_toxic = np.bincount(place, weights=toxic[row], minlength=len(ids))
    in_clean = np.bincount(place, weights=~toxic[row], minlength=len(ids))
    lean = ((in_toxic + 0.1) / (toxic.sum() + 0.2)) / ((in_clean + 0.1) / ((~toxic).sum() + 0.2))
    support = max(SUPPORT, SUPPORT_SHARE * toxic.sum())
    gain = np.where((in_toxic >= support) & (lean >= LEAN), in_toxic * np.log(lean), -1.0)
    best = np.lexsort((ids, -gain))[:VOTERS]
    return np.union1d(ids[best[gain[best] > 0]].astype(np.int64), fixed)


def votes_of(lists: list[np.ndarray], voters: np.ndarray) -> np.ndarray:
    """Whether each voter fires on each document."""
    out = np.zeros((len(lists), len(voters)))
    for i, terms in enumerate(lists):
        at = np.searchsorted(voters, terms)
        at[at == len(voters)] = 0
        out[i, at[voters[at] == terms]] = 1.0
    return out


def label_model(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Posterior probability of "toxic", by expectation maximisation.

    The training label is a voter of known accuracy. Given the true label, the
    residual correlation of two voters tells how much they repeat each other; a
    voter counts by one over the sum of its positive correlations.
    """
    gold = np.where(labels == 1, 1.0, -1.0) * np.log(LABEL_ODDS)
    post = 1.0 / (1.0 + np.exp(-gold))
    for _ in range(rounds):
        toxic, clean = post * weights, (1.0 - post) * weights
        prior = np.clip(toxic.sum() / weights.sum(), 1e-3, 1 - 1e-3)
        fires_toxic = (toxic @ votes + 0.05) / (toxic.sum() + 1.0)
        fires_clean = (clean @ votes + 0.005) / (clean.sum() + 1.0)
        residual = votes - np.outer(post, fires_toxic) - np.outer(1.0 - post, fires_clean)
        residual *= np.sqrt(weights)[:, None]
        spread = np.sqrt((residual * residual).sum(axis=0)) + 1e-9
        correlation = np.clip((residual.T @ residual) / np.outer(spread, spread), 0.0, 1.0)
        correlation[correlation < 0.1] = 0.0
        np.fill_diagonal(correlation, 1.0)
        share = 1.0 / correlation.sum(axis=0)
        fired = np.log(fires_toxic / fires_clean) * share
        silent = np.log((1.0 - fires_toxic) / (1.0 - fires_clean)) * share
        logit = gold + np.log(prior / (1.0 - prior)) + votes @ fired + (1.0 - votes) @ silent
        post = 1.0 / (1.0 + np.exp(-np.clip(logit, -30.0, 30.0)))
    return post


def linear_model(votes: np.ndarray, post: np.ndarray, weights: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton steps with a ridge."""
    x = np.hstack([votes, np.ones((len(votes), 1))])
    beta, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 0.5)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30.0, 30.0)))
        gradient = x.T @ ((p - post) * weights) + ridge * beta
        curve = (x * (p * (1.0 - p) * weights + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        beta -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return beta[:-1], float(beta[-1])


def fit(labels: np.ndarray, lists: list[np.ndarray], toxic_share: float) -> dict:
    """Voters, their weights in the linear classifier, and its intercept."""
    voters = mine(labels, lists)
    if not len(labels) or labels.min() == labels.max():
        weight = np.where(np.isin(voters, [term_id(x) for x in _PATTERNS[:2]]), 4.0, 0.0)
        return {"voters": voters, "weights": weight, "bias": -3.0}
    votes = votes_of(lists, voters)
    # The sample holds as many rows of each class; their weights restore the shares.
    n_toxic = labels.sum()
    weights = np.where(labels == 1, toxic_share / n_toxic, (1.0 - toxic_share) / (len(labels) - n_toxic)) * len(labels)
    post = label_model(votes, labels, weights)
    coefficients, bias = linear_model(votes, post, weights)
    return {"voters": voters, "weights": coefficients, "bias": bias}


def _fit(toxic_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for label, key, terms in zip(*batch.columns):
                rows.append((key.as_py(), label.as_py(), terms.values.to_numpy().copy()))
        rows.sort(key=lambda r: r[:2])
        model = fit(np.array([r[1] for r in rows], dtype=int), [r[2] for r in rows], toxic_share)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    return run


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 8000, seed: int = 11) -> bytes:
    """The fitted voters and classifier, pickled: a few kilobytes."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    share = known.agg(F.avg(F.col(label).cast("double"))).first()[0]
    sample = labelled_sample(docs, labels, label, max_rows, seed, per_class=True)
    described = sample.mapInArrow(_described, "label int, key long, terms array<int>").dropDuplicates(["key"])
    return described.repartition(1).mapInArrow(_fit(share or 0.0), "model binary").first()["model"]


def score(docs: DataFrame, model: bytes, threshold: float = 0.5) -> DataFrame:
    """``docs`` with score, from 0 to 1, and predicted: 1 from ``threshold`` on."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = pickle.loads(model)
        weight = dict(zip(fitted["voters"].tolist(), fitted["weights"].tolist()))
        bias, ids = fitted["bias"], Terms()

        class Known(dict):
            """Voters among the terms of each word."""

            def __missing__(self, word: str) -> tuple[int, ...]:
                found = self[word] = tuple(t for t in Terms.__missing__(ids, word) if t in weight)
                return found

        known = Known()
        for batch in texts:
            out = np.empty(len(batch))
            for i, text in enumerate(batch):
                text = text or ""
                words = words_of(text)
                fired = {t for w in words for t in known[w]}
                fired.update(t for t in patterns(text, words) if t in weight)
                out[i] = bias + sum(weight[t] for t in sorted(fired))
                if len(known) > REMEMBERED:
                    known.clear()
                    ids.clear()
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(out, -30.0, 30.0))))

    return docs.withColumn("score", scored("text")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 8000) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, max_rows=max_rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
