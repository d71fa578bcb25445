"""Quality classifier from weak labels.

Heuristic labellers look at a whole text and vote good (1), bad (-1) or abstain (0).
Their overlapping votes, counted per pattern over all documents, go through
expectation-maximisation: each labeller has its own chance of each vote on good
and on bad texts, each pattern a posterior of being good. The posteriors are soft labels
for a hashed linear scorer over byte n-grams and votes, fitted on at most about
``SAMPLE`` documents; it scores every document. No human label is read.

Cases: missing and empty texts get votes like any short text and score low; with no
rows, or when all votes agree, posteriors stay defined through smoothing; repeated
rows count as often as they occur and score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.llm.features import fit_linear, hashed_ngrams, sample_share
from prepline.llm.host_rules import SYMBOLS, repeated_words
from prepline.llm.text import blocks, split_words, whole

DIMS = 2048
SAMPLE = 4000
KEEP_FROM = 0.5
LABELLERS = ("symbols", "capitals", "marks", "repeats", "variety", "packing", "word_length", "echoes", "length", "short_words")
GOOD, BAD = 1, -1


def _vote(value: np.ndarray, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, 0)).astype(np.int8)


def votes(texts: list[str]) -> np.ndarray:
    """Votes of all labellers, a row a text."""
    codes, distinct, counts = split_words(texts, lower=False)
    n = np.maximum(counts, 1)
    owner = np.repeat(np.arange(len(texts)), counts)
    sums = lambda of_word: np.bincount(owner, of_word[codes], len(texts))
    plain = [w.decode() for w in distinct]
    length = np.fromiter(map(len, plain), float, len(plain))
    last = np.fromiter((w[-1] for w in distinct), np.uint8, len(distinct))
    ends_in_mark = ((last > 32) & (last < 48) | (last > 57) & (last < 65) | (last > 90) & (last < 97) | (last > 122) & (last < 127)).astype(float)
    letters = np.fromiter((len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in plain), float, len(plain))
    capitals = np.fromiter((0 if w.islower() else sum(map(str.isupper, w)) for w in plain), float, len(plain))
    is_short = ((length <= 3) & (letters == length)).astype(float)
    symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts]) / n
    upper = sums(capitals) / np.maximum(1, sums(letters))
    repeats = repeated_words(codes, counts) / n
    pairs = pd.unique(owner * np.int64(max(1, len(distinct))) + codes)
    variety = np.bincount(pairs // max(1, len(distinct)), minlength=len(texts)) / n
    same = np.flatnonzero((codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1]))
    echoes = np.bincount(owner[same], minlength=len(texts)) / n
    raw = [t.encode() for t in texts]
    packing = np.array([len(r) / len(zlib.compress(r, 1)) if r else 0.0 for r in raw])
    marks, word_length, short = sums(ends_in_mark) / n, sums(length) / n, sums(is_short) / n
    # variety falls with length for any text, so its limit does too
    expected = 1.0 / (1.0 + np.log10(np.maximum(n, 10)))
    return np.stack([
        _vote(symbols, symbols > 0.3, symbols < 0.05),
        _vote(upper, upper > 0.5, upper < 0.2),
        _vote(marks, marks > 0.6, marks < 0.35),
        _vote(repeats, repeats > 0.3, repeats < 0.1),
        _vote(variety, variety < 0.4 * expected, variety > 0.8 * expected),
        _vote(packing, packing > 5.0, (packing < 3.2) & (packing > 0)),
        _vote(word_length, (word_length > 15) | (word_length < 2), (word_length > 3) & (word_length < 11)),
        _vote(echoes, echoes > 0.15, echoes < 0.04),
        _vote(n, counts < 15, counts >= 60),
        _vote(short, short < 0.03, short > 0.12),
    ], axis=1)


@dataclass
class VoteModel:
    """What expectation-maximisation learns about the labellers."""

    good_share: float
    chances: np.ndarray  # labeller x class (bad, good) x vote (-1, 0, 1)

    def posterior(self, votes_: np.ndarray) -> np.ndarray:
        """Chance that a text with these votes is good."""
        rows = np.arange(len(LABELLERS))
        logs = np.log(self.chances[rows[None, :], :, votes_ + 1]).sum(axis=1)
        odds = logs[:, 1] - logs[:, 0] + np.log(self.good_share) - np.log1p(-self.good_share)
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -50, 50)))

    def accuracies(self) -> dict[str, float]:
        """Chance that a labeller that votes is right."""
        bad, good = 1 - self.good_share, self.good_share
        right = bad * self.chances[:, 0, 0] + good * self.chances[:, 1, 2]
        spoken = right + bad * self.chances[:, 0, 2] + good * self.chances[:, 1, 0]
        return dict(zip(LABELLERS, right / spoken))


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> VoteModel:
    """Expectation-maximisation over distinct vote patterns and their counts."""
    against = (patterns == BAD).sum(axis=1)
    good = np.array([0.95, 0.35, 0.1, 0.05])[np.minimum(against, 3)]  # says which class is which
    for _ in range(rounds):
        chances = np.empty((len(LABELLERS), 2, 3))
        for c, share in enumerate((1 - good, good)):
            for v in (-1, 0, 1):
                chances[:, c, v + 1] = ((patterns == v) * (share * counts)[:, None]).sum(axis=0) + 1.0
        chances /= chances.sum(axis=2, keepdims=True)
        model = VoteModel(float(np.clip((good * counts).sum() / max(counts.sum(), 1), 0.01, 0.99)), chances)
        before, good = good, model.posterior(patterns)
        if np.abs(good - before).max(initial=0) < 1e-6:
            break
    return model


@dataclass
class Scorer:
    votes: VoteModel
    weights: np.ndarray

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score of the linear scorer and posterior of the votes."""
        cast = votes(texts)
        x = scorer_inputs(texts, cast)
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -50, 50))), self.votes.posterior(cast)


def scorer_inputs(texts: list[str], cast: np.ndarray) -> np.ndarray:
    """Hashed n-grams, followed by an indicator of each labeller's bad and good vote."""
    grams = hashed_ngrams([t.encode() for t in texts], DIMS)
    return np.hstack([grams, cast == BAD, cast == GOOD]).astype(np.float32)


def vote_patterns(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct patterns of votes and the number of texts with each; at most 3 to the power of the labellers."""
    rows = docs.select(whole(text).alias("__text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            found, n = np.unique(votes(block["__text"].tolist()), axis=0, return_counts=True)
            yield pd.DataFrame({"votes": [v.tobytes() for v in found], "n": n})

    return rows.mapInPandas(run, "votes binary, n bigint").groupBy("votes").agg(F.sum("n").alias("n"))


def fit_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Scorer:
    """Labeller chances from all documents, the scorer from a bounded sample with their posteriors."""
    table = vote_patterns(docs, text).toPandas().sort_values("votes")
    patterns = np.frombuffer(b"".join(table["votes"]), np.int8).reshape(len(table), len(LABELLERS))
    model = fit_votes(patterns, table["n"].to_numpy(float))
    total = max(1, int(table["n"].sum()))
    rows = docs.select(F.col(doc_id).alias("__id"), whole(text).alias("__text")).filter(sample_share(doc_id, "quality") < sample / total)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            texts = block["__text"].tolist()
            cast = votes(texts)
            yield pd.DataFrame({"x": [r.tobytes() for r in scorer_inputs(texts, cast).astype(np.float16)],
                                "good": model.posterior(cast)})

    found = rows.select("__text").mapInPandas(run, "x binary, good double").toPandas().sort_values(["x", "good"])
    width = DIMS + 2 * len(LABELLERS)
    if found.empty:
        return Scorer(model, np.zeros(width + 1))
    x = np.frombuffer(b"".join(found["x"]), np.float16).reshape(len(found), width).astype(np.float32)
    return Scorer(model, fit_linear(x, found["good"].to_numpy(), "logistic", rounds=300))


def classify(docs: DataFrame, scorer: Scorer, doc_id: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id, score, posterior, kept`` of every row."""
    rows = docs.select(F.col(doc_id).alias("__id"), whole(text).alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(scorer)  # a fixed number of weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            score, good = sent.value.score(block["__text"].tolist())
            yield pd.DataFrame({"__id": block["__id"], "score": score, "posterior": good, "kept": score >= keep_from})

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInPandas(run, f"__id {kind}, score double, posterior double, kept boolean").withColumnRenamed("__id", doc_id)
