"""Language identification in two levels.

Texts become hashed byte n-grams. Linear support vector machines first tell language
families apart, then, one machine for each pair of languages, the related languages
within the family. At both levels the class that wins most pairs is predicted.

The machines are fitted on at most about ``PER_LANGUAGE`` texts a language, chosen by a
hash of the key; every text is predicted, whole.

Cases: texts that are missing or have no letter are ``und`` with score 0, as is every
text when no row can be learned from; a language without a listed family is a family
of its own; repeated rows are predicted alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.llm.features import bounded_sample, fit_linear, hashed_ngrams
from prepline.llm.text import blocks

DIMS = 2048
PER_LANGUAGE = 800
UNKNOWN = "und"
# Families of languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}
_LETTER = re.compile(r"[^\W\d_]")


def family_of(lang: str) -> str:
    return _FAMILY.get(lang, f"only {lang}")


def vectors(texts: list[str]) -> np.ndarray:
    return hashed_ngrams([t.lower().encode() for t in texts], DIMS)


@dataclass
class PairwiseMachines:
    """One linear machine for each pair of classes."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # a column a pair, the bias last

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray) -> PairwiseMachines:
        classes = sorted(set(labels))
        pairs = list(combinations(range(len(classes)), 2))
        found = []
        for a, b in pairs:
            first, second = labels == classes[a], labels == classes[b]
            rows = first | second
            y = np.where(first[rows], 1.0, -1.0)
            balance = np.where(y > 0, 0.5 / first.sum(), 0.5 / second.sum())
            found.append(fit_linear(x[rows], y, "hinge", balance))
        return cls(classes, pairs, np.array(found).T if pairs else np.zeros((x.shape[1] + 1, 0)))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the winning class and a confidence from its closest pair."""
        votes = np.zeros((len(x), len(self.classes)))
        margins = x.astype(np.float64) @ self.weights[:-1] + self.weights[-1]
        for j, (a, b) in enumerate(self.pairs):
            votes[:, a] += (margins[:, j] > 0) + 1e-3 * np.tanh(margins[:, j])
            votes[:, b] += (margins[:, j] <= 0) - 1e-3 * np.tanh(margins[:, j])
        best = votes.argmax(axis=1)
        closest = np.full(len(x), np.inf)
        for j, (a, b) in enumerate(self.pairs):
            own = np.where(best == a, margins[:, j], np.where(best == b, -margins[:, j], np.inf))
            closest = np.minimum(closest, own)
        return best, np.where(np.isinf(closest), 1.0, 1.0 / (1.0 + np.exp(-3.0 * np.clip(closest, -10, 10))))


@dataclass
class LanguageModel:
    families: PairwiseMachines
    within: dict[str, PairwiseMachines]

    @classmethod
    def fit(cls, x: np.ndarray, langs: np.ndarray) -> LanguageModel:
        family = np.array([family_of(v) for v in langs])
        within = {f: PairwiseMachines.fit(x[family == f], langs[family == f]) for f in sorted(set(family))}
        return cls(PairwiseMachines.fit(x, family), within)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if not rows:
            return langs, scores
        x = vectors([texts[i] for i in rows])
        best, sure = self.families.predict(x)
        for f in np.unique(best):
            own = np.flatnonzero(best == f)
            machines = self.within[self.families.classes[f]]
            lang, score = machines.predict(x[own])
            for i, k, s in zip(own, lang, score * sure[own]):
                langs[rows[i]], scores[rows[i]] = machines.classes[k], s
        return langs, scores


def fit_languages(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                  per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Model from a bounded sample of the rows that have text and language; None without such rows."""
    rows = labelled.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"), F.col(lang).alias("__lang"))
    rows = rows.filter(F.col("__text").rlike(r"\p{L}") & F.col("__lang").isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            x = vectors(block["__text"].tolist()).astype(np.float16)
            yield pd.DataFrame({"lang": block["__lang"], "x": [row.tobytes() for row in x]})

    found = bounded_sample(rows, "__id", "__lang", per_language, "lang").mapInPandas(run, "lang string, x binary").toPandas()
    if found.empty:
        return None
    found = found.sort_values(["lang", "x"])  # the same sums on every run
    x = np.frombuffer(b"".join(found["x"]), np.float16).reshape(len(found), DIMS).astype(np.float32)
    return LanguageModel.fit(x, found["lang"].to_numpy(str))


def identify(docs: DataFrame, model: LanguageModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights a pair

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            texts = block["__text"].tolist()
            langs, scores = sent.value.predict(texts) if sent.value else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pd.DataFrame({"__id": block["__id"], "lang_pred": langs, "score": scores})

    out = rows.mapInPandas(run, f"__id {rows.schema['__id'].dataType.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("__id", doc_id)
