"""Quality rules with host verdicts.

Every document is measured once: words, their characters, symbols, repeated lines
and words in repeated 8-word windows. Two base rules reject a document outright.
Four soft rules compare shares of these measures with two limits, a lenient and a
strict one. Failures (of the lenient limits or the base rules) are added up per host and
rule; the rate of a host is shrunk towards all hosts by a beta prior that is fitted
to the hosts' own rates by moments. A host whose shrunk rate exceeds
``MAX_HOST_RATE`` for a rule is distrusted for it, and its documents are then held
to the strict limit of that rule; others are held to the lenient one.

Cases: a missing or empty text has no words and fails a base rule; a missing host
is a host of its own; with one host, or hosts that do not differ, the prior has the
weight of ``PRIOR_WEIGHT`` documents; repeated rows count as often as they occur;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import attach, blocks, split_words, stored, whole

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MAX_HOST_RATE = 0.5
PRIOR_WEIGHT = 20.0
SYMBOLS = "#*$%&|<>"
#: rule: (measure, base of its share, lenient limit in percent, strict limit in percent)
SOFT_RULES = {
    "symbols": ("n_symbols", "n_words", 40, 10),
    "dup_lines": ("n_dup_lines", "n_lines", 60, 30),
    "repeats": ("n_repeat_words", "n_words", 30, 20),
    "long_words": ("word_chars", "n_words", 2000, 1200),
}
RULES = ("base", *SOFT_RULES)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SPACE = re.compile(r"[\x20\x09-\x0D]")


def repeated_words(codes: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text, the words inside windows that occur in it twice or more.

    Windows of 2, 4 and 8 words get exact codes from pairs of codes, so equal codes mean equal words.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    code, span = codes, 1
    while span < window:
        n = len(code) - span
        if n <= 0:
            return np.zeros(len(counts), np.int64)
        code = pd.factorize(code[:n] * np.int64(code.max() + 1) + code[span : span + n])[0].astype(np.int64)
        span *= 2
    n = len(codes) - window + 1
    inside = owner[:n] == owner[window - 1 :]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(len(counts), np.int64)
    pair = pd.factorize(code[at] * np.int64(len(counts)) + owner[at])[0]
    again = at[np.bincount(pair)[pair] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(owner[covered], minlength=len(counts))


def measures(texts: list[str]) -> pd.DataFrame:
    codes, _, counts = split_words(texts, lower=False)
    dup_lines, n_lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x and _SPACE.sub("", x)] if "\n" in t else [t][: bool(counts[i])]
        n_lines[i], dup_lines[i] = len(lines), len(lines) - len(set(lines))
    return pd.DataFrame({
        "n_words": counts,
        "word_chars": [len(t) - sum(map(t.count, " \t\n\v\f\r")) for t in texts],
        "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
        "n_dup_lines": dup_lines, "n_repeat_words": repeated_words(codes, counts), "n_lines": n_lines,
    })


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``__id, __host`` and the measures of every row; no row moves."""
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(host).alias("__host"), whole(text).alias("__text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            yield pd.concat([block[["__id", "__host"]], measures(block["__text"].tolist())], axis=1)

    kind = lambda c: rows.schema[c].dataType.simpleString()
    return rows.mapInPandas(run, f"__id {kind('__id')}, __host {kind('__host')}, " + ", ".join(f"{m} bigint" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def breaks(rule: str, strict: bool) -> Column:
    part, base, lenient, hard = SOFT_RULES[rule]
    return 100 * F.col(part) > (hard if strict else lenient) * F.col(base)


def host_rates(measured: DataFrame, prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """``__host`` with documents and, for each rule, the failures and the shrunk rate."""
    fails = {"base": base_failed(), **{r: breaks(r, strict=False) for r in SOFT_RULES}}
    hosts = measured.groupBy("__host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("bigint")).alias(f"f_{r}") for r, c in fails.items()])
    # moments over hosts: with rates p and m documents, E(p) = a / (a + b) and var(p) = E(p)(1 - E(p)) (1 + (a + b) E(1/m)) / (1 + a + b)
    rate = lambda r: F.col(f"f_{r}") / F.col("n")
    moments = hosts.agg(
        F.avg(1.0 / F.col("n")).alias("__inv"),
        *[F.avg(rate(r)).alias(f"__m_{r}") for r in RULES], *[F.var_pop(rate(r)).alias(f"__v_{r}") for r in RULES])
    out = hosts.crossJoin(F.broadcast(moments))  # one row on the right
    for r in RULES:
        m, v = F.col(f"__m_{r}"), F.col(f"__v_{r}")
        spread = m * (1 - m)
        excess = v - spread * F.col("__inv")
        fitted = (spread - v) / excess
        weight = F.when((excess > 0) & (fitted > 0), fitted).otherwise(F.lit(prior_weight))
        out = out.withColumn(f"rate_{r}", (F.col(f"f_{r}") + m * weight) / (F.col("n") + weight))
    return out.select("__host", "n", *[f"f_{r}" for r in RULES], *[f"rate_{r}" for r in RULES])


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
           max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures of every row with ``base_failed``, the rules its host is distrusted for, and ``kept``."""
    measured = stored(measure(docs, doc_id, text, host), "measures")
    names = F.array_compact(F.array(*[F.when(F.col(f"rate_{r}") > max_host_rate, F.lit(r)) for r in RULES]))
    bad = host_rates(measured).select(F.col("__host").alias("__bad"), names.alias("distrusted")).filter(F.size("distrusted") > 0)
    rows = attach(measured, stored(bad, "hosts"), F.col("__host").eqNullSafe(F.col("__bad")))
    # a null flag means that no host row was joined: the host is trusted
    distrusted = F.coalesce(F.col("distrusted"), F.array().cast("array<string>"))
    broken = [F.when(F.array_contains(distrusted, r) | F.array_contains(distrusted, "base"), breaks(r, strict=True)).otherwise(
        breaks(r, strict=False)) for r in SOFT_RULES]
    failed = base_failed()
    any_broken = broken[0]
    for b in broken[1:]:
        any_broken = any_broken | b
    return rows.select(
        F.col("__id").alias(doc_id), *MEASURES[:-1], failed.alias("base_failed"), distrusted.alias("distrusted"),
        (~failed & ~any_broken).alias("kept"))
