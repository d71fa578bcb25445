"""Resampling documents towards a target distribution, with exact selection of the highest scores.

A document's features are runs of words hashed into buckets. A bucket's gain is the scaled log
ratio of its smoothed share in the target to its share in all documents, and a document's
weight the sum of its features' gains, looked up in one array of the buckets. The score adds
Gumbel noise drawn from the key, so the highest scores are a draw without replacement.

How many to draw is exact, and no table is sorted to find where they end: chunks of the
remaining keys send their median and size; the weighted median of the medians becomes the pivot,
which leaves at least a quarter of the keys on each side; keys on the wrong side are
discarded, until the pivot is the cutoff itself. A round is one pass that counts against the pivot and
takes the medians of both sides. What remains is written anew whenever it has become an eighth,
so all rounds together read little more than a few passes. Only the drawn rows are sorted, in ranges.

Cases: a missing text has no words and the weight 0; rows that share a key share the noise, and are ordered by a
hash of the text; rows equal in key and text are interchangeable, and as many of them are drawn as
there is room for; a missing key has the noise of an empty one and comes last among equal scores; with no target text every bucket has
the target's smoothed share; if the share of documents rounds to none, none is drawn; an empty table gives an empty
result; other columns, whatever their names, are left as they are.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import blocks, discard, stored, whole

BUCKETS, LONGEST = 10_000, 1
SCALE = 1000
LEAST_WORDS, PERCENT, SALT = 20, 10, "2024:"
CHUNK = 1_000_000  # keys that share a median
SHRINK = 8  # remaining keys are written anew at this fraction

# Digits, letters and all bytes of characters beyond ASCII are kept, A-Z in lower case; the rest are gaps.
_WORD_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
KEYS = ["score", "__no_id", "__id", "__hash"]


def features(texts: list[str], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature, text after text; features and words of each text."""
    words = [t.encode().translate(_WORD_BYTES).split() for t in texts]
    runs = words if longest == 1 else [
        [b" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)] for w in words]
    flat = np.empty(sum(map(len, runs)), dtype=object)
    flat[:] = list(chain.from_iterable(runs))
    codes, distinct = pd.factorize(flat)
    bucket = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) % buckets
    return bucket[codes], np.fromiter(map(len, runs), np.int64, len(texts)), np.fromiter(map(len, words), np.int64, len(texts))


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows; as many numbers as there are buckets reach the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            n = np.bincount(features(block["__text"].tolist(), longest, buckets)[0], minlength=buckets)
            some = np.flatnonzero(n)
            yield pd.DataFrame({"bucket": some, "n": n[some]})

    found = texts.select(whole(text).alias("__text")).mapInPandas(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """Scaled log ratio of the smoothed shares of each bucket, floored."""
    buckets = len(all_)
    t, s, t_all, s_all = target.astype(float), all_.astype(float), float(target.sum()), float(all_.sum())
    ratio = ((t + 1.0) * (s_all + buckets)) / ((s + 1.0) * (t_all + buckets))
    return np.array([math.floor(SCALE * math.log(x)) for x in ratio], np.int64)


def text_hash(text: str) -> Column:
    return F.xxhash64(whole(text), F.col(text).isNull())


def score_documents(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST,
                    salt: str = SALT) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` and a hash of the text, for every row."""
    rows = docs.select(F.col(doc_id).alias("__key"), text_hash(text).alias("__hash"), whole(text).alias("__text"))
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            bucket, n, words = features(block["__text"].tolist(), longest, len(sent.value))
            upto = np.concatenate([[0], np.cumsum(sent.value[bucket])])
            ends = np.cumsum(n)
            yield block[["__key", "__hash"]].assign(n_words=words, n_features=n, weight=upto[ends] - upto[ends - n])

    kind = rows.schema["__key"].dataType.simpleString()
    found = rows.mapInPandas(run, f"__key {kind}, __hash bigint, n_words bigint, n_features bigint, weight bigint")
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("__key").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return found.select(F.col("__key").alias(doc_id), "n_words", "n_features", "weight", (F.col("weight") + noise).cast("bigint").alias("score"), "__hash")


# selection -------------------------------------------------------------------------


@dataclass(frozen=True)
class Cutoff:
    """The last key that is drawn, and how many keys come before it."""

    key: tuple
    before: int


def keys_of(scored: DataFrame, doc_id: str) -> list[Column]:
    """Columns that order rows: high scores first, then the key, a missing one last, then the hash."""
    empty = F.lit(0 if scored.schema[doc_id].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else "")
    return [F.col("score"), F.col(doc_id).isNull().cast("int").alias("__no_id"),
            F.coalesce(F.col(doc_id), empty).alias("__id"), F.col("__hash")]


def place(frame: pd.DataFrame, key: tuple) -> np.ndarray:
    """-1, 0 or 1 for keys before, at or after the given one."""
    out = np.zeros(len(frame), np.int8)
    for name, value in zip(KEYS, key):
        column = frame[name]
        less, more = (column < value).to_numpy(bool), (column > value).to_numpy(bool)
        if name == "score":
            less, more = more, less
        out = np.where(out == 0, more.astype(np.int8) - less.astype(np.int8), out)
    return out


def median(frame: pd.DataFrame) -> tuple:
    ordered = frame.sort_values(KEYS, ascending=[False, True, True, True], kind="stable")
    return tuple(ordered.iloc[(len(frame) - 1) // 2][KEYS].tolist())


def weighted_median(medians: list[tuple[tuple, int]]) -> tuple:
    """The first key at which half the weight of all is reached."""
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians, key=lambda m: (-m[0][0], *m[0][1:])):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no key remains")


def chunks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def find_cutoff(keys: DataFrame, count: int, chunk: int = CHUNK) -> Cutoff:
    """The key at place ``count`` of a stored table with the columns ``KEYS``; nothing is sorted but chunks."""
    kind = keys.schema["__id"].dataType.simpleString()
    fields = f"score bigint, __no_id int, __id {kind}, __hash bigint"
    first, last, pivot, before, table, size = None, None, None, 0, keys, None

    def remaining(frame: pd.DataFrame, first: tuple | None, last: tuple | None) -> pd.DataFrame:
        inside = np.ones(len(frame), bool)
        if first is not None:
            inside &= place(frame, first) > 0
        if last is not None:
            inside &= place(frame, last) < 0
        return frame[inside]

    while True:
        def run(batches: Iterator[pd.DataFrame], first=first, last=last, pivot=pivot) -> Iterator[pd.DataFrame]:
            for frame in chunks((remaining(b, first, last) for b in batches), chunk):
                side = np.full(len(frame), -1) if pivot is None else place(frame, pivot)
                out = [(int(s), int((side == s).sum()), *median(frame[side == s])) for s in np.unique(side)]
                yield pd.DataFrame(out, columns=["side", "n", *KEYS])

        near = table
        if first is not None:
            near = near.filter(F.col("score") <= first[0])
        if last is not None:
            near = near.filter(F.col("score") >= last[0])
        found = near.mapInPandas(run, f"side int, n bigint, {fields}").collect()  # up to three rows a chunk
        sides = {s: [(tuple(r[c] for c in KEYS), r["n"]) for r in found if r["side"] == s] for s in (-1, 0, 1)}
        n = {s: sum(m for _, m in rows) for s, rows in sides.items()}
        size = size or n[-1]
        if count <= before + n[-1]:
            last, side = pivot if pivot is not None else last, -1
        elif count <= before + n[-1] + n[0]:
            if table is not keys:
                discard(table)
            return Cutoff(pivot, before + n[-1])
        else:
            before, first, side = before + n[-1] + n[0], pivot, 1
        pivot = weighted_median(sides[side])
        if n[side] * SHRINK <= size:
            def narrow(batches: Iterator[pd.DataFrame], first=first, last=last) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    yield remaining(batch, first, last)

            old, size = table, n[side]
            table = stored(near.mapInPandas(narrow, fields), "resample-keys")
            if old is not keys:
                discard(old)


def at_most(scored: DataFrame, doc_id: str, key: tuple) -> tuple[Column, Column]:
    """Whether a row comes before the key, and whether it is at it."""
    columns, (score, *rest) = keys_of(scored, doc_id), key
    before, same = columns[0] > F.lit(score), columns[0] == F.lit(score)
    for column, value in zip(columns[1:], rest):
        before, same = before | (same & (column < F.lit(value))), same & (column == F.lit(value))
    return before, same


def number_rows(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with their ``rank`` from 1: ranges of the order are sorted each, and one count a range says what comes before."""
    by = [F.desc("__o0"), *[F.asc(f"__o{i}") for i in range(1, len(order))]]
    keyed = rows.select("*", *[c.alias(f"__o{i}") for i, c in enumerate(order)])
    placed = stored(keyed.repartitionByRange(*by).sortWithinPartitions(*by).select(*rows.columns, F.monotonically_increasing_id().alias("__place")), "resample-drawn")
    range_ = F.shiftright("__place", 33)
    counts = {r["range"]: r["n"] for r in placed.groupBy(range_.alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, at = [], 0
    for number in sorted(counts):  # one row a range
        starts.append((number, at))
        at += counts[number]
    table = F.broadcast(rows.sparkSession.createDataFrame(starts, "__range bigint, __before bigint"))
    rank = F.col("__place") - F.shiftleft(F.col("__range"), 33) + F.col("__before") + 1
    return placed.join(table, range_ == F.col("__range")).select(*rows.columns, rank.alias("rank"))


@dataclass
class Draw:
    """Scores of all rows, stored, and where the drawn ones end."""

    scored: DataFrame
    count: int
    cutoff: Cutoff | None
    doc_id: str
    least_words: int

    def drawn(self) -> tuple[Column, Column]:
        """Rows before the cutoff and rows at it."""
        if self.cutoff is None:
            return F.lit(False), F.lit(False)
        enough = F.col("n_words") >= self.least_words
        before, same = at_most(self.scored, self.doc_id, self.cutoff.key)
        return enough & before, enough & same

    def ranked(self) -> DataFrame:
        """All rows with their place among the drawn, null for the others."""
        before, same = self.drawn()
        rows = self.scored.withColumn("__in", before | same)
        out = rows.filter(~F.col("__in")).withColumn("rank", F.lit(None).cast("bigint")).drop("__in")
        if self.cutoff is None:
            return out.drop("__hash")
        placed = number_rows(rows.filter("__in").drop("__in"), keys_of(self.scored, self.doc_id))
        rank = F.when(F.col("rank") <= self.count, F.col("rank").cast("bigint"))  # of equal rows at the cutoff, those with room
        return out.unionByName(placed.withColumn("rank", rank).select(*out.columns)).drop("__hash")


def draw(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, longest: int = LONGEST,
         buckets: int = BUCKETS, least_words: int = LEAST_WORDS, salt: str = SALT, target_text: str = "text", chunk: int = CHUNK) -> Draw:
    """Score every row against the texts of ``target`` and find where ``percent`` of the eligible rows end."""
    gain = gains(bucket_counts(target, target_text, longest, buckets), bucket_counts(docs, text, longest, buckets))
    scored = stored(score_documents(docs, gain, doc_id, text, longest, salt), "resample-scores")
    eligible = scored.filter(F.col("n_words") >= least_words)
    count = percent * eligible.count() // 100
    cutoff = find_cutoff(eligible.select(*keys_of(scored, doc_id)), count, chunk) if count else None
    return Draw(scored, count, cutoff, doc_id, least_words)


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns."""
    found = draw(docs, target, doc_id, text, **options)
    if found.cutoff is None:
        return docs.limit(0)
    before, same = found.drawn()
    keys = lambda rows: rows.select(F.col(doc_id).alias("__drawn"), "__hash").distinct()
    named = F.col(doc_id).eqNullSafe(F.col("__drawn")) & (text_hash(text) == F.col("__hash"))
    first = docs.join(keys(found.scored.filter(before)), named, "left_semi")
    rest = docs.join(keys(found.scored.filter(same)), named, "left_semi").limit(found.count - found.cutoff.before)  # equal rows
    return first.unionByName(rest)
