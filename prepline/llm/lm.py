"""Language-model scores from a log-frequency Bloom filter.

Each block of texts is cut into words once and sends, to each
of a number of buckets, its distinct words and its distinct training bigrams with their training counts. A bucket adds
the counts up, answers each block with the totals of its words, from which the block takes the sums of its
texts (the add-one unigram base), and turns the counts into
a Bloom filter: a count c has the level 1 + floor(log(c) / log(STEP)), and the pairs (gram, 1), ...,
(gram, level) are entered; level 0 is a gram never seen. Buckets grow in number, not in size, with the data.

Scoring sends the filters to the workers and finds the level of a gram by probing (gram, 1),
(gram, 2), ... up to the first miss. A word's probability interpolates a bigram
with a unigram term, with a weight for each level of the context, fitted by
expectation-maximisation on all training texts with their own
occurrences taken off. The levels of all texts are found once and stored, two bytes a token, for both the fit and the scores. The unigram term is normalised over the decoded counts; the bigram term
takes the least count of its level over the greatest of its context's, so the sum over words
does not pass 1 but for false positives. Filters of up to ``FILTER_BYTES`` bytes are broadcast at once;
larger ones go in several passes of that size, with the levels found so far kept beside
the texts until the last, so what is broadcast has a bound and no gram is lost; each pass deletes what the one before wrote.
Grams are hashed to 64 bits: some choose the bucket, 32 others name the gram within it.

Cases: a missing or empty text is its end alone; with no training text, counts are 0
and probabilities uniform over one unknown word; repeated rows count and score as often as they
occur; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import blocks, discard, mix64, split_words, stored, whole

STEP = 1.5
PROBES = 5
BITS_PER_EVENT = 10
FILTER_BYTES = 128 << 20
BUCKET_CHARS = 16_000_000
LEAST_BUCKETS = 64
LEVEL_BYTES = 1_000_000
_TOP_LEVEL = 80
_BLOCK_ROWS = 60_000  # a text's place in its block fits 16 bits
_END = b""  # no word is empty

OUT = "kind string, block bigint, totals binary, x bigint, y bigint, z double, bits binary, a binary, b binary, c binary, d binary, e binary"
SENT = "bucket bigint, kind string, block bigint, a binary, b binary, c binary, d binary, e binary"


def level_of(count: np.ndarray) -> np.ndarray:
    """1 for a count of 1; 0 only for a count of 0."""
    return np.where(count > 0, 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(STEP) + 1e-9), 0).astype(np.int64)


def least_of(level: np.ndarray) -> np.ndarray:
    """The least count of a level, 0 for level 0."""
    return np.where(level > 0, np.ceil(STEP ** (level - 1.0) - 1e-9), 0.0)


def greatest_of(level: np.ndarray) -> np.ndarray:
    """The greatest count of a level, 0 for level 0."""
    return np.where(level > 0, np.ceil(STEP ** (level * 1.0) - 1e-9) - 1, 0.0)


def middle_of(level: np.ndarray) -> np.ndarray:
    """What a word counts in the unigram term; an unknown one counts 1, less than one seen once."""
    return np.where(level > 0, STEP ** (level - 0.5), 1.0)


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter((int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in words), np.uint64, len(words))


def gram_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(mix64(before, 1) ^ word, 2)


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of words and ends, hashes of the codes, and the number of tokens of each text."""
    codes, distinct, counts = split_words(texts)
    with_ends = np.insert(codes, np.cumsum(counts), len(distinct))
    return with_ends, np.append(hash_words(distinct), hash_words([_END])), counts + 1


def contexts(codes: np.ndarray) -> np.ndarray:
    """The code before each token; a text starts after an end."""
    return np.concatenate([codes[-1:], codes[:-1]])


def split_hash(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and the 32 bits that name a gram within it."""
    return (h & np.uint64(0xFFFFFFFF)).astype(np.int64) % buckets, (h >> np.uint64(32)).astype(np.uint32)


# counting --------------------------------------------------------------------------


def runs(sorted_buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    found, starts = np.unique(sorted_buckets, return_index=True)
    for b, low, high in zip(found, starts, np.append(starts[1:], len(sorted_buckets))):
        yield int(b), slice(low, high)


def block_counts(texts: list[str], train: np.ndarray, buckets: int) -> tuple[list[tuple[int, str, bytes, bytes, bytes]], tuple[bytes, bytes, bytes]]:
    """What one block sends to each bucket, and which text holds which word how often, which it keeps."""
    codes, hashes, counts = tokens(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    learned, sent = train[owner], []
    # words: training counts, each word of the block once; they are numbered in the order of their buckets
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    in_training = np.bincount(codes[learned], minlength=len(hashes)).astype(np.uint32)
    for b, own in runs(bucket[order]):
        sent.append((b, "word", hashes[order[own]].tobytes(), in_training[order[own]].tobytes(), b""))
    pair, times = np.unique(number[codes] * np.int64(len(texts)) + owner, return_counts=True)
    more = -(-times // 255)  # a text that holds a word over 255 times is listed again
    pair, place = np.repeat(pair, more), np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    times = np.minimum(255, np.repeat(times, more) - 255 * place).astype(np.uint8)
    held_by = np.bincount(pair // len(texts), minlength=len(hashes)).astype(np.uint32)
    pairs = (held_by.tobytes(), (pair % len(texts)).astype(np.uint16).tobytes(), times.tobytes())
    grams, n = np.unique(gram_hash(hashes[contexts(codes)], hashes[codes])[learned], return_counts=True)
    bucket, name = split_hash(grams, buckets)
    order = np.argsort(bucket, kind="stable")
    for b, own in runs(bucket[order]):
        rows, often = order[own], n[order[own]]
        # counts of 255 and more are listed on their own, after the one-byte counts
        large = np.flatnonzero(often >= 255)
        sent.append((b, "gram", name[rows].tobytes(), np.minimum(often, 255).astype(np.uint8).tobytes(), (often[large] - 255).astype(np.uint32).tobytes()))
    return sent, pairs


def read(cells: pd.Series, kind) -> tuple[np.ndarray, np.ndarray]:
    """All arrays of a column, end to end, and the length of each."""
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(cells), kind), np.fromiter((len(c) // size for c in cells), np.int64, len(cells))


def positions(name: np.ndarray, order: int, level: np.ndarray | int, bits: int) -> np.ndarray:
    """Places in a filter of the pair (gram, level); a column a probe."""
    event = mix64(name.astype(np.uint64) | np.uint64(order) << np.uint64(32) | np.asarray(level).astype(np.uint64) << np.uint64(40), 9)
    step = mix64(event, 10) | np.uint64(1)
    return np.stack([((event + np.uint64(i) * step) >> np.uint64(16)) % np.uint64(bits) for i in range(PROBES)], axis=-1).astype(np.int64)


def build_filter(grams: list[tuple[int, np.ndarray, np.ndarray]], per_event: int = BITS_PER_EVENT) -> bytes:
    """Filter of (order, names, counts): one bit array that holds (gram, 1), ..., (gram, level)."""
    events = sum(int(level_of(c).sum()) for _, _, c in grams)
    bits = max(64, -(-events * per_event // 64) * 64)
    table = np.zeros(bits // 8, np.uint8)
    for order, names, counts in grams:
        level = level_of(counts)
        for k in range(1, int(level.max(initial=0)) + 1):
            at = positions(names[level >= k], order, k, bits).ravel()
            np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return table.tobytes()


def bucket_answers(group: pd.DataFrame, per_event: int = BITS_PER_EVENT) -> pd.DataFrame:
    """Counts of one bucket: the total of each word a block asked for, sums, and the bucket's filter.

    A word comes once a block, however often the texts hold it, so common words weigh no more than rare ones.
    """
    out, words, grams = [], group[group["kind"] == "word"], group[group["kind"] == "gram"]
    row = lambda **x: out.append({"kind": None, "block": None, "totals": None, "x": None, "y": None, "z": None, "bits": None,
                                  **dict.fromkeys("abcde")} | x)
    for _, r in group[group["kind"] == "texts"].iterrows():  # what a block keeps for itself passes through
        row(kind="texts", block=r["block"], **{c: r[c] for c in "abcde"})
    entries, bucket = [], int(group["bucket"].iloc[0])
    hashes, sizes = read(words["a"], np.uint64)
    distinct, place = np.unique(hashes, return_inverse=True)
    total = np.bincount(place, read(words["b"], np.uint32)[0], len(distinct)).astype(np.int64)
    ends = np.cumsum(sizes)
    for block, low, high in zip(words["block"], ends - sizes, ends):
        row(kind="totals", block=block, x=bucket, totals=total[place[low:high]].tobytes())
    seen = total > 0
    level = level_of(total[seen])
    row(kind="words", x=int(total.sum()), y=int(seen.sum()), z=float(middle_of(level).sum()))
    entries.append((1, (distinct[seen] >> np.uint64(32)).astype(np.uint32), total[seen]))
    names, _ = read(grams["a"], np.uint32)
    counts = read(grams["b"], np.uint8)[0].astype(np.int64)
    counts[counts == 255] += read(grams["c"], np.uint32)[0]
    distinct, place = np.unique(names, return_inverse=True)
    entries.append((2, distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)))
    row(kind="filter", x=bucket, bits=build_filter(entries, per_event))
    return pd.DataFrame(out, columns=["kind", "block", "totals", "x", "y", "z", "bits", *"abcde"])


def block_bases(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """One block's texts with the totals of its words from all buckets: a row a text."""
    if not len(texts):
        return pd.DataFrame({"__key": [], "__hash": [], "n_tokens": [], "n_known": [], "log_sum": []})
    own = texts.iloc[0]
    total, _ = read(answers.sort_values("x")["totals"], np.int64)
    held_by, doc, times = (np.frombuffer(own[c], kind) for c, kind in (("b", np.uint32), ("c", np.uint16), ("d", np.uint8)))
    ids, word = json.loads(own["a"]), np.repeat(np.arange(len(held_by)), held_by)
    sums = np.bincount(doc, times * np.log10(total + 1.0)[word], len(ids))
    known = np.bincount(doc, times * (total > 0)[word].astype(float), len(ids)).astype(np.int64)
    return pd.DataFrame({"__key": ids, "__hash": np.frombuffer(own["e"], np.int64), "n_tokens": np.bincount(doc, times, len(ids)).astype(np.int64),
                         "n_known": known, "log_sum": sums})


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


@dataclass
class Counts:
    """The answers of all buckets, stored, and the totals of the training tokens."""

    answers: DataFrame
    bases: DataFrame  # stored: ``__key, __hash`` (of key and text) with tokens, known tokens and the sum of log10(c + 1)
    buckets: int
    n: int  # tokens
    v: int  # distinct tokens
    norm: float  # decoded counts of all words and one unknown
    filter_bytes: int


def count_grams(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", per_event: int = BITS_PER_EVENT) -> Counts:
    """Count words and bigrams of the training rows; measure the base of all rows."""
    rows = docs.select(F.col(doc_id).cast("string").alias("__key"), train.alias("__train"), whole(text).alias("__text"))
    chars = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-chars // BUCKET_CHARS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = TaskContext.get().partitionId() << 32
        for big in blocks(batches, "__text"):
            for start in range(0, len(big), _BLOCK_ROWS):
                block = big.iloc[start : start + _BLOCK_ROWS]
                texts, learned = block["__text"].tolist(), block["__train"].fillna(False).to_numpy(bool)
                found, pairs = block_counts(texts, learned, buckets)
                sent = [(b, kind, at, *parts, b"", b"") for b, kind, *parts in found]
                keys = json.dumps([None if k is None or k != k else k for k in block["__key"]]).encode()
                sent.append((int(mix64(np.array([at], np.uint64))[0] % np.uint64(buckets)), "texts", at, keys, *pairs, np.array([text_hash(t) for t in texts], np.int64).tobytes()))
                yield pd.DataFrame(sent, columns=["bucket", "kind", "block", "a", "b", "c", "d", "e"])
                at += 1

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        return bucket_answers(group, per_event)

    answers = stored(rows.mapInPandas(run, SENT).groupBy("bucket").applyInPandas(answer, OUT), "lm-counts")
    totals = answers.filter("kind = 'totals'").select("block", "x", "totals").groupBy("block")
    found = answers.filter("kind = 'texts'").select("block", *"abcde").groupBy("block").cogroup(totals).applyInPandas(
        block_bases, "__key string, __hash bigint, n_tokens bigint, n_known bigint, log_sum double")
    bases = stored(found.groupBy("__key", "__hash").agg(*[F.max(c).alias(c) for c in ("n_tokens", "n_known", "log_sum")]), "lm-bases")
    t = answers.agg(*[F.sum(F.when(F.col("kind") == "words", F.col(c))).alias(c) for c in "xyz"],
                    F.sum(F.when(F.col("kind") == "filter", F.octet_length("bits"))).alias("bytes")).first()
    return Counts(answers, bases, buckets, t["x"] or 0, t["y"] or 0, (t["z"] or 0.0) + 1.0, t["bytes"] or 0)


# probing ---------------------------------------------------------------------------


class Filters:
    """Filters of some buckets, as one array on a worker."""

    def __init__(self, rows: list[tuple[int, bytes]], buckets: int):
        self.start, self.bits = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        at = 0
        for b, raw in rows:
            self.start[b], self.bits[b] = at, 8 * len(raw)
            at += len(raw)
        self.table, self.buckets = np.frombuffer(b"".join(raw for _, raw in rows), np.uint8), buckets

    def levels(self, bucket: np.ndarray, name: np.ndarray, order: int) -> np.ndarray:
        """Level of each gram by probing until the first miss; 0 for buckets that are not here."""
        level = np.zeros(len(name), np.int64)
        live = np.flatnonzero(self.bits[bucket] > 0)
        for k in range(1, _TOP_LEVEL):
            if not len(live):
                break
            start, bits = self.start[bucket[live]], self.bits[bucket[live]].astype(np.uint64)
            event = mix64(name[live].astype(np.uint64) | np.uint64(order) << np.uint64(32) | np.uint64(k) << np.uint64(40), 9)
            step = mix64(event, 10) | np.uint64(1)
            rest = np.arange(len(live))
            for i in range(PROBES):
                at = ((event[rest] + np.uint64(i) * step[rest]) >> np.uint64(16)) % bits[rest]
                hit = self.table[start[rest] + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                rest = rest[hit == 1]
            live = live[rest]
            level[live] = k
        return level

    def token_levels(self, codes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Level of each token and of each bigram that ends in it."""
        words = self.levels((hashes % np.uint64(self.buckets)).astype(np.int64), (hashes >> np.uint64(32)).astype(np.uint32), 1)
        pair, place = np.unique(contexts(codes) * np.int64(len(hashes)) + codes, return_inverse=True)
        grams = gram_hash(hashes[pair // len(hashes)], hashes[pair % len(hashes)])
        return words[codes], self.levels(*split_hash(grams, self.buckets), 2)[place]


@dataclass
class Model:
    """Everything a score needs but the levels."""

    norm: float
    weights: np.ndarray  # of the bigram term, by level of the context

    def terms(self, before: np.ndarray, word: np.ndarray, gram: np.ndarray, less: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Bigram term and unigram term of tokens after contexts of the level ``before``; ``less`` comes off the bigram's count."""
        bigram = np.maximum(least_of(gram) - less, 0) / np.maximum(greatest_of(before), 1)
        return np.where(before > 0, np.minimum(bigram, 1.0), 0.0), middle_of(word) / self.norm

    def log_probability(self, word: np.ndarray, gram: np.ndarray) -> np.ndarray:
        before = contexts(word)
        bigram, unigram = self.terms(before, word, gram)
        weight = self.weights[before]
        return np.log10(weight * bigram + (1 - weight) * unigram)


def _passes(counts: Counts, limit: int) -> list[list[int]]:
    """Buckets in groups whose filters together stay within the limit; one alone may pass it."""
    sizes = counts.answers.filter("kind = 'filter'").select("x", F.octet_length("bits").alias("n"))
    even = max(1, -(-counts.filter_bytes // limit))
    if even == 1:
        return [list(range(counts.buckets))]
    groups, room = [[]], limit
    for b, n in sorted((r["x"], r["n"]) for r in sizes.collect()):  # one row a bucket
        if n > room and groups[-1]:
            groups, room = [*groups, []], limit
        groups[-1].append(b)
        room -= n
    return groups


def with_levels(docs: DataFrame, train: Column, counts: Counts, doc_id: str, text: str, limit: int = FILTER_BYTES) -> DataFrame:
    """``__id, __train, __hash2, __levels`` of every row, stored: the levels of each token and of the bigram that ends in it."""
    rows = docs.select(F.col(doc_id).alias("__id"), train.alias("__train"), whole(text).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    groups = _passes(counts, limit)
    for i, group in enumerate(groups):
        filters = counts.answers.filter((F.col("kind") == "filter") & F.col("x").between(group[0], group[-1])).select("x", "bits")
        sent = docs.sparkSession.sparkContext.broadcast(Filters([(r["x"], r["bits"]) for r in filters.collect()], counts.buckets))
        first, last = i == 0, i == len(groups) - 1

        def run(batches: Iterator[pd.DataFrame], sent=sent, first=first, last=last) -> Iterator[pd.DataFrame]:
            for block in blocks(batches, "__text"):
                if not len(block):
                    continue
                texts = block["__text"].tolist()
                codes, hashes, n = tokens(texts)
                word, gram = sent.value.token_levels(codes, hashes)
                if not first:
                    old, _ = read_levels(block["__levels"])
                    word, gram = np.maximum(word, old[:, 0]), np.maximum(gram, old[:, 1])
                raw, ends = np.stack([word, gram], 1).astype(np.uint8).tobytes(), np.cumsum(n) * 2
                out = block[["__id", "__train"]].assign(__levels=[raw[e - 2 * m : e] for e, m in zip(ends, n)])
                yield out.assign(__hash2=[text_hash(t) for t in texts]) if last else out.assign(__text=texts)

        before, rows = rows, stored(
            rows.mapInPandas(run, f"__id {kind}, __train boolean, __levels binary, " + ("__hash2 bigint" if last else "__text string")), "lm-levels")
        discard(before)
        sent.unpersist()
    return rows


def read_levels(cells: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Levels of words and bigrams of some texts, and the number of tokens of each."""
    raw, n = read(cells, np.uint8)
    return raw.reshape(-1, 2).astype(np.int64), n // 2


def tune(levels: DataFrame, counts: Counts) -> Model:
    """Weights of the bigram term that suit all training texts, each gram counted once less."""
    model = Model(counts.norm, np.zeros(_TOP_LEVEL + 1))
    if not counts.n:
        return model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__levels", LEVEL_BYTES):
            if len(block):
                word, gram = read_levels(block["__levels"])[0].T
                # tokens with equal levels are one row with a count
                found, often = np.unique((contexts(word) << 16) + (word << 8) + gram, return_counts=True)
                yield pd.DataFrame({"levels": found, "n": often})

    rows = levels.filter("__train").select("__levels")
    found = rows.mapInPandas(run, "levels bigint, n bigint").groupBy("levels").agg(
        F.sum("n").alias("n")).toPandas().sort_values("levels")  # levels are few
    code, often = found["levels"].to_numpy(), found["n"].to_numpy()
    before, word, gram = code >> 16, code >> 8 & 255, code & 255
    # with its own occurrence taken off, a context of the least count of its level falls to the level below
    least, greatest = least_of(before), greatest_of(before)
    falls = np.where(before > 0, 2 * least / np.maximum((least + greatest) * (greatest - least + 1), 1), 0.0)
    before, often = np.concatenate([np.maximum(before - 1, 0), before]), np.concatenate([often * falls, often * (1 - falls)])
    bigram, unigram = model.terms(before, np.tile(word, 2), np.tile(gram, 2), less=1)
    weights = np.full(_TOP_LEVEL + 1, 0.3)
    for _ in range(40):
        share = weights[before] * bigram
        share = share / (share + (1 - weights[before]) * unigram)
        weights = (np.bincount(before, share * often, _TOP_LEVEL + 1) + 0.3) / (np.bincount(before, often, _TOP_LEVEL + 1) + 1.0)
    weights[0] = 0.0
    return Model(counts.norm, weights)


def score_texts(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", limit: int = FILTER_BYTES,
                per_event: int = BITS_PER_EVENT) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    counts = count_grams(docs, train, doc_id, text, per_event)
    levels = with_levels(docs, train, counts, doc_id, text, limit)
    model = tune(levels, counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__levels", LEVEL_BYTES):
            if len(block):
                found, n = read_levels(block["__levels"])
                total = np.add.reduceat(model.log_probability(found[:, 0], found[:, 1]), np.cumsum(n) - n)
                yield pd.DataFrame({"__id": block["__id"], "__hash2": block["__hash2"], "score": total})

    kind = levels.schema["__id"].dataType.simpleString()
    scores = levels.select("__id", "__hash2", "__levels").mapInPandas(run, f"__id {kind}, __hash2 bigint, score double")
    discard(counts.answers)
    bases = counts.bases
    same = (F.col("__hash") == F.col("__hash2")) & F.col("__key").eqNullSafe(F.col("__id").cast("string"))
    base = F.col("log_sum") - F.col("n_tokens") * F.lit(float(np.log10(counts.n + counts.v + 1.0)))
    return scores.join(bases, same).select(
        F.col("__id").alias(doc_id), "n_tokens", "n_known", F.lit(counts.n).cast("bigint").alias("train_tokens"),
        base.alias("base_score"), "score")
