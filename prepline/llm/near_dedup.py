"""Near-duplicates by SetSketch registers.

A document is its set of distinct 5-word shingles; two are linked when they share at
least three quarters of their union. Every set gets ``REGISTERS`` registers: for each,
the shingles draw exponential values, and the least one is kept on an exponential scale,
floor(1 - log_b(min)), cut to [0, Q + 1]. Registers of a union are the larger ones, and
equal registers mean similar sets.

1. Sets that are equal become one class; only one set a class goes on.
2. ``BANDS`` bands of ``ROWS`` registers give band keys, and every group of equal keys has a hub.
   Each set is paired with the first hub among its groups: one pair a set.
3. A pair's similarity is estimated jointly from the signs of all register differences
   and the set sizes, by maximum likelihood; clearly lower pairs go.
4. The others are confirmed on their full sets, read again from the documents.
5. ``HUB_ROUNDS`` times, every group takes another hub, and sets outside its component are paired
   with it; then steps 3 and 4.
6. Those still outside meet the remaining members of the group that are in other components, in the
   first band they share, if the threshold can be reached by the counts, part by part of the hash
   space, of shingles that each has in common with any set still in play, under limits on differing
   registers that pairs over the threshold exceed once in about ten million; then steps 3 and 4.

A pair at the threshold shares no band with a probability of about 5e-6. Components come from
repeated contraction of the links; nothing but counts reaches the driver.

Cases: a document without words is linked with nothing; with fewer than five words the whole
sequence is its one shingle. Rows that share a key are one document. A row without a key
is a document of its own that links with nothing: its component is null and it is kept. Keys must be integers. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import blocks, discard, mix64, small_batches, split_words, stored, whole

SHINGLE = 5
THRESHOLD = 75  # percent
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
BASE, RATE, Q = 1.001, 20.0, 2**16 - 2
MARGIN = 0.2  # about five standard deviations of the estimate at the threshold
BITS_APART = 36  # of 128; 16 expected at the threshold, standard deviation 3.7
LEAST_EQUAL = 70  # registers of 128; 96 expected at the threshold, standard deviation 4.9
PARTS = 128  # of the hash space, a power of two
BITMAP = 1 << 26  # bits of the sieve for keys of some pair; a fixed size
_BLOCK = 1_000_000
TEXT_ROWS, SET_ROWS = 1000, 500  # texts, and pairs of sets, that a task holds at once
_DRAW = np.random.default_rng(11)
_MULTIPLY = _DRAW.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _DRAW.integers(0, 2**63, REGISTERS, dtype=np.uint64)
HUB_ROUNDS = 1
_HUB_ORDERS = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x14057B7EF767814F)
_TASK_LINKS = 50_000  # links handled by one task while components contract


# sets ------------------------------------------------------------------------------


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text."""
    codes, distinct, counts = split_words(texts)
    words = np.fromiter(map(word_hash, distinct), np.uint64, len(distinct))[codes]
    n = len(words) - SHINGLE + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(SHINGLE):
        rolled = mix64(rolled ^ words[k : k + len(rolled)], k)
    out, at = [], 0
    for m in counts:
        if m >= SHINGLE:
            out.append(np.unique(rolled[at : at + m - SHINGLE + 1]))
        elif m:
            one = np.zeros(1, np.uint64)
            for k in range(m):
                one = mix64(one ^ words[at + k : at + k + 1], k)
            out.append(mix64(one, 100 + int(m)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += m
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of non-empty sets, a row a set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    x = mix64(np.concatenate(sets), 50)
    least = np.empty((len(sets), REGISTERS), np.uint64)
    for i in range(REGISTERS):
        v = (x + _ADD[i]) * _MULTIPLY[i]
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        least[:, i] = np.minimum.reduceat(v, starts)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    value = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1.0 - np.log(value) / np.log(BASE)), 0, Q + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of a union."""
    return np.maximum(a, b)


def likely_similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum likelihood of the Jaccard similarity of pairs, given registers and sizes.

    With shares u, v of the sizes, the larger register is on the first side with the
    probability p(u - v J), on the second with p(v - u J); p follows from the base.
    """
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = REGISTERS - above - below
    u = size_a / (size_a + size_b)
    v = 1.0 - u
    top = np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.maximum(x, 1e-12) * (BASE - 1) / BASE) / np.log(BASE)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        first, second = p(u - v * j), p(v - u * j)
        return above * np.log(first) + below * np.log(second) + equal * np.log(np.maximum(1 - first - second, 1e-12))

    low, high = np.zeros(len(u)), top * (1 - 1e-9)  # the likelihood has one maximum
    for _ in range(25):
        left, right = low + (high - low) / 3, high - (high - low) / 3
        rises = log_likelihood(left) < log_likelihood(right)
        low, high = np.where(rises, left, low), np.where(rises, high, right)
    return (low + high) / 2


# candidates ------------------------------------------------------------------------


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Key, set size, digest of the set, registers, and a low bit of each register, of every row."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("__id"), whole(text).alias("__text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text", _BLOCK):
            sets = shingle_sets(block["__text"].tolist())
            filled = [i for i, s in enumerate(sets) if len(s)]
            regs = np.zeros((len(sets), REGISTERS), np.uint16)
            if filled:
                regs[filled] = registers([sets[i] for i in filled])
            bits = np.packbits(regs & 1, axis=1).view(">i8")
            yield pd.DataFrame({
                "__id": block["__id"], "__n": [len(s) for s in sets],
                "__digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "__regs": [r.tobytes() for r in regs], "__s1": bits[:, 0].astype(np.int64), "__s2": bits[:, 1].astype(np.int64),
            })

    return rows.mapInPandas(run, "__id bigint, __n bigint, __digest binary, __regs binary, __s1 bigint, __s2 bigint")


def band_members(reps: DataFrame) -> DataFrame:
    """One row a band of every set."""
    width = 2 * ROWS
    keys = F.array(*[F.xxhash64(F.substring("__regs", F.lit(i * width + 1), F.lit(width)), F.lit(i)) for i in range(BANDS)])
    return reps.select("__node", F.explode(keys).alias("__key"))


def with_hubs(members: DataFrame, turn: int) -> DataFrame:
    """Members with the hub and the size of their group, in groups of two and more.

    The hub comes first in an order that has nothing to do with the size of a key: one order for all groups in the
    first turn, so that a set has few hubs, one for each group later, so that it has many.
    """
    mask = F.lit(_HUB_ORDERS[turn])
    mask = mask if turn == 0 else F.xxhash64("__key", mask)
    groups = members.groupBy("__key").agg(F.min(F.col("__node").bitwiseXOR(mask)).alias("m"), F.count(F.lit(1)).alias("__size"))
    hubs = groups.filter("__size > 1").select("__key", F.col("m").bitwiseXOR(mask).alias("__hub"), "__size")
    return members.join(hubs, "__key")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("__a"), F.greatest(a, b).alias("__b")]


def first_hub_pairs(grouped: DataFrame) -> DataFrame:
    """Each set with the first of its hubs."""
    mask = F.lit(_HUB_ORDERS[0])
    first = grouped.filter("__node != __hub").groupBy("__node").agg(F.min(F.col("__hub").bitwiseXOR(mask)).bitwiseXOR(mask).alias("__hub"))
    return first.select(*_pair("__node", "__hub")).distinct()


def _labelled(grouped: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the component of their own and of their hub."""
    own = labels.withColumnRenamed("__label", "__own")
    hub = labels.select(F.col("__node").alias("__hub"), F.col("__label").alias("__hub_label"))
    return grouped.join(own, "__node", "left").join(hub, "__hub", "left").withColumns({
        "__own": F.coalesce("__own", "__node"), "__hub_label": F.coalesce("__hub_label", "__hub")})


def other_hub_pairs(grouped: DataFrame, labels: DataFrame) -> DataFrame:
    """Sets with the hubs whose component they are not in."""
    return _labelled(grouped, labels).filter("__own != __hub_label").select(*_pair("__node", "__hub")).distinct()


def likely_pairs(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose sizes allow the threshold and whose estimate is not clearly below it."""
    side = lambda c: reps.select(F.col("__node").alias(f"__{c}"), F.col("__n").alias(f"__n_{c}"), F.col("__regs").alias(f"__r_{c}"))
    rows = pairs.join(side("a"), "__a").join(side("b"), "__b").filter(
        100 * F.least("__n_a", "__n_b") >= THRESHOLD * F.greatest("__n_a", "__n_b"))
    floor = THRESHOLD / 100 - MARGIN

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            table = lambda c: np.frombuffer(b"".join(batch[c]), np.uint16).reshape(len(batch), REGISTERS)
            j = likely_similarity(table("__r_a"), table("__r_b"), batch["__n_a"].to_numpy(float), batch["__n_b"].to_numpy(float))
            yield batch.loc[j >= floor, ["__a", "__b"]]

    return rows.mapInPandas(run, "__a bigint, __b bigint").distinct()


def bitmap(places: DataFrame) -> np.ndarray:
    """Bits at the places ``p``, counted from 1; built in pieces of 4 KB."""
    pieces = places.groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros(BITMAP // 8, np.uint8)
    for r in pieces.collect():  # at most BITMAP bits
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["b"] - 1) * len(bits) : r["b"] * len(bits)] = bits
    return out


def full_sets(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``__id, __set`` of the documents whose key is among ``__id`` of ``wanted``, and of some others.

    Texts stay where they are; a sieve of fixed size passes the wanted ones.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP)) + 1
    rows = docs.select(F.col(doc_id).cast("bigint").alias("__id"), whole(text).alias("__text"), place(F.col(doc_id).cast("bigint")).alias("__p"))
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(place("__id").alias("p"))))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = batch["__p"].to_numpy(np.int64) - 1
            passed = batch[(sent.value[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)]
            for block in blocks(iter([passed]), "__text"):
                yield pd.DataFrame({"__id": block["__id"], "__set": [s.tobytes() for s in shingle_sets(block["__text"].tolist())]})

    with small_batches(docs.sparkSession, TEXT_ROWS):
        out = stored(rows.filter(F.col("__id").isNotNull()).mapInPandas(sets, "__id bigint, __set binary"), "sets")
    sent.unpersist()
    return out


def shared_parts(nodes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``__node, __parts``: how many shingles of each part of the hash space a set has in common with any other of these sets.

    Two sets share at most the sum of the lesser counts. Counts of shingles combine before they move.
    """
    found = full_sets(nodes.withColumnRenamed("__node", "__id"), docs, doc_id, text)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            each = [np.frombuffer(s, np.int64) for s in batch["__set"]]
            if each:
                yield pd.DataFrame({"__node": np.repeat(batch["__id"].to_numpy(np.int64), [len(s) for s in each]), "__e": np.concatenate(each)})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for s, alone in zip(batch["__set"], batch["__alone"]):
                each = np.frombuffer(s, np.int64)
                shared = each if alone is None else np.setdiff1d(each, np.asarray(alone, np.int64), assume_unique=True)
                parts.append(np.bincount(mix64(shared.view(np.uint64), 7).astype(np.int64) & (PARTS - 1), minlength=PARTS).astype(np.int32))
            yield pd.DataFrame({"__node": batch["__id"], "__parts": parts})

    wanted = found.join(nodes.withColumnRenamed("__node", "__id"), "__id", "left_semi")
    single = wanted.mapInPandas(spread, "__node bigint, __e bigint").groupBy("__e").agg(
        F.count(F.lit(1)).alias("n"), F.min("__node").alias("__id")).filter("n = 1")
    alone = single.groupBy("__id").agg(F.collect_list("__e").alias("__alone"))  # no more than the set holds
    with small_batches(docs.sparkSession, SET_ROWS):
        out = stored(wanted.join(alone, "__id", "left").mapInPandas(count, "__node bigint, __parts array<int>"), "parts")
    discard(found)
    return out


def confirmed(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    found = full_sets(pairs.select(F.explode(F.array("__a", "__b")).alias("__id")), docs, doc_id, text)
    side = lambda c: found.select(F.col("__id").alias(f"__{c}"), F.col("__set").alias(f"__set_{c}"))
    both = pairs.join(side("a"), "__a").join(side("b"), "__b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = np.zeros(len(batch), bool)
            for i, (a, b) in enumerate(zip(batch["__set_a"], batch["__set_b"])):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                if 100 * min(len(x), len(y)) >= THRESHOLD * max(len(x), len(y)):
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    linked[i] = 100 * same >= THRESHOLD * (len(x) + len(y) - same)
            yield batch.loc[linked, ["__a", "__b"]]

    with small_batches(docs.sparkSession, SET_ROWS):
        out = stored(both.mapInPandas(check, "__a bigint, __b bigint").distinct(), "confirmed")
    discard(found)
    return out


# components ------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """``__node, __label`` of every linked node; the label is the least node of its component.

    Each round, a node takes the name of its first neighbour in a random order, and
    the links are carried over to the new names, until none is left.
    """
    links = stored(links.select("__a", "__b"), "links")
    most = max(1, -(-links.count() // _TASK_LINKS))
    nodes = links.select(F.explode(F.array("__a", "__b")).alias("__node")).distinct()
    labels, draw = nodes.withColumn("__label", F.col("__node")), np.random.default_rng(5)
    while n := links.count():
        width = -(-n // _TASK_LINKS)  # a few links need no more than a few files
        order = F.lit(int(draw.integers(0, 2**62)))
        both = links.unionByName(links.select(F.col("__b").alias("__a"), F.col("__a").alias("__b")))
        done = [links, labels]
        names = stored(both.groupBy("__a").agg(F.min(F.col("__b").bitwiseXOR(order)).alias("m")).select(
            "__a", F.least(F.col("m"), F.col("__a").bitwiseXOR(order)).bitwiseXOR(order).alias("__to")).coalesce(2 * width), "names")
        labels = stored(labels.join(names.select(F.col("__a").alias("__label"), "__to"), "__label", "left").select(
            "__node", F.coalesce("__to", "__label").alias("__label")).coalesce(4 * most), "labels")
        moved = links.join(names.withColumnRenamed("__to", "__x"), "__a").select(F.col("__x").alias("__x"), "__b").join(
            names.select(F.col("__a").alias("__b"), F.col("__to").alias("__y")), "__b")
        links = stored(moved.filter("__x != __y").select(*[c.alias(n) for c, n in zip(
            (F.least("__x", "__y"), F.greatest("__x", "__y")), ("__a", "__b"))]).distinct().coalesce(width), "links")
        discard(names, *done)
    least = labels.groupBy("__label").agg(F.min("__node").alias("__least"))
    out = stored(labels.join(least, "__label").select("__node", F.col("__least").alias("__label")).coalesce(4 * most), "components")
    discard(links, labels)
    return out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    with small_batches(docs.sparkSession, TEXT_ROWS):
        rows = stored(sketches(docs, doc_id, text), "sketches")
    filled = rows.filter((F.col("__n") > 0) & F.col("__id").isNotNull())
    classes = filled.groupBy("__digest").agg(F.min("__id").alias("__node"))
    reps = stored(filled.join(classes, "__digest").filter(F.col("__id") == F.col("__node")).select(
        "__node", "__digest", "__n", "__regs", "__s1", "__s2").dropDuplicates(["__node", "__digest"]), "classes")

    members = band_members(reps)
    shared = members.groupBy("__key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__key")
    members = stored(members.join(shared, "__key", "left_semi"), "members")

    links = stored(shared_keys(filled), "links")
    tried, labels, turn = [], None, 0
    while turn <= HUB_ROUNDS + 1:
        grouped = with_hubs(members, min(turn, HUB_ROUNDS))
        if turn == 0:
            pairs = first_hub_pairs(grouped)
        elif turn <= HUB_ROUNDS:
            pairs = other_hub_pairs(grouped, labels)
        else:
            pairs = remaining_pairs(reps, grouped, labels, lambda nodes: shared_parts(nodes, docs, doc_id, text))
        for before in tried:
            pairs = pairs.join(before, ["__a", "__b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried.append(pairs)
        likely = stored(likely_pairs(pairs, reps), "likely")
        if labels is None or not likely.isEmpty():
            more = confirmed(likely, docs, doc_id, text)
            old = (links, labels)
            links = stored(links.unionByName(more).distinct(), "links")
            labels = components(links)
            discard(more, *[x for x in old if x is not None])
        discard(likely)
        turn += 1
    discard(reps, members, links, *tried)

    named = classes.join(labels, "__node", "left").select("__digest", F.coalesce("__label", "__node").alias("__label"))
    own = filled.select("__id", "__digest").distinct().join(named, "__digest").groupBy("__id").agg(F.min("__label").alias("__label"))
    out = rows.select("__id", "__n").join(own, "__id", "left")
    component = F.coalesce("__label", "__id")
    return out.select(F.col("__id").alias(doc_id), F.col("__n").alias("n_shingles"), component.alias("component_id"),
                      F.col("__id").eqNullSafe(component).alias("kept"))


def remaining_pairs(reps: DataFrame, grouped: DataFrame, labels: DataFrame, parts_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs of a group that neither met through the hub nor share a component, if their registers are close enough."""
    members = _labelled(grouped.filter("__size > 2"), labels).withColumn("__open", F.col("__own") != F.col("__hub_label"))
    groups = members.filter("__open").select("__key").distinct()
    # what the conditions look at: band keys in order, registers, their low bits, the size of the set
    width = 2 * ROWS
    bands = F.array(*[F.xxhash64(F.substring("__regs", F.lit(i * width + 1), F.lit(width)), F.lit(i)) for i in range(BANDS)])
    regs = F.array(*[F.substring("__regs", F.lit(2 * i + 1), F.lit(2)) for i in range(REGISTERS)])
    facts = reps.select("__node", "__n", "__s1", "__s2", bands.alias("__bands"), regs.alias("__each"))
    members = stored(members.filter(F.col("__node") != F.col("__hub")).join(groups, "__key", "left_semi").select(
        "__key", "__node", "__own", "__open"), "open")
    total = lambda counts: F.aggregate(counts, F.lit(0), lambda a, b: a + b)
    facts = facts.join(parts_of(members.select("__node").distinct()), "__node").withColumn("__common", total(F.col("__parts")))
    members = members.join(facts, "__node")
    alone = members.filter("__open").select(*[F.col(c).alias(f"{c}_x") for c in members.columns if c != "__open"])
    apart = F.bit_count(F.col("__s1").bitwiseXOR(F.col("__s1_x"))) + F.bit_count(F.col("__s2").bitwiseXOR(F.col("__s2_x")))
    same = lambda a, b: F.zip_with(a, b, lambda x, y: x == y)
    first_shared = F.element_at("__bands", F.array_position(same("__bands", "__bands_x"), F.lit(True)).cast("int"))
    close = (
        (F.col("__own") != F.col("__own_x"))
        & (~F.col("__open") | (F.col("__node") > F.col("__node_x")))  # open pairs once
        & (100 * F.least("__n", "__n_x") >= THRESHOLD * F.greatest("__n", "__n_x"))
        & ((100 + THRESHOLD) * F.least("__common", "__common_x") >= THRESHOLD * (F.col("__n") + F.col("__n_x")))
        & (apart <= BITS_APART)
        & ((100 + THRESHOLD) * total(F.zip_with("__parts", "__parts_x", lambda x, y: F.least(x, y))) >= THRESHOLD * (F.col("__n") + F.col("__n_x")))
        & (first_shared == F.col("__key"))
        & (F.size(F.filter(same("__each", "__each_x"), lambda x: x)) >= LEAST_EQUAL)
    )
    pairs = alone.join(members, (F.col("__key_x") == F.col("__key")) & close)
    return pairs.select(*_pair("__node", "__node_x")).distinct()


def shared_keys(filled: DataFrame) -> DataFrame:
    """Links between the classes of rows that share a key."""
    classes = filled.groupBy("__digest").agg(F.min("__id").alias("__node"))
    of = filled.select("__id", "__digest").distinct().join(classes, "__digest").select("__id", "__node").distinct()
    least = of.groupBy("__id").agg(F.min("__node").alias("__a"), F.max("__node").alias("__top")).filter("__a < __top")
    return of.join(least, "__id").filter(F.col("__node") > F.col("__a")).select("__a", F.col("__node").alias("__b"))
