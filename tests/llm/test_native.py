"""Sharding, mixing and fingerprints: plain versions of the rules, awkward rows, no Python in their plans."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from prepline.llm import fingerprints, mixing, sharding
from tests.llm.conftest import AWKWARD

SPACE = " \t\n\v\f\r"


def words(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain(df):
    text = df._jdf.queryExecution().toString()
    return not any(x in text for x in ("Python", "Pandas", "Arrow", "MapInBatch"))


# sharding ----------------------------------------------------------------------


def test_only_oversized_buckets_split(docs):
    limit = 8000
    rows = sharding.shard_rows(docs, max_bytes=limit).collect()
    assert len(rows) == docs.count()
    shards = defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r)
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))  # no shard inside another
    for name, members in shards.items():
        total = sum(r["__bytes"] for r in members)
        assert {r["shard_bytes"] for r in members} == {total} and {r["depth"] for r in members} == {len(name)}
        assert total <= limit or len(members) == 1
        if name:  # the parent was too large, else it would not have been split
            parent = [r for r in rows if format(r["__bits"], "060b").startswith(name[:-1])]
            assert sum(r["__bytes"] for r in parent) > limit


def test_directory_leads_to_every_shard(docs):
    rows = sharding.shard_rows(docs, max_bytes=8000)
    table = sharding.directory(rows).collect()
    for r in rows.collect():
        (found,) = [d for d in table if d["from_bits"] <= r["__bits"] <= d["to_bits"]]
        assert found["shard"] == r["shard"]


def test_rows_that_no_bit_tells_apart_are_dealt_over_pieces(spark):
    same = spark.createDataFrame([(1, "x" * 100)] * 50 + [(2, "y")], "doc_id bigint, text string")
    rows = sharding.shard_rows(same, max_bytes=1000).collect()
    assert len(rows) == 51
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["__bytes"]
    assert max(sizes.values()) <= 1000


def test_shards_are_written_whole(docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, max_bytes=50_000)
    back = docs.sparkSession.read.option("recursiveFileLookup", "true").parquet(path)
    assert sorted(map(str, back.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))


def test_sharding_of_awkward_rows(awkward, nothing):
    assert sharding.shard_rows(awkward, max_bytes=1000).count() == len(AWKWARD)
    assert sharding.shard_rows(nothing).count() == 0


# mixing --------------------------------------------------------------------------


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Excess over the cap is shared again by weight, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, budget, out = set(order), share * sum(sizes.values()), {}
    while left:
        level = budget / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in left}
        for s in over:
            out[s] = cap * sizes[s]
            budget -= out[s]
        left -= over
    return out


def test_targets_are_the_fixed_point_of_resharing(docs):
    rows = mixing.with_copies(docs).collect()
    sizes = Counter()
    for r in rows:
        assert r["__mix_n"] == len(words(r["text"]))
        sizes[r["source"]] += r["__mix_n"]
    expected = targets(sizes)
    taken = Counter()
    for r in rows:
        assert math.isclose(r["__mix_target"], expected[r["source"]], rel_tol=1e-12) and r["__mix_size"] == sizes[r["source"]]
        rate = r["__mix_target"] / r["__mix_size"]
        assert r["__mix_copies"] in (math.floor(rate), math.ceil(rate)) and r["__mix_copies"] <= 2
        taken[r["source"]] += r["__mix_copies"] * r["__mix_n"]
    largest = Counter()
    for r in rows:
        largest[r["source"]] = max(largest[r["source"]], r["__mix_n"])
    for s, t in expected.items():
        assert abs(taken[s] - t) <= max(largest[s], 0.1 * t)


def test_mixture_repeats_rows_and_reruns_agree(docs):
    first, again = (Counter(r["doc_id"] for r in mixing.mix(d).collect()) for d in (docs, docs.repartition(7)))
    assert first == again
    assert first == Counter({r["doc_id"]: r["__mix_copies"] for r in mixing.with_copies(docs).collect() if r["__mix_copies"]})


def test_mixing_of_awkward_rows(awkward, nothing):
    rows = mixing.with_copies(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(r["size"] == "other" for r in rows)
    assert mixing.mix(awkward).columns == awkward.columns
    assert mixing.mix(nothing).count() == 0


def test_sources_without_words_are_not_taken(spark):
    rows = mixing.with_copies(spark.createDataFrame([(1, "", "a"), (2, "one two", "b")], "doc_id bigint, text string, source string"))
    assert {(r["source"], r["__mix_copies"] > 0) for r in rows.collect()} == {("a", False), ("b", True)}


# fingerprints --------------------------------------------------------------------


def jaccard(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_collisions_estimate_the_weighted_similarity(docs):
    rows = fingerprints.edited_fingerprints(docs, registers=64).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    order = sorted(texts)
    after = dict(zip(order, order[1:] + order[:1]))
    errors = []
    for r in rows:
        text, follower = texts[r["doc_id"]], texts[after[r["doc_id"]]]
        half = len(text) // 2
        edited = text[: len(text) - half] + follower[:half]
        errors += [r["near_edited"] - jaccard(text, edited), r["near_next"] - jaccard(text, follower)]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert len(rows) == len(texts)
    assert abs(sum(errors) / len(errors)) < 0.01
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.06  # sqrt(J (1 - J) / 64) at most


def test_repeated_words_weigh_more(spark):
    rows = spark.createDataFrame([(1, "a " * 30 + "b"), (2, "a " * 10 + "b"), (3, "b")], "doc_id bigint, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint(rows, registers=400).collect()}
    pair = spark.createDataFrame([(prints[1], prints[2], prints[3])], "a string, b string, c string")
    near = pair.select(fingerprints.likeness(F.col("a"), F.col("b"), 400), fingerprints.likeness(F.col("a"), F.col("c"), 400)).first()
    assert near[0] == pytest.approx(11 / 31, abs=0.1) and near[1] == pytest.approx(1 / 31, abs=0.05)


def test_fingerprints_of_awkward_rows(awkward, nothing):
    rows = fingerprints.edited_fingerprints(awkward).collect()
    assert len(rows) == len(AWKWARD)
    by_text = defaultdict(set)
    for r, print_ in ((r, r["fingerprint"]) for r in rows):
        by_text[r["n_chars"]].add(print_)
    assert by_text[0] == {""} and all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in rows)
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (1, 8)}) == 1
    assert fingerprints.edited_fingerprints(nothing).count() == 0
    assert fingerprints.fingerprint(awkward).count() == len(AWKWARD)


def test_the_shipped_number_of_registers_keeps_its_deviation(docs):
    """Means over all pairs agree with the weighted similarity, single ones within five deviations; own prints equal those taken alone."""
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    order = sorted(texts)
    rows = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs).collect()}
    alone = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint(docs).collect()}
    errors = [rows[a]["near_next"] - jaccard(texts[a], texts[b]) for a, b in zip(order, order[1:] + order[:1])]
    assert max(map(abs, errors)) <= 5 * 0.5 / fingerprints.REGISTERS**0.5 and abs(sum(errors) / len(errors)) < 0.02
    assert {k: r["fingerprint"] for k, r in rows.items()} == alone
    assert all(len(p) in (0, 4 * fingerprints.REGISTERS) for p in alone.values())


def test_a_single_document_follows_itself(spark):
    (row,) = fingerprints.edited_fingerprints(spark.createDataFrame([(5, "ab cd ef")], "doc_id bigint, text string")).collect()
    assert row["near_next"] == 1.0


def test_native_plans_hold_no_python(docs):
    assert plain(sharding.shard_rows(docs)) and plain(mixing.mix(docs)) and plain(fingerprints.edited_fingerprints(docs))
