"""Near-duplicates, language model and pipeline against plain versions."""

import math
import pathlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prepline.llm import lm, near_dedup
from prepline.llm.queries import ORACLES, QUERIES
from prepline.session import shared_folder
from tests.compare import connect, differences
from tests.conftest import FULL, SMALL
from tests.llm.conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


# near-duplicates -----------------------------------------------------------------


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(sets):
    """Least key reachable over links, by comparing every two sets that share a shingle."""
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: top(i) for i in sets}


def check_components(docs):
    sets = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    expected = brute_components(sets)
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == len(sets)
    for r in found:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), expected[i], expected[i] == i)


def test_components_of_the_documents(spark):
    check_components(spark.read.parquet(f"{FULL}/documents.parquet"))


def test_components_of_copies_edits_and_chains(spark):
    draw = np.random.default_rng(6)
    word = lambda: "w" + str(draw.integers(0, 50_000))
    rows, key = [], 0
    passage = [word() for _ in range(60)]
    for _ in range(12):
        base = [word() for _ in range(int(draw.integers(40, 200)))]
        text = list(base)
        for _ in range(int(draw.integers(1, 30))):  # copies that drift away, one edit at a time
            rows.append((key, " ".join(text)))
            key += 1
            if draw.random() < 0.6:
                text[int(draw.integers(len(text)))] = word()
    for _ in range(80):  # texts that share a long passage
        rows.append((key, " ".join([word() for _ in range(int(draw.integers(5, 60)))] + passage)))
        key += 1
    for n in range(1, 8):
        rows += [(key, "same few words here now then"[: n * 4]), (key + 1, "SAME few words here now then"[: n * 4])]
        key += 2
    check_components(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_estimate_and_merge():
    draw = np.random.default_rng(8)
    pool = draw.integers(0, 2**63, 6000, dtype=np.uint64)
    a, b = np.sort(pool[:4000]), np.sort(pool[1000:5000])
    regs = near_dedup.registers([a, b, np.union1d(a, b)])
    assert (near_dedup.merged(regs[0], regs[1]) == regs[2]).all()
    tries = [near_dedup.likely_similarity(*[r[None, :] for r in near_dedup.registers([
        np.sort(p[:4000]), np.sort(p[1000:5000])])], np.array([4000.0]), np.array([4000.0]))[0]
        for p in (draw.integers(0, 2**63, 5000, dtype=np.uint64) for _ in range(40))]
    assert np.mean(tries) == pytest.approx(0.6, abs=0.03) and np.std(tries) < 0.07


def test_contraction_finds_components_of_a_long_path(spark):
    links = spark.range(300).select(F.col("id").alias("__a"), (F.col("id") + 1).alias("__b")).union(
        spark.createDataFrame([(1000, 1001)], "a bigint, b bigint"))
    found = {r["__node"]: r["__label"] for r in near_dedup.components(links).collect()}
    assert found == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_near_duplicates_of_awkward_rows(awkward, nothing):
    rows = near_dedup.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 8)} == {1}
    assert all(r["kept"] for r in rows if r["doc_id"] in (None, 2, 3, 4, 5))
    assert near_dedup.near_duplicates(nothing).count() == 0


# language model -------------------------------------------------------------------


def check_model(docs, **options):
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))
    rows = lm.score_texts(docs, train, **options).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    learned = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    counts = Counter(w for i, t in texts if learned(i) for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    expected = sorted((str(i), len(words(t)) + 1, sum(w in counts for w in [*words(t), None]),
                       round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 4)) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in rows) == expected
    assert {r["train_tokens"] for r in rows} == {n}
    return {r["doc_id"]: r for r in rows}


def test_base_is_exact_and_the_model_beats_it(spark):
    found = check_model(spark.read.parquet(f"{FULL}/documents.parquet"))
    held = [r for i, r in found.items() if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_several_passes_score_alike(docs):
    one = check_model(docs)
    many = check_model(docs, limit=20_000)
    assert all(math.isclose(one[i]["score"], many[i]["score"], rel_tol=1e-9) for i in one)


def test_filter_returns_levels_and_seldom_more():
    draw = np.random.default_rng(9)
    names = np.unique(draw.integers(0, 2**32, 4000, dtype=np.uint64)).astype(np.uint32)
    counts = draw.integers(1, 5000, len(names))
    filters = lm.Filters([(0, lm.build_filter([(2, names, counts)]))], 1)
    level, found = lm.level_of(counts), filters.levels(np.zeros(len(names), int), names, 2)
    assert (found >= level).all() and (found > level).mean() < 0.03
    assert (lm.least_of(level)[level > 0] <= counts[level > 0]).all()
    other = np.setdiff1d(draw.integers(0, 2**32, 4000, dtype=np.uint64).astype(np.uint32), names)
    assert (filters.levels(np.zeros(len(other), int), other, 2) > 0).mean() < 0.03


def test_what_was_seen_once_is_told_from_what_was_never_seen(spark):
    counts = np.arange(1, 3000)
    level = lm.level_of(counts)
    assert lm.level_of(np.array([0, 1])).tolist() == [0, 1] and lm.middle_of(np.array([1])) > lm.middle_of(np.array([0]))
    assert ((lm.least_of(level) <= counts) & (counts <= lm.greatest_of(level))).all()
    names = np.unique(np.random.default_rng(3).integers(0, 2**32, 4000, dtype=np.uint64)).astype(np.uint32)
    filters = lm.Filters([(0, lm.build_filter([(2, names, np.ones(len(names), int))]))], 1)
    assert (filters.levels(np.zeros(len(names), int), names, 2) > 0).all()
    # a and b words occur once, d words twice; of the held-out texts, one holds a pair that training holds and one does not
    train = [(i, f"a{i} b{i} c{i} d{i % 40}") for i in range(80)]
    held = [(-1, "a1 b1"), (-2, "a1 b2")]
    docs = spark.createDataFrame(train + held, "doc_id bigint, text string")
    score = {r["doc_id"]: r["score"] for r in lm.score_texts(docs, F.col("doc_id") >= 0).collect()}
    assert score[-1] > score[-2] + 1


def plain_weights(rows, norm):
    """Expectation-maximisation over the tokens of all training texts, a token's own occurrence taken off."""
    seen = Counter()
    for r in rows:
        word, gram = r["__levels"][::2], r["__levels"][1::2]
        seen.update(zip([word[-1], *word], word, gram))  # all texts end alike
    evidence = defaultdict(list)
    levels = dict(enumerate(lm.level_of(np.arange(1, 2000)).tolist(), 1))
    for (before, word, gram), n in seen.items():
        own = [c for c in levels if levels[c] == before]
        for level, share in ((before - 1, min(own) / sum(own)), (before, 1 - min(own) / sum(own))):
            least = min(c for c in levels if levels[c] == gram) - 1
            most = max([c for c in levels if levels[c] == level], default=1)
            evidence[level].append((min(1.0, least / most) if level else 0.0, 1.5 ** (word - 0.5) / norm, n * share))
    out = {}
    for level, terms in evidence.items():
        w = 0.3
        for _ in range(40):
            w = (sum(n * w * b / (w * b + (1 - w) * u) for b, u, n in terms) + 0.3) / (sum(n for *_, n in terms) + 1)
        out[level] = w if level else 0.0
    return out


def test_weights_are_fitted_on_all_training_texts(spark):
    draw = np.random.default_rng(5)
    texts = [(i, " ".join(f"w{min(k, 60)}" for k in draw.geometric(0.04, 3))) for i in range(900)]  # more than a sample of 400
    docs = spark.createDataFrame([*texts, *[(-i, "w1 w2") for i in range(1, 9)]], "doc_id bigint, text string")
    train = (F.col("doc_id") >= 0) & (F.col("doc_id") % 9 != 0)
    counts = lm.count_grams(docs, train)
    levels = lm.with_levels(docs, train, counts, "doc_id", "text")
    rows = levels.collect()
    assert len(rows) == 908 and sum(r["__train"] for r in rows) == 800
    model = lm.tune(levels, counts)
    for level, weight in plain_weights([r for r in rows if r["__train"]], counts.norm).items():
        assert math.isclose(model.weights[level], weight, rel_tol=1e-9)


def test_a_word_held_over_255_times_counts_in_full(spark):
    check_model(spark.createDataFrame([(0, "a " * 1000 + "b"), (1, "a b"), (2, "c " * 255), (3, "c " * 256)], "doc_id bigint, text string"))


def test_language_model_of_awkward_rows(awkward, nothing):
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))
    rows = lm.score_texts(awkward, train).collect()
    assert len(rows) == len(AWKWARD) and all(math.isfinite(r["score"]) for r in rows)
    assert lm.score_texts(nothing, train).count() == 0
    assert {r["train_tokens"] for r in lm.score_texts(awkward, F.lit(False)).collect()} == {0}


def test_scores_equal_a_plain_model(docs):
    """The same counts, levels, weights and sums without filters, given filters so sparse that no probe errs."""
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    found = {r["doc_id"]: r["score"] for r in lm.score_texts(docs, train, per_event=400).collect()}
    texts = {r["doc_id"]: (words(r["text"]) + [None], r["t"]) for r in docs.withColumn("t", train).collect()}
    one, two = Counter(), Counter()
    for w, learned in texts.values():
        if learned:
            one.update(w)
            two.update(zip([None] + w[:-1], w))
    level = lambda n: int(lm.level_of(np.array([n]))[0])
    middle = lambda n: float(lm.middle_of(np.array([level(n)]))[0])
    least, greatest = (lambda k: float(lm.least_of(np.array([k]))[0])), (lambda k: float(lm.greatest_of(np.array([k]))[0]))
    norm = sum(middle(n) for n in one.values()) + 1.0

    def terms(before, word, gram, less=0):
        bigram = min(max(least(gram) - less, 0) / max(greatest(before), 1), 1.0) if before > 0 else 0.0
        return bigram, (lm.STEP ** (word - 0.5) if word > 0 else 1.0) / norm

    seen = Counter()
    for w, learned in texts.values():
        if learned:
            for a, b in zip([None] + w[:-1], w):
                seen[level(one[a]), level(one[b]), level(two[a, b])] += 1
    rows = []
    for (before, word, gram), n in seen.items():
        low, high = least(before), greatest(before)
        falls = 2 * low / ((low + high) * (high - low + 1)) if before > 0 else 0.0
        rows += [(max(before - 1, 0), word, gram, n * falls), (before, word, gram, n * (1 - falls))]
    weights = dict.fromkeys(range(82), 0.3)
    for _ in range(40):
        num, den = Counter(), Counter()
        for before, word, gram, n in rows:
            b, u = terms(before, word, gram, 1)
            share = weights[before] * b
            num[before] += n * share / (share + (1 - weights[before]) * u)
            den[before] += n
        weights = {k: (num[k] + 0.3) / (den[k] + 1.0) for k in weights}
    weights[0] = 0.0
    for key, (w, _) in texts.items():
        total = 0.0
        for a, b in zip([None] + w[:-1], w):
            bigram, unigram = terms(level(one[a]), level(one[b]), level(two[a, b]))
            k = weights[level(one[a])]
            total += math.log10(k * bigram + (1 - k) * unigram)
        assert found[key] == pytest.approx(total, rel=1e-9)


def test_many_passes_leave_no_more_than_one(spark, tmp_path):
    """Levels from filters sent in pieces are those from one piece, and each pass deletes what the one before wrote."""
    docs = spark.read.parquet(f"{FULL}/documents.parquet")
    train = F.col("doc_id") % 7 != 2
    place = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in place.glob("lm-*")}
    whole = {r["doc_id"]: r["score"] for r in lm.score_texts(docs, train).collect()}
    one = {p.name for p in place.glob("lm-*")} - before
    pieces = {r["doc_id"]: r["score"] for r in lm.score_texts(docs, train, limit=60_000).collect()}
    many = {p.name for p in place.glob("lm-*")} - before - one
    assert pieces == pytest.approx(whole, rel=1e-12)
    assert sorted(n.rsplit("-", 1)[0] for n in many) == sorted(n.rsplit("-", 1)[0] for n in one) == ["lm-bases", "lm-levels"]


# pipeline and queries ----------------------------------------------------------------


def test_stages_keep_the_columns_and_their_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{FULL}/documents.parquet")
    before = docs.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found = corpus_pipeline.stored(stage(spark, docs, FULL), f"test-{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert found.columns == docs.columns
            assert 0 < found.count() != before
            if i == 2:
                assert check_components(found) is None and found.count() == near_dedup.near_duplicates(found).filter("kept").count()
        else:
            assert found.count() == before and "ids_sha256" in found.columns
        docs, before = found, found.count()


def test_stages_run_on_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = corpus_pipeline.stored(stage(spark, docs, SMALL), f"awkward-{i}")
        assert docs.columns[0] == "doc_id"


GOOD = ("The river runs past the old mill and the village, where people meet in the evening and talk about the weather. "
        "Some of them walk home along the water, and others stay until the lamps are lit and the last boat comes in.")


def test_verdicts_stay_with_their_row(spark):
    """Rows that share a key, or have none, are judged by their own text; of equal ones a single row stays."""
    other = GOOD.replace("river", "road").replace("boat", "cart").replace("village", "town") + " " + GOOD[::-1]
    rows = [(1, GOOD, "a"), (1, "abc", "a"), (None, GOOD, "a"), (None, "xyz", "a"), (2, other, "a"), (2, other, "a"), (None, other, "a"), (None, other, "a"), (3, None, "a"), (4, "", "a")]
    docs = spark.createDataFrame([(k, t, "en", s, None) for k, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    passed = corpus_pipeline.quality_rules(spark, docs, SMALL)
    assert passed.columns == docs.columns and Counter((r["doc_id"], r["text"]) for r in passed.collect()) == Counter((k, t) for k, t, _ in rows if t and len(t) > 3)
    left = corpus_pipeline.near_duplicates(spark, passed, SMALL)
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(1, GOOD), (2, other)]
    judged = corpus_pipeline.quality_classifier(spark, docs, SMALL).collect()
    assert len({r["text"] for r in judged}) * 2 >= len([r for r in judged if r["text"]]) / 2  # rows of one text share a verdict
    for text in (GOOD, other):
        assert sum(r["text"] == text for r in judged) in (0, sum(t == text for _, t, _ in rows))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
