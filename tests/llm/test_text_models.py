"""Toxicity, language, weak-label quality, host rules, byte pairs: exact where a rule is exact, held-out accuracy elsewhere."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prepline.llm import bpe, host_rules, lang_id, toxicity, weak_quality
from prepline.llm.features import fit_linear, hashed_ngrams
from tests.conftest import FULL
from tests.llm.conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(docs):
    return [r["text"] for r in docs.orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def full_docs(spark):
    return spark.read.parquet(f"{FULL}/documents.parquet")


# byte pairs ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return bpe.load_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(encoder):
    return tiktoken.Encoding("own", pat_str=encoder.pattern, mergeable_ranks=encoder.ranks, special_tokens={})


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_encodes_as_the_library(encoder, reference, texts):
    odd = ["", "a" * 3000, "ab" * 900, " " * 700 + "z", "x" * 256, "x" * 257, "日本語テキスト 😀 é", "<|endoftext|>", "\n\n \t\r\n"]
    for text, raw in zip(texts + odd, encoder.encode(texts + odd)):
        assert ids(raw) == reference.encode_ordinary(text)
        assert encoder.decode(raw) == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text_round_trips(encoder, reference, some):
    for text, raw in zip(some, encoder.encode(some)):
        assert ids(raw) == reference.encode_ordinary(text) and encoder.decode(raw) == text.encode()


def test_matrix_and_heap_merge_alike(encoder):
    draw = random.Random(3)
    pieces = [bytes(draw.choice(b"etaoinsrhl ") for _ in range(draw.randint(1, 256))) for _ in range(300)]
    assert encoder.encode_pieces(pieces) == [encoder.merge_long(p) for p in pieces]


def test_byte_pairs_of_awkward_rows(awkward, nothing, encoder):
    rows = bpe.round_trip_digests(awkward, encoder).collect()
    assert len(rows) == len(AWKWARD)
    empty = hashlib.sha256(b"").hexdigest()
    assert sum(r["n_tokens"] == 0 and r["ids_sha256"] == empty and r["decoded_sha256"] == empty for r in rows) == 3
    back = bpe.decode_documents(bpe.encode_documents(awkward, encoder), encoder).collect()
    assert sorted(r["text"] for r in back) == sorted(t or "" for _, t, _, _ in AWKWARD)
    assert bpe.round_trip_digests(nothing, encoder).count() == 0


# host rules --------------------------------------------------------------------------


def brute_measures(text):
    found = WORD.findall(text)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    again = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
    covered = {i + k for i, w in enumerate(windows) if w in again for k in range(8)} if again is not None else None
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(found), "word_chars": sum(map(len, found)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered) if covered is not None else None}


def test_measures_by_brute_force(texts):
    some = [t for t in texts if len(t) < 9000] + ["", "\n\n", "a b c d e f g h a b c d e f g h", "x\nx\nx y\n \nx y", "one"]
    table = host_rules.measures(some)
    for text, (_, row) in zip(some, table.iterrows()):
        for name, value in brute_measures(text).items():
            assert row[name] == value, (name, text[:80])


def test_host_rates_are_shrunk(spark):
    rows = [(i, h, "good words all the way down here " * 9 if i % 10 >= bad else "#$% " * 40)
            for h, n, bad in (("large", 300, 8), ("small", 2, 10), ("fine", 300, 0), ("fair", 200, 1)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    rates = {r["__host"]: r for r in host_rules.host_rates(host_rules.measure(docs)).collect()}
    assert rates["large"]["rate_symbols"] == pytest.approx(0.8, abs=0.05)
    assert rates["small"]["rate_symbols"] < rates["small"]["f_symbols"] / rates["small"]["n"]  # drawn to the others
    assert rates["fine"]["rate_symbols"] < 0.1


def test_distrusted_hosts_are_held_to_the_strict_limit(spark):
    mild = "plain words in a row that carry some | | signs " * 8  # between both limits of the symbol rule
    mild = " ".join(f"{w}{i}" for i, w in enumerate(mild.split()))
    junk = " ".join(f"w{i}### ###" for i in range(60))
    rows = [(i, "bad", junk) for i in range(60)] + [(100, "bad", mild), (101, "good", mild)]
    rows += [(200 + i, "good", " ".join(f"ok{i}x{k}" for k in range(40))) for i in range(60)]
    found = {r["doc_id"]: r for r in host_rules.judged(spark.createDataFrame(rows, "doc_id bigint, source string, text string")).collect()}
    assert "symbols" in found[100]["distrusted"] and found[101]["distrusted"] == []
    assert not found[100]["kept"] and found[101]["kept"] and not found[0]["kept"] and found[200]["kept"]


def test_host_rules_of_awkward_rows(awkward, nothing):
    rows = host_rules.judged(awkward).collect()
    assert len(rows) == len(AWKWARD) and not any(r["kept"] for r in rows if r["base_failed"])
    assert host_rules.judged(nothing).count() == 0


# languages ---------------------------------------------------------------------------


def test_languages_of_held_out_texts(full_docs):
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = lang_id.fit_languages(full_docs.filter(~held))
    found = lang_id.identify(full_docs, model).join(full_docs.select("doc_id", "lang"), "doc_id").filter(held).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) / len(found) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_awkward_rows(awkward, nothing, docs):
    model = lang_id.fit_languages(docs)
    rows = lang_id.identify(awkward, model).collect()
    assert len(rows) == len(AWKWARD)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4, 6)} == {"und"}
    assert lang_id.identify(nothing, model).count() == 0
    assert lang_id.fit_languages(nothing) is None
    assert {r["lang_pred"] for r in lang_id.identify(docs, None).collect()} == {"und"}


def test_ngrams_of_a_text_do_not_depend_on_its_neighbours(texts):
    raw = [t.encode() for t in texts[:20]]
    together = hashed_ngrams(raw, 512)
    assert all(np.allclose(together[i], hashed_ngrams([r], 512)[0]) for i, r in enumerate(raw))


def test_linear_fit_separates():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 6)).astype(np.float32)
    y = (x @ np.arange(6) > 0.3).astype(float)
    w = fit_linear(x, y, "logistic", rounds=400)
    assert ((x @ w[:-1] + w[-1] > 0) == y.astype(bool)).mean() > 0.95


# quality -------------------------------------------------------------------------------


def test_quality_against_labels_it_never_saw(spark, full_docs):
    scored = weak_quality.classify(full_docs, weak_quality.fit_quality(full_docs))
    rows = scored.join(spark.read.parquet(f"{FULL}/labels.parquet"), "doc_id").collect()
    good, bad = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.15


def test_expectation_maximisation_recovers_accuracies():
    draw = np.random.default_rng(2)
    good = draw.random(20_000) < 0.8
    right = np.linspace(0.75, 0.97, len(weak_quality.LABELLERS))
    votes = np.where(draw.random((len(good), len(right))) < right, 1, -1) * np.where(good, 1, -1)[:, None]
    votes[draw.random(votes.shape) < 0.2] = 0
    patterns, counts = np.unique(votes.astype(np.int8), axis=0, return_counts=True)
    model = weak_quality.fit_votes(patterns, counts.astype(float))
    assert model.good_share == pytest.approx(0.8, abs=0.03)
    assert np.allclose(list(model.accuracies().values()), right, atol=0.03)


def test_quality_of_awkward_rows(awkward, nothing):
    scorer = weak_quality.fit_quality(awkward)
    assert weak_quality.classify(awkward, scorer).count() == len(AWKWARD)
    assert weak_quality.classify(nothing, weak_quality.fit_quality(nothing)).count() == 0


# toxicity ------------------------------------------------------------------------------


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(4)
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = toxicity.Words.of([b"alpha", b"be", b"c", b"delta"])
    codes = draw.integers(0, 4, (5, toxicity.WINDOW))
    real = np.arange(toxicity.WINDOW) < np.array([32, 3, 1, 20, 9])[:, None]
    label, weight = np.array([1, 0, 1, 0, 1.0]), np.ones(5)

    def loss():
        logit = net.run(codes, real, net.projections(net.word_inputs(words)))
        return float((np.log1p(np.exp(-np.abs(logit))) + np.maximum(logit, 0) - label * logit).sum())

    found = net.gradients(codes, real, words, label, weight)
    for name in ("out", "att", "att_v", "f_h", "b_h", "f_x", "b_b"):
        flat = net.p[name].reshape(-1)
        at = int(draw.integers(len(flat)))
        old, step = flat[at], 1e-2
        flat[at] = old + step
        up = loss()
        flat[at] = old - step
        down = loss()
        flat[at] = old
        assert found[name].reshape(-1)[at] == pytest.approx((up - down) / (2 * step), abs=2e-2, rel=5e-2)


def test_windows_cover_every_word():
    counts = np.array([0, 1, 31, 32, 33, 48, 49, 200])
    owner, begin, size = toxicity.windows(counts)
    start = np.cumsum(counts) - counts
    for i, n in enumerate(counts):
        mine = [(b - start[i], s) for o, b, s in zip(owner, begin, size) if o == i]
        assert set().union(*(range(b, b + s) for b, s in mine)) == set(range(n)) if mine else n == 0
        assert all(0 < s <= toxicity.WINDOW for _, s in mine)


def test_planted_insults_are_found(spark):
    draw = random.Random(5)
    plain = ["".join(draw.choice("abcdeilmnorst") for _ in range(draw.randint(2, 8))) for _ in range(400)]

    def text(toxic):
        found = [draw.choice(plain) for _ in range(draw.randint(5, 150))]
        for _ in range(3 if toxic else 0):
            found.insert(draw.randrange(len(found)), "vuqu" + draw.choice(("", "ta", "zo", "ment", "x")))
        return " ".join(found)

    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(600)]
    net = toxicity.train([t for _, t, _ in rows[:400]], np.array([y for _, _, y in rows[:400]]))
    docs = spark.createDataFrame(rows[400:], "doc_id bigint, text string, toxic int")
    found = toxicity.score_toxicity(docs, net).join(docs, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in found) / len(found) > 0.95


def test_toxicity_of_awkward_rows(awkward, nothing):
    net = toxicity.Network()
    rows = toxicity.score_toxicity(awkward, net).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0.0}
    assert toxicity.score_toxicity(nothing, net).count() == 0
    assert toxicity.fit_toxicity(awkward.withColumn("toxic", F.lit(1))) is None
    assert {r["score"] for r in toxicity.score_toxicity(awkward, None).collect()} == {0.0}


def test_one_score_a_text_whatever_its_block(texts):
    net = toxicity.Network()
    together, alone = net.score(texts[:30]), [net.score([t])[0] for t in texts[:30]]
    assert np.allclose(together, alone, atol=1e-5)
    assert zlib.crc32(b"x") == 2363233923  # words are hashed alike on every machine
