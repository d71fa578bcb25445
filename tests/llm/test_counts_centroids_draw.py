"""Token counts, centroid clustering and resampling against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from prepline.llm import centroids, resample, token_counts
from prepline.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# token counts --------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    return token_counts.load_counter(VOCABULARY, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_whole_table_as_the_library_counts(spark, folder, docs, library):
    found = {r["doc_id"]: r for r in QUERIES["op11_token_counts"](spark, folder).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(found) == set(texts)
    for key, text in texts.items():
        n, r = len(ids(library, text)), found[key]
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((text or "").encode()), n > 1024)


def test_strings_with_the_proof_are_one_token(counter, library):
    alone = sorted(counter.alone)
    found = [len(library.model.tokenize(t)) for t in library_strings(alone)]
    assert set(found) == {1} and len(alone) > 45_000


def library_strings(texts):
    shown = token_counts.byte_characters()
    return ["".join(shown[b] for b in t.encode()) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab  '\n\t #12é日😀٣", chr(0x558), chr(0x88F), chr(0x1C89), chr(0x3FC36), chr(0), "<|endoftext|>", "'s", " the"])))
def test_odd_texts_as_the_library_counts(counter, library, parts):
    text = "".join(parts)
    assert counter.count(text)[0] == len(ids(library, text))


def test_special_strings_are_one_token(counter, library):
    text = "one<|endoftext|><|endoftext|> two <|endoftext"
    assert counter.count(text)[0] == len(ids(library, text)) and 50256 in ids(library, text)


def test_counts_of_awkward_rows(counter, library, awkward, nothing):
    rows = token_counts.count_tokens(awkward, counter).collect()
    expected = Counter((k, len((t or "").encode()), len(ids(library, t)), len(ids(library, t)) > 1024) for k, t, *_ in AWKWARD)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == expected
    assert token_counts.count_tokens(nothing, counter).count() == 0


def test_a_very_long_pre_token(counter, library):
    text = "xyab" * 20_000 + " " * 3000
    assert counter.count(text)[0] == len(ids(library, text))


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        token_counts.load_counter(public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.PATTERN)


# centroids -----------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dims=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "~"
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, members in groups.items():
            centres[j] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, d, j in found)


def clusters(rows, k=centroids.K, rounds=centroids.ROUNDS):
    fitted = centroids.fit_centroids(rows, k=k, rounds=rounds)
    return Counter(tuple(r) for r in centroids.cluster_vectors(rows, fitted).collect())


def test_clusters_of_the_whole_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    assert clusters(rows) == plain_clusters([(r["vec_id"], r["embedding"]) for r in rows.collect()], 16, 3)


def test_clusters_of_awkward_vectors(spark):
    rng = np.random.default_rng(5)
    base = [[round(float(x), 3) for x in rng.normal(0, 3, 64)] for _ in range(40)]
    rows = [(i, v) for i, v in enumerate(base)] + [(3, base[3]), (3, base[4]), (None, base[5]), (None, base[6])]
    rows += [(100, None), (101, []), (102, base[0][:63]), (103, [*base[0], 1.0]), (104, [None, *base[0][1:]]),
             (105, [float("nan"), *base[0][1:]]), (106, [float("-inf"), *base[0][1:]])]
    rows += [(200 + i, [0.0] * 64) for i in range(5)]  # equal vectors, which may start several centroids
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"cluster": F.lit("x"), "distance": F.lit("x"), "__id": F.lit(0)})
    assert clusters(frame) == plain_clusters(rows, 16, 3)
    assert clusters(frame.repartition(7), k=60, rounds=2) == plain_clusters(rows, 60, 2)
    assert not clusters(frame.limit(0)) and not clusters(frame.filter("vec_id between 100 and 106"))
    with pytest.raises(Exception, match="exactly"):
        clusters(spark.createDataFrame([(1, [1e9] * 64)], "vec_id bigint, embedding array<double>"))


def test_eliminated_centroids_are_never_nearest():
    rng = np.random.default_rng(7)
    centres = rng.integers(-40, 40, (16, 64))
    centres[9] = centres[4]
    vectors = np.concatenate([centres, centres + rng.integers(-1, 2, (16, 64)), rng.integers(-300, 300, (500, 64))])
    number, far = centroids.nearest(centroids.transform(vectors), centroids.transform(centres))
    every = ((vectors[:, None] - centres) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()


def test_the_transform_keeps_distances():
    v = np.random.default_rng(3).integers(-100, 100, (20, 64))
    assert ((centroids.transform(v) ** 2).sum(axis=1) == 64 * (v**2).sum(axis=1)).all()
    assert (centroids.transform(v)[:, 0] == v.sum(axis=1)).all()  # the coarsest coefficient
    with pytest.raises(ValueError):
        centroids.sequency(48)


# resampling ----------------------------------------------------------------------

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def plain_draw(rows, target, longest=1, percent=10, least=20):
    def features(text):
        w = _WORD.findall((text or "").translate(_LOWER))
        return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    def buckets(text):
        return [zlib.crc32(f.encode()) % 10_000 for f in features(text)[1]]

    s, t = Counter(b for _, x in rows for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    out = []
    for key, text in rows:
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        found = buckets(text)
        weight = sum(gain[b] for b in found)
        out.append((key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(features(text)[0])))
    ranked = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return out, ranked[: percent * len(ranked) // 100]


def check_draw(docs, target, **options):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    everything, drawn = plain_draw(rows, [r["text"] for r in target.collect()], **options)
    found = resample.draw(docs, target, longest=options.get("longest", 1), percent=options.get("percent", 10),
                          least_words=options.get("least", 20), chunk=50).ranked().collect()
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in found) == Counter(r[:4] for r in everything)
    assert sorted((r["rank"], r["doc_id"], r["score"]) for r in found if r["rank"]) == [(i + 1, r[0], r[3]) for i, r in enumerate(drawn)]


@pytest.mark.parametrize("options", [{}, {"percent": 50, "longest": 2}, {"percent": 100, "least": 0}])
def test_draw_of_the_whole_table(spark, folder, docs, options):
    check_draw(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), **options)


def test_draw_of_awkward_rows(spark, awkward, nothing):
    target = awkward.filter("doc_id = 1")
    for options in ({"percent": 50, "least": 1}, {"percent": 40, "least": 0}, {"percent": 100, "least": 0}, {"percent": 1, "least": 0}):
        check_draw(awkward, target, **options)
    check_draw(awkward, nothing, percent=50, least=0)
    assert resample.draw(nothing, target).ranked().count() == 0 and resample.resample(nothing, target).count() == 0
    drawn = resample.resample(awkward, target, percent=60, least_words=0)
    assert drawn.columns == awkward.columns and drawn.count() == 60 * len(AWKWARD) // 100


def test_equal_rows_fill_the_room_that_is_left(spark):
    docs = spark.createDataFrame([(1, "same words " * 12)] * 50 + [(2, "others here " * 12)] * 3, "doc_id bigint, text string")
    found = resample.draw(docs, docs, percent=50, chunk=7).ranked().collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 27))
    assert resample.resample(docs, docs, percent=50).count() == 26


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_the_cutoff_is_exact_for_every_count(spark, chunk):
    keys = [(s, 0, i, 0) for i, s in enumerate([5, 5, 5, -2, 7, 7, 0, 3, 3, 9])]
    table = spark.createDataFrame(keys, "score bigint, __no_id int, __id bigint, __hash bigint").repartition(3)
    ordered = sorted(keys, key=lambda k: (-k[0], k[2]))
    for count in (1, 4, 7, 10):
        assert resample.find_cutoff(table, count, chunk) == resample.Cutoff(ordered[count - 1], count - 1)


def test_drawn_rows_lean_to_the_target(spark, folder, docs):
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = resample.draw(docs, target)
    rows = found.ranked().filter("n_words >= 20").withColumn("mean", F.col("weight") / F.col("n_features"))
    drawn = rows.groupBy(F.col("rank").isNotNull().alias("in")).agg(F.avg("mean").alias("m")).collect()
    mean = {r["in"]: r["m"] for r in drawn}
    assert mean[True] > mean[False]
