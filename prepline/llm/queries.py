"""Each text operator applied to the whole of its table, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from prepline.llm import (
    bpe, centroids, fingerprints, host_rules, lang_id, lm, mixing, near_dedup, resample, sharding, token_counts, toxicity, weak_quality,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def remainder(of: int) -> Column:
    """The part of a document in a split by its key."""
    return F.crc32(F.col("doc_id").cast("string")) % of


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query
def op1_toxicity(spark, folder):
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    net = toxicity.fit_toxicity(docs.filter(remainder(5) != 0).select("doc_id", "text").join(labels, "doc_id"))
    scored = toxicity.score_toxicity(docs, net)
    return scored.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op2_bpe(spark, folder):
    encoder = bpe.load_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip_digests(documents(spark, folder), encoder)


@query
def op3_lm(spark, folder):
    training = F.coalesce(remainder(7) != 2, F.lit(True))
    scored = lm.score_texts(documents(spark, folder), training)
    return scored.select("doc_id", (~training).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op4_quality(spark, folder):
    docs = documents(spark, folder)
    return weak_quality.classify(docs, weak_quality.fit_quality(docs))


@query
def op5_host_rules(spark, folder):
    return host_rules.judged(documents(spark, folder)).withColumn("distrusted", F.array_join("distrusted", ","))


def _host_rules_sql() -> str:
    gap = r"[\x20\x09-\x0D]"
    fails = {"base": "base_failed", **{r: f"100 * {a} > {soft} * {b}" for r, (a, b, soft, _) in host_rules.SOFT_RULES.items()}}
    sums = ", ".join(f"sum(({c})::INT)::BIGINT AS f_{r}" for r, c in fails.items())
    moments = ", ".join(f"avg(f_{r}::DOUBLE / n) AS m_{r}, var_pop(f_{r}::DOUBLE / n) AS v_{r}" for r in fails)

    def rate(r: str) -> str:
        spread = f"(m_{r} * (1 - m_{r}))"
        excess = f"(v_{r} - {spread} * inv)"
        weight = (f"CASE WHEN {excess} > 0 AND ({spread} - v_{r}) / {excess} > 0 THEN ({spread} - v_{r}) / {excess}"
                  f" ELSE {host_rules.PRIOR_WEIGHT} END")
        return f"(f_{r} + m_{r} * ({weight})) / (n + ({weight})) > {host_rules.MAX_HOST_RATE}"

    bad = ", ".join(f"({rate(r)}) AS bad_{r}" for r in fails)
    names = "concat_ws(',', " + ", ".join(f"CASE WHEN bad_{r} THEN '{r}' END" for r in fails) + ")"
    broken = " OR ".join(
        f"100 * {a} > (CASE WHEN bad_{r} OR bad_base THEN {hard} ELSE {soft} END) * {b}" for r, (a, b, soft, hard) in host_rules.SOFT_RULES.items())
    return rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
             generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM t),
g AS (SELECT doc_id, i, count(*) OVER p AS k, string_agg(word, ' ') OVER p AS win
      FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
a AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS often FROM g WHERE k = 8),
c AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM a, range(0, 8) r(o) WHERE often > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT t.doc_id, t.source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
             length(regexp_replace(text, '{gap}', '', 'g')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
      FROM t LEFT JOIN c USING (doc_id) LEFT JOIN d USING (doc_id)),
b AS (SELECT *, n_words < {host_rules.MIN_WORDS} OR 100 * n_repeat_words > {host_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, {sums} FROM b GROUP BY source),
o AS (SELECT avg(1.0::DOUBLE / n) AS inv, {moments} FROM h),
v AS (SELECT source, {bad} FROM h, o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {names} AS distrusted,
       NOT base_failed AND NOT ({broken}) AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source"""


ORACLES["op5_host_rules"] = _host_rules_sql()


@query
def op6_near_dedup(spark, folder):
    return near_dedup.near_duplicates(documents(spark, folder))


# Every two sets that share a shingle are compared, and links are followed from every document.
ORACLES["op6_near_dedup"] = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {near_dedup.THRESHOLD} * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(c) AS component_id, r.doc_id = min(c) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""


@query
def op7_language(spark, folder):
    docs = documents(spark, folder)
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    found = lang_id.identify(docs, lang_id.fit_languages(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op8_sharding(spark, folder):
    rows = sharding.shard_rows(documents(spark, folder))
    return rows.select(F.col("__id").alias("doc_id"), F.col("__bytes").alias("n_bytes"), "shard", "depth", "shard_bytes", "shard_docs")


ORACLES["op8_sharding"] = rf"""
WITH d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes,
         ('0x' || substr(md5(concat_ws('|', doc_id::VARCHAR, text)), 1, 15))::BIGINT AS bits
  FROM documents),
l AS (SELECT doc_id, n_bytes, depth, bits >> (60 - depth) AS p FROM d, (SELECT unnest(range(0, 61)) AS depth)),
s AS (SELECT depth, p, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs FROM l GROUP BY ALL),
f AS (
  SELECT doc_id, n_bytes, depth, p, shard_bytes, shard_docs,
         row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS i
  FROM l JOIN s USING (depth, p) WHERE shard_bytes <= {sharding.MAX_BYTES} OR shard_docs = 1)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(p), depth::INT, '0') END AS shard,
       depth, shard_bytes, shard_docs
FROM f WHERE i = 1"""


@query
def op9_mixing(spark, folder):
    rows = mixing.with_copies(documents(spark, folder))
    return rows.select(
        "doc_id", "source", F.col("__mix_n").alias("size"), F.col("__mix_size").alias("source_size"),
        F.col("__mix_target").alias("target"), F.col("__mix_copies").alias("copies"),
        (F.col("__mix_n") * F.col("__mix_copies")).alias("taken"))


ORACLES["op9_mixing"] = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws('|', doc_id::VARCHAR, text)) AS h FROM documents),
u AS (SELECT doc_id, source, size, ('0x' || substr(h, 1, 8))::BIGINT AS a, ('0x' || substr(h, 9, 8))::BIGINT AS b FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size / w AS ratio FROM w),
v AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
           ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r),
g AS (SELECT level FROM v WHERE level <= ratio ORDER BY ratio, level LIMIT 1),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, w * g.level) AS target FROM v, g),
q AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
x AS (
  SELECT u.*, q.source_size, q.target, q.rate, trial,
         floor(rate)::BIGINT + (((a + trial * b) % 4294967296) / 4294967296.0::DOUBLE < rate - floor(rate))::INT AS copies
  FROM u JOIN q ON u.source IS NOT DISTINCT FROM q.source, (SELECT unnest(range(0, {mixing.TRIALS})) AS trial)),
y AS (SELECT source, trial, abs(sum(size * copies) - any_value(target)) AS miss FROM x GROUP BY source, trial),
z AS (SELECT source, arg_min(trial, (miss, trial)) AS trial FROM y GROUP BY source)
SELECT doc_id, x.source, size, source_size, target, copies, size * copies AS taken
FROM x JOIN z ON x.source IS NOT DISTINCT FROM z.source AND x.trial = z.trial"""


@query
def op10_fingerprints(spark, folder):
    return fingerprints.edited_fingerprints(documents(spark, folder))


@query
def op11_token_counts(spark, folder):
    counter = token_counts.load_counter(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return token_counts.count_tokens(documents(spark, folder), counter)


@query
def op12_centroids(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return centroids.cluster_vectors(vectors, centroids.fit_centroids(vectors))


def _centroids_sql() -> str:
    near = """d{i} AS (SELECT rid, c, sum((x - y) * (x - y))::BIGINT AS far FROM v JOIN c{i} USING (pos) GROUP BY rid, c),
a{i} AS (SELECT rid, arg_min(c, (far, c)) AS c, min(far) AS far FROM d{i} GROUP BY rid),"""
    move = """c{j} AS (
  SELECT c, pos, coalesce(m, y) AS y FROM c{i} LEFT JOIN (
    SELECT c, pos, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS m
    FROM a{i} JOIN v USING (rid) GROUP BY c, pos) USING (c, pos)),"""
    last = centroids.ROUNDS
    rounds = "\n".join(near.format(i=i) + (("\n" + move.format(i=i, j=i + 1)) if i < last else "") for i in range(last + 1))
    return f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, embedding) - 1 AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {centroids.DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMS}),
v AS (SELECT rid, unnest(range(0, {centroids.DIMS})) AS pos, floor({centroids.SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM k),
c0 AS (SELECT rid::INT AS c, pos, x AS y FROM v WHERE rid < {centroids.K}),
{rounds}
s AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY pos)) AS h FROM c{last} GROUP BY c),
t AS (SELECT c, sum(far)::BIGINT AS inertia FROM a{last} GROUP BY c)
SELECT vec_id, a{last}.c AS cluster, far AS distance, t.inertia AS cluster_inertia,
       (SELECT sum(far)::BIGINT FROM a{last}) AS inertia, h AS centroid_sha256
FROM a{last} JOIN k USING (rid) JOIN s ON s.c = a{last}.c JOIN t ON t.c = a{last}.c"""


ORACLES["op12_centroids"] = _centroids_sql()


@query
def op13_resample(spark, folder):
    drawn = resample.draw(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return drawn.ranked().select("doc_id", "n_features", "weight", "score", "rank")


# The 256 remainders of the checksum follow from its polynomial; each byte of a word is one step of the reduction.
ORACLES["op13_resample"] = rf"""
WITH tab AS (
  SELECT list(list_reduce(list_prepend(b::BIGINT, range(0, 8)),
              lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END) ORDER BY b) AS z
  FROM range(0, 256) t(b)),
w AS (
  SELECT rowid AS rid, 0 AS side, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM (SELECT row_number() OVER () AS rowid, text FROM documents)
  UNION ALL
  SELECT 0, 1, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
u AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM w)),
b AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
         lambda r, x: xor(r >> 8, z[xor(r, x) % 256 + 1])), 4294967295::BIGINT) % {resample.BUCKETS} AS bucket FROM u, tab),
n AS (SELECT bucket, sum((side = 0)::INT)::BIGINT AS s, sum(side)::BIGINT AS t FROM w JOIN b USING (word) GROUP BY bucket),
a AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM n),
g AS (SELECT bucket, floor(1000 * ln(((t + 1.0::DOUBLE) * (s_all + {resample.BUCKETS})) / ((s + 1.0::DOUBLE) * (t_all + {resample.BUCKETS}))))::BIGINT AS gain FROM n, a),
d AS (SELECT rid, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM w JOIN b USING (word) JOIN g USING (bucket) WHERE side = 0 GROUP BY rid),
q AS (
  SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         ('0x' || substr(sha256('{resample.SALT}' || doc_id::VARCHAR), 1, 8))::BIGINT AS h
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) LEFT JOIN d USING (rid)),
k AS (SELECT *, weight + floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM q),
r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS i, count(*) OVER () AS n
  FROM k WHERE n_features >= {resample.LEAST_WORDS})
SELECT k.doc_id, n_features, weight, score, CASE WHEN i <= {resample.PERCENT} * n // 100 THEN i END AS rank
FROM k LEFT JOIN r ON r.doc_id = k.doc_id"""


@query
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)
