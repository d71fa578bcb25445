"""From raw documents to token digests of a deduplicated, mixed corpus.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept, and
returns a frame that ``run`` writes as Parquet and reads again for the next. All but the
last return the columns of documents. ``ORACLE_SQL`` is None: SQL can express neither the
trained classifier nor the byte-pair merges; tests compare the stages with plain versions.

Cases: where keys are missing or repeat, rows are told apart by a 64-bit hash of key, text and
source, so a verdict never passes to another row of the same key, and a missing key is a key like any other. Of the rows of one group of
near-duplicates the one with the smallest key stays (a missing key comes last, then the smaller hash), and of rows
equal in key, text and source the first by their other columns. A missing or empty text fails the rules. An empty
table gives an empty result. Extra columns pass through all stages but the last, whatever their names, save ``__row``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepline.llm import bpe, host_rules, mixing, near_dedup, weak_quality
from prepline.llm.text import discard, stored

ORACLE_SQL = None


ROW = "__row"


def with_row(docs: DataFrame) -> DataFrame:
    """Rows with a whole number that names them: their key where all keys are there and differ, else a hash."""
    unsafe = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("doc_id IS NULL OR n > 1")
    hashed = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull(), "source")
    return docs.withColumn(ROW, F.col("doc_id").cast("bigint") if unsafe.isEmpty() else hashed)


def keep(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows that have the verdict kept."""
    return rows.join(verdicts.filter("kept").select(ROW).distinct(), ROW, "left_semi").drop(ROW)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = with_row(docs)
    return keep(rows, host_rules.judged(rows, doc_id=ROW))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = with_row(docs)
    return keep(rows, weak_quality.classify(rows, weak_quality.fit_quality(rows, doc_id=ROW), doc_id=ROW))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = with_row(docs)
    found = near_dedup.near_duplicates(rows, doc_id=ROW).select(ROW, "component_id")
    keys = rows.select(ROW, "doc_id").distinct().join(found.distinct(), ROW)
    first = keys.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col(ROW).alias("c"))).alias("m"))
    kept = rows.join(first.select(F.col("m.c").alias(ROW)), ROW, "left_semi")
    if found.groupBy(ROW).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return kept.drop(ROW)
    one = kept.groupBy(ROW).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("m"))  # of equal rows
    return one.select("m.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoder = bpe.load_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip_digests(docs, encoder)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("byte-pair encoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"stage-{i}")
        discard(before)
    return docs
