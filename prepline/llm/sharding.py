"""Sharding by extendible hashing.

A document belongs to the bucket of its hash prefix. A bucket over the byte limit
is split on the next bit, and only that one, until every bucket fits; the buckets
that remain are the shards, of different depths. The sizes of all prefixes come
from counts per hash cell, rolled up to every shorter prefix, so documents are
read, not moved. Cells that are still too large are refined from their own
documents alone. No directory passes through the driver.

Cases: a missing text has no bytes; a document above the limit is a shard of its
own; rows equal in key and text share their whole hash and are dealt over numbered
pieces of that bucket once it exceeds the limit; an empty table gives no shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import stored, whole

BITS = 60
MAX_BYTES = 1 << 20
_FINER = 4  # bits by which the first cells are finer than even shards would be
_MORE = 8  # bits added for cells that are too large


def hash_bits(doc_id: str, text: str) -> Column:
    """The leading 60 bits of a digest of key and text."""
    digest = F.md5(F.concat_ws("|", F.col(doc_id).cast("string"), F.col(text)))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def prefix(bits: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", bits, (F.lit(BITS) - depth).cast("int"))


def _leaves(rows: DataFrame, known: int, depth: int, limit: int) -> DataFrame:
    """Cells of ``depth`` bits with the shallowest prefix longer than ``known`` that fits; null depth where none does."""
    cells = rows.groupBy(prefix(F.col("__bits"), depth).alias("__cell")).agg(
        F.sum("__bytes").alias("__b"), F.count(F.lit(1)).alias("__n"))
    levels = cells.withColumn("__d", F.explode(F.sequence(F.lit(known), F.lit(depth)))).withColumn(
        "__p", F.call_function("shiftright", F.col("__cell"), (F.lit(depth) - F.col("__d")).cast("int")))
    sizes = levels.groupBy("__d", "__p").agg(F.sum("__b").alias("__b"), F.sum("__n").alias("__n"))
    fits = stored(sizes.filter((F.col("__b") <= limit) | (F.col("__n") == 1)), "shard-sizes")
    first = fits.agg(F.min("__d")).first()[0]
    # short prefixes, which very many cells share, do not fit and so need not meet in a join
    open_levels = levels.select("__cell", "__d", "__p").filter(F.col("__d") >= F.lit(first))
    found = open_levels.join(fits, ["__d", "__p"]).groupBy("__cell").agg(
        F.min(F.struct("__d", "__p", "__b", "__n")).alias("__leaf"))
    return cells.select("__cell").join(found, "__cell", "left")


def _shard_name(depth: Column, bits: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(bits), depth, F.lit("0")))


def shard_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``__bits, __bytes`` and the key of every row, with its shard: prefix, depth, bytes and rows."""
    rows = stored(docs.select(F.col(doc_id).alias("__id"), hash_bits(doc_id, text).alias("__bits"),
                              F.octet_length(whole(text)).cast("bigint").alias("__bytes")), "shard-rows")
    total = rows.agg(F.sum("__bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(total, 1) / max_bytes))) + _FINER)
    known, done, open_rows = 0, [], rows
    while True:
        # the cell table is no larger than the number of shards times a constant
        leaves = stored(_leaves(open_rows, known, depth, max_bytes), "shard-leaves")
        placed = open_rows.withColumn("__cell", prefix(F.col("__bits"), depth)).join(leaves, "__cell")
        done.append(placed.filter(F.col("__leaf").isNotNull()).select(
            "__id", "__bits", "__bytes", _shard_name(F.col("__leaf.__d"), F.col("__leaf.__p")).alias("shard"),
            F.col("__leaf.__d").alias("depth"), F.col("__leaf.__b").alias("shard_bytes"), F.col("__leaf.__n").alias("shard_docs")))
        if leaves.filter(F.col("__leaf").isNull()).isEmpty():
            break
        stuck = placed.filter(F.col("__leaf").isNull()).select("__id", "__bits", "__bytes")
        if depth == BITS:
            done.append(_pieces(stuck, max_bytes))
            break
        open_rows, known, depth = stored(stuck, "shard-open"), depth, min(BITS, depth + _MORE)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _pieces(rows: DataFrame, limit: int) -> DataFrame:
    """Rows that no bit tells apart, dealt by position; the positions are stored so that no retry changes them."""
    numbered = stored(rows.withColumn("__at", F.monotonically_increasing_id()), "shard-pieces")
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("__bytes"), F.lit(1))))
    # within each partition positions are consecutive, so every run of `per` of them holds at most `per` rows of a key
    piece = F.concat_ws(".", _shard_name(F.lit(BITS), F.col("__bits")), F.floor(F.col("__at") / per).cast("string"))
    numbered = numbered.withColumn("shard", piece).withColumn("depth", F.lit(BITS))
    sizes = numbered.groupBy("shard").agg(F.sum("__bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return numbered.join(sizes, "shard").select("__id", "__bits", "__bytes", "shard", "depth", "shard_bytes", "shard_docs")


def directory(shards: DataFrame) -> DataFrame:
    """The directory: each shard with the range of the hash bits that lead to it."""
    table = shards.groupBy("shard", "depth", "shard_bytes", "shard_docs").agg(F.min("__bits").alias("any_bits"))
    low = F.call_function("shiftleft", prefix(F.col("any_bits"), F.col("depth")), (F.lit(BITS) - F.col("depth")).cast("int"))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(BITS) - F.col("depth")).cast("int"))
    return table.select("shard", "depth", "shard_bytes", "shard_docs", low.alias("from_bits"), (low + width - 1).alias("to_bits"))


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", max_bytes: int = MAX_BYTES) -> None:
    """Write the documents' own columns, one folder a shard. Rows equal in key and text follow the first of their pieces."""
    names = shard_rows(docs, doc_id, text, max_bytes).groupBy("__bits").agg(F.min("shard").alias("__shard"))
    keyed = docs.withColumn("__bits", hash_bits(doc_id, text)).join(names, "__bits").drop("__bits")
    keyed.repartition("__shard").write.partitionBy("__shard").parquet(path)
