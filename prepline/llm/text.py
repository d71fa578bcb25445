"""What the text operators share: words, blocks of bounded size, frames that are stored or attached."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepline.session import shared_folder

#: A word: code points other than the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BLOCK_CHARS = 4_000_000
BROADCAST_ROWS = 10_000


def whole(text: str) -> Column:
    """The text, a missing one as an empty one."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def blocks(batches: Iterator[pd.DataFrame], text: str, chars: int = BLOCK_CHARS) -> Iterator[pd.DataFrame]:
    """Rows in slices of about so many characters; one long text is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(batch[text].str.len().fillna(0).to_numpy(np.int64))
        start = 0
        while start < len(batch):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + chars, side="right")))
            yield batch.iloc[start:stop].reset_index(drop=True)
            start = stop


def split_words(texts: list[str], lower: bool = True) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Code of each word, the distinct words, and the number of words of each text."""
    lists = [(t.encode().lower() if lower else t.encode()).split() for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.empty(int(counts.sum()), dtype=object)
    at = 0
    for words in lists:
        flat[at : at + len(words)] = words
        at += len(words)
    codes, distinct = pd.factorize(flat)
    return codes.astype(np.int64), list(distinct), counts


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser that spreads 64-bit integers."""
    x = (x + np.uint64((seed * 2 + 1) * 0x9E3779B97F4A7C15 % 2**64)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder once and read it from there; a lost executor loses none of it."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Frames written inside reach Python in batches of so few rows; for rows that may each be large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote for these frames, once nothing will read them again."""
    for df in frames:
        if getattr(df, "stored_at", None):
            context = df.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def attach(docs: DataFrame, table: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Join a table of one row a group to many rows.

    It is broadcast when counted at ``BROADCAST_ROWS`` rows or fewer; a longer one
    is joined by a shuffle in which Spark splits the heavy groups.
    """
    small = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(table) if small else table, on, how)
