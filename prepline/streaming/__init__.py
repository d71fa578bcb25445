"""Fitted steps on a stream.

Every fitted step is a projection without state, so ``transform`` takes a
streaming frame as it takes a table. ``write_prepared`` is the usual sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_prepared(stream: DataFrame, model, path: str, checkpoint: str) -> StreamingQuery:
    """Apply a fitted step to new files as they arrive and append the result as parquet."""
    prepared = model.transform(stream)
    return (
        prepared.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
