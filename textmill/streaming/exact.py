"""Exact dedup of a stream of documents, resumed from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textmill.functions.text import collapse
from textmill.operators.dedup import scope_key
from textmill.operators.filters import drop_reason


def first_of_each(docs: DataFrame, scope: str = "global", event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """The first row of each text. With an event time, state is kept for `delay` only, so copies further apart both pass."""
    key = F.sha2(F.concat_ws("\x01", scope_key(scope), collapse(F.coalesce("text", F.lit("")))), 256)
    d = docs.withColumn("_key", key)
    return (
        d.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["_key"]) if event_time else d.dropDuplicates(["_key"])
    ).drop("_key")


def filtered_stream(docs: DataFrame, out: str, checkpoint: str, scope: str = "global") -> StreamingQuery:
    """Filters, then dedups what arrives, into Parquet; ends when all that is there is read, and goes on from there the next time."""
    return first_of_each(
        docs.where(drop_reason().isNull()), scope
    ).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
