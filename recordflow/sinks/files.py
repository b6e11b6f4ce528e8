"""File writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from recordflow.streaming.changes import with_trigger


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def write_examples(df: DataFrame, path: str, split: str = "split") -> None:
    """Training examples, one folder per split."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def stream_to_text(
    stream: DataFrame,
    path: str,
    *,
    checkpoint: str,
    num_shards: int | None = None,
    query_name: str | None = None,
    poll_seconds: int | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Write the ``value`` column as text files.

    ``num_shards`` bounds the files per trigger; without it every task writes its own file, which
    is what a large stream needs.
    """
    lines = stream.select("value")
    if num_shards:
        lines = lines.coalesce(num_shards)
    writer = lines.writeStream.format("text").option("checkpointLocation", checkpoint).option("path", path)
    if query_name:
        writer = writer.queryName(query_name)
    return with_trigger(writer, poll_seconds, drain).start()
