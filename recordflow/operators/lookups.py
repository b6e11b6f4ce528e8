"""Joins against tables with unique keys that stay even when the probing side is skewed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F

from recordflow.session import scratch_path

BROADCAST_ROWS = 200_000
# A key is hot when it holds more than 1 / HOT_SHARE of what a task should get.
HOT_SHARE = 2


def saved_rows(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write to the shared folder and read back, with the number of rows counted on the way.

    This cuts the lineage with data every executor can read again.
    """
    path = scratch_path(df.sparkSession, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def saved(df: DataFrame, label: str) -> DataFrame:
    return saved_rows(df, label)[0]


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    entries: int | None = None,
) -> DataFrame:
    """Join ``rows`` with a narrow ``table`` that has each key once; any key may hold most of ``rows``.

    The table is counted first, unless the caller knows its ``entries``. Up to ``broadcast_rows``
    it is broadcast. Beyond that the join is a shuffle, except for hot keys: those with more than
    their share of the rows of a task. There are at most ``HOT_SHARE`` times as many of them as
    tasks, so their part of the table is broadcast and their rows stay where they are.
    ``how`` is ``left`` or ``inner``; ``rows`` are read several times beyond the broadcast.
    """
    if (table.count() if entries is None else entries) <= broadcast_rows:
        return rows.join(F.broadcast(table), keys, how)
    return _split_join(rows, table, keys, how)


def _split_join(rows: DataFrame, table: DataFrame, keys: list[str], how: str) -> DataFrame:
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = saved(rows.filter(known).groupBy(*keys).count(), "key_counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = counts.filter(F.col("count") > max(total // (HOT_SHARE * tasks), 1)).select(*keys)
    found = table.withColumn("_found", F.lit(True)).join(F.broadcast(hot), keys)
    hot_part = hot.withColumn("_hot", F.lit(True)).join(F.broadcast(found), keys, "left")
    tagged = rows.join(F.broadcast(saved(hot_part, "hot_keys")), keys, "left")
    columns = [*keys, *[c for c in rows.columns if c not in keys], *[c for c in table.columns if c not in keys]]
    stay = tagged.filter("_hot")
    if how == "inner":
        stay = stay.filter("_found")
    cold = tagged.filter("_hot is null").select(*rows.columns)
    joined = stay.select(*columns).union(cold.filter(known).join(table, keys, how).select(*columns))
    if how == "inner":
        return joined
    # Rows without a key would all meet in one task.
    lacking = tagged.filter(~known).select(*columns)
    return joined.union(lacking)
