"""Exact deduplication by sorting content.

Sampled splitters deal the rows out by ranges of their normalised bytes, an external sort places
equal texts next to each other, and neighbours are compared in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.operators.lookups import saved

#: Splitters are drawn from so many leading characters and a 64-bit hash of the whole text, so that
#: the sample on the driver stays small and a common first line does not make a hot range.
PREFIX = 16
#: A text is hot when it holds more than 1 / HOT_SHARE of a task's share of the rows.
HOT_SHARE = 4


def mark_copies(
    docs: DataFrame, *, keep: str = "smallest", normalise: Callable[[Column], Column] | None = None
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``.

    Texts are equal when their normalised bytes are; ``normalise`` maps the text column and changes
    nothing by default. The row with the ``smallest`` or ``largest`` id of each group is kept.

    A null text counts as empty, and empty texts are equal. Rows that repeat id and text are all
    returned and only one of them is kept. A null id loses against any other; a group of null ids
    keeps one row, with a null ``keep_id``. An empty table gives an empty result. Other columns are
    not looked at.

    A text with more than its share of the rows is dealt out by (text, salt), and its parts, of
    which there are few, are put together afterwards. Only rows without their texts are written.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    if normalise is not None:
        body = F.coalesce(normalise(body), F.lit(""))
    rows = docs.select("doc_id", body.alias("body")).withColumn("hash", F.xxhash64("body"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bound = max(docs.select("doc_id").count() // (HOT_SHARE * tasks), 1)
    # At most HOT_SHARE * tasks hashes can have more rows than the bound.
    hot = rows.groupBy("hash").count().filter(F.col("count") > bound)
    parts = F.ceil(F.col("count") / bound)
    placed = (
        rows.join(F.broadcast(hot), "hash", "left")
        .withColumn("salt", F.when(F.col("count").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), parts)))
        .withColumn("prefix", F.substring("body", 1, PREFIX))
        .repartitionByRange("prefix", "hash", "salt")
    )
    # The ranges already hold the rows of a text and salt together, so this sorts without another exchange.
    best = F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()
    equal = Window.partitionBy("prefix", "hash", "salt", "body").orderBy(best)
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = saved(
        placed.select(
            "doc_id",
            F.sha2("body", 256).alias("text_sha256"),
            F.col("count").isNotNull().alias("hot"),
            F.row_number().over(equal).alias("place"),
            F.first("doc_id").over(whole).alias("part_keep"),
            F.count(F.lit(1)).over(whole).alias("part_size"),
        ),
        "content_sort",
    )
    # One row per hot text, from one row per part of it.
    pick = F.min if keep == "smallest" else F.max
    totals = (
        marked.filter("hot and place = 1")
        .groupBy("text_sha256")
        .agg(pick("part_keep").alias("all_keep"), F.sum("part_size").alias("all_size"))
        .withColumn("hot", F.lit(True))
    )
    keep_id = F.when(F.col("hot"), F.col("all_keep")).otherwise(F.col("part_keep"))
    return marked.join(F.broadcast(totals), ["text_sha256", "hot"], "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("all_size", "part_size").alias("group_size"),
        ((F.col("place") == 1) & F.col("part_keep").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )
