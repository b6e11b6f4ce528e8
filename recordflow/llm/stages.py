"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns the rows that go on."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordflow.llm import merge_replay, raking, toxicity
from recordflow.llm.content_sort import mark_copies
from recordflow.llm.multi_index import mark_near_copies
from recordflow.operators.lookups import lookup, saved


def without(docs: DataFrame, key: Column, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key, which is not null, is not in ``dropped`` (``key``, distinct)."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("key"))
    table = dropped.select("key", F.lit(True).alias("dropped"))
    return lookup(rows, table, ["key"]).filter("dropped is null").select("doc.*")


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, longer where the table has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    score = free_name(docs, "_toxicity")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), score)
    return scored.filter(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of equal texts stays; of rows that repeat it, one does."""
    marks = saved(mark_copies(docs, keep="smallest"), "copies")

    def key(digest: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest)

    lost = marks.filter(~F.col("kept")).select(key(F.col("text_sha256")).alias("key"), "doc_id", "keep_id").distinct()
    own = key(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    again = lost.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("key")  # repeats of a row that stays
    left = without(docs, own, saved(lost.select("key"), "dropped"))
    if again.isEmpty():
        return left
    name = free_name(docs, "_key")
    repeats = docs.withColumn(name, own).join(again.withColumnRenamed("key", name), name, "left_semi")
    return left.union(repeats.dropDuplicates([name]).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, by shingles of five words."""
    marks = mark_near_copies(docs, width=5, percent=80)
    dropped = marks.filter(~F.col("kept")).select(F.col("doc_id").cast("string").alias("key")).distinct()
    return without(docs, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), saved(dropped, "near_dropped"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return raking.by_form(docs, sample=raking.SAMPLE).filter("kept").select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids``, and ``text`` as decoded from the ids."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = merge_replay.decode(merge_replay.encode(docs, path, public_tokenizers.PATTERN), path)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]
