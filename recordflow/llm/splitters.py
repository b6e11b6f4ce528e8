"""Sharding by sampled splitters: shards of nearly equal bytes, in the order of a key."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from recordflow.operators.lookups import saved

#: Bytes that a record takes besides its text.
OVERHEAD = 16
#: Ranges per shard, and expected sample keys per range. Both bound what the driver sees.
RANGES = 8
SAMPLES = 16
#: A range with more than so many times its share of the bytes is divided again.
OVERFULL = 2


def assign_shards(docs: DataFrame, shards: int) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``size``, ``text_crc32``,
    ``law`` (``bytes``), ``shard``, ``slot`` and a null ``grown_shard``.

    The key is (hash of the text, id), so equal texts lie next to each other and a text that alone
    is larger than a shard is divided by id. Keys are sampled with a chance in proportion to their
    size, quantiles of the sample bound the ranges, and ranges that are still overfull, which only
    many rows of one key or an unlucky sample can make, are divided by a hash of the whole row and a
    salt. Exact sums over the ranges and running sums inside them then give each record its place in
    the order of all bytes: a record belongs to the shard in which its middle byte lies, so a
    shard's bytes differ from the mean by half of the record at either end, at most. Slots count
    from 0 in each shard, without gaps.

    A null text has no bytes and is not equal to an empty one in the order, but gets the same
    checksum, 0. Null ids come first among equal texts; rows that repeat get slots of their own. An
    empty table gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = saved(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.xxhash64("text").alias("key"),
        ),
        "shard_rows",
    )
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 1
    ranges = shards * RANGES
    # A record's chance grows with its size; the hash makes retries draw the same sample.
    chance = F.col("size") * (ranges * SAMPLES / total)
    drawn = F.pmod(F.xxhash64("key", "doc_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30) < chance
    sample = rows.filter(drawn).select("key", "doc_id").orderBy("key", "doc_id").collect()
    bounds = sorted(
        {tuple(sample[len(sample) * i // ranges]) for i in range(1, ranges) if sample},
        key=lambda b: (b[0], b[1] is not None, b[1] or 0),
    )
    kind = dict(docs.dtypes)["doc_id"]
    splitters = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).cast(kind).alias("i")) for k, i in bounds])
    here = F.struct(F.col("key").alias("k"), F.col("doc_id").alias("i"))
    ranged = rows.withColumn(
        "range", F.size(F.filter(splitters, lambda b: b <= here)) if bounds else F.lit(0)
    )
    fill = {r["range"]: r["size"] for r in ranged.groupBy("range").agg(F.sum("size").alias("size")).collect()}
    pieces = {k: -(-n * ranges // total) for k, n in fill.items() if n * ranges > OVERFULL * total}
    piece = F.lit(0)
    if pieces:
        into = F.create_map(*[F.lit(x) for pair in pieces.items() for x in pair])
        salted = F.xxhash64("key", "doc_id", F.monotonically_increasing_id())
        piece = F.coalesce(F.pmod(salted, into[F.col("range")]), F.lit(0))
    ranged = saved(ranged.withColumn("piece", piece.cast("int")), "shard_ranges")
    sums = sorted(
        map(tuple, ranged.groupBy("range", "piece").agg(F.sum("size"), F.count(F.lit(1))).collect())
    )
    starts = spark.createDataFrame(
        [
            (r, p, b - size, n - rows_in)
            for (r, p, size, rows_in), b, n in zip(
                sums, accumulate(s[2] for s in sums), accumulate(s[3] for s in sums), strict=True
            )
        ],
        "range int, piece int, byte_start long, row_start long",
    )
    order = Window.partitionBy("range", "piece").orderBy("key", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = saved(
        ranged.select("*", before.alias("before"), (F.row_number().over(order) - 1).alias("nth"))
        .join(F.broadcast(starts), ["range", "piece"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("row_start") + F.col("nth")).alias("row"),
            F.expr(f"int(((2 * (byte_start + before) + size) * {shards}) div {2 * total})").alias("shard"),
        ),
        "shard_places",
    )
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
