"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius by permuted block tables.

Every term of a text has a hash of BITS bits and a weight; for each bit, the terms vote with their
weights for 1 or against it, and the signs of the sums are the fingerprint. The share of equal bits
of two fingerprints estimates the angle between the texts' term weights.

The search splits fingerprints into RADIUS + 1 blocks. Two of them within RADIUS bits agree in at least one
whole block, so one table per block, keyed by that block, misses no pair.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.shingles import mix
from recordflow.operators.lookups import lookup, saved, saved_rows

BITS = 128
RADIUS = 4
#: Terms that vote in one step.
TERMS = 4096
#: Fingerprints of one bucket that are compared in one piece of work.
BLOCK = 4096
#: Ranges of ids for each shuffle partition.
RANGES = 8

#: A word, or one character of scripts written without spaces.
WORD = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]|[^\W぀-ヿ㐀-鿿豈-﫿]+")
PAIR = np.uint64(0x9E3779B97F4A7C15)
HALVES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
EMPTY = bytes(BITS // 8)


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of pairs of neighbouring words, lower-cased, and whole-number weights that grow
    with the logarithm of their counts. A single word is a term, and so is a text without words."""
    words = WORD.findall(text.lower()) or ([text] if text else [])
    if not words:
        return np.empty(0, np.uint64), np.empty(0)
    hashes = pd.util.hash_array(np.array(words, object), categorize=False)
    if len(words) > 1:
        hashes = mix(hashes[:-1] * PAIR + hashes[1:])
    distinct, counts = np.unique(hashes, return_counts=True)
    return distinct, np.rint(16 * (1 + np.log(counts)))


def fingerprint(text: str) -> bytes:
    """BITS / 8 bytes; equal texts have equal ones, and an empty text has zeros only."""
    hashes, weights = terms(text)
    if not len(hashes):
        return EMPTY
    votes = np.zeros(BITS)
    for a in range(0, len(hashes), TERMS):
        part = mix(hashes[a : a + TERMS, None] ^ HALVES)
        bits = np.unpackbits(part.view(np.uint8), axis=1)
        # Whole numbers below 2^24, so the sums are exact in any order.
        votes += weights[a : a + TERMS].astype(np.float32) @ bits.astype(np.float32)
    return np.packbits(2 * votes > weights.sum()).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The cosine that the share of equal bits stands for, 0 at least."""
    apart = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return 1.0 if not apart else max(0.0, float(np.cos(np.pi * apart / BITS)))


def with_neighbours(docs: DataFrame) -> DataFrame:
    """(``bucket``, ``ahead``, ``doc_id``, ``body``): rows with an id, dealt out by ranges of ids.

    Each bucket is a range whose largest id is a splitter, drawn from the ids' quantiles. The row of
    that id is also the next one after the bucket above, in descending order, and is sent there as
    well, ``ahead``; that of the largest id goes to the last bucket too. So the rows of a bucket have all of
    their neighbours at hand, and only one text per range moves twice.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / (RANGES * tasks) for i in range(1, RANGES * tasks)]
    rows = docs.filter("doc_id is not null").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    drawn = rows.agg(F.percentile_approx("doc_id", shares, 50 * RANGES * tasks), F.max("doc_id")).first()
    splitters = np.array(sorted({*drawn[0], drawn[1]}) if drawn[0] else [0])

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(splitters, ids.to_numpy())
        top = splitters[np.minimum(at, len(splitters) - 1)] == ids.to_numpy()
        return pd.Series([[a, (a + 1) % len(splitters)] if t else [a] for a, t in zip(at.tolist(), top.tolist())])

    placed = rows.select("doc_id", "body", places("doc_id").alias("places"))
    return placed.select(F.posexplode("places").alias("ahead", "bucket"), "doc_id", "body").select(
        "bucket", (F.col("ahead") > 0).alias("ahead"), "doc_id", "body"
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``n_chars``, ``edited_sha256``, ``print``, ``edited_print``, ``near_edited``, ``near_next``).

    The edited text has its last floor(n / 2) code points replaced by the first as many, or all, of
    the next text in descending order of ids; after the last one comes the first.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, print binary, edited_print binary, "
        "near_edited double, near_next double"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def result(doc_id, body: str, own: bytes, after: str, after_print: bytes | None):
        cut = len(body) // 2
        edited = body[: len(body) - cut] + after[:cut]
        edited_print = own if edited == body else fingerprint(edited)
        next_like = None if after_print is None else likeness(own, after_print)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        return doc_id, len(body), digest, own, edited_print, likeness(own, edited_print), next_like

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        types = [id_type, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    id_type = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32()}.get(kind, pa.int64())

    def ordered(batches: Iterator[pa.RecordBatch]):
        held = None  # (bucket, doc_id, body, print) that waits for its next row
        for batch in batches:
            out = []
            for bucket, ahead, doc_id, body in zip(*(c.to_pylist() for c in batch.columns)):
                waits = held is not None and held[0] == bucket
                if ahead and not waits:
                    continue
                own = fingerprint(body)
                if waits:
                    out.append(result(*held[1:], body, own))
                held = None if ahead else (bucket, doc_id, body, own)
            if out:
                yield batch_of(out)

    def alone(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                yield batch_of([result(None, t, fingerprint(t), "", None) for t in texts])

    by_range = (
        with_neighbours(docs)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "ahead", F.desc("doc_id"), F.xxhash64("body"), "body")
    )
    nameless = docs.filter("doc_id is null").select("doc_id", F.col("text").cast("string"))
    return by_range.mapInArrow(ordered, schema).union(nameless.mapInArrow(alone, schema))


def block_masks(blocks: int) -> list[tuple[int, int]]:
    """For each block of neighbouring bits the masks of the fingerprint's two halves."""
    edges = [i * BITS // blocks for i in range(blocks + 1)]
    masks = [((1 << (BITS - a)) - 1) ^ ((1 << (BITS - b)) - 1) for a, b in zip(edges, edges[1:])]
    return [(m >> 64, m & (2**64 - 1)) for m in masks]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_counts(prints: DataFrame, asked: Column, radius: int = RADIUS) -> DataFrame:
    """(``high``, ``low``, ``n_near``) for the distinct fingerprints of asked rows: how many rows of
    ``prints`` (``high``, ``low``) have one within ``radius`` bits, all of its own rows among them.

    Equal fingerprints are one entry with a weight. A bucket of a table is compared in blocks of
    queries and entries, each pair in the first table in which it meets, and only sums leave the task, so a large
    group of near copies is neither collected nor written out as pairs.
    """
    masks = block_masks(radius + 1)
    entries = prints.groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("weight"), F.max(F.coalesce(asked, F.lit(False))).alias("asked")
    )
    keys = [
        F.struct(
            F.lit(t).alias("table"),
            F.xxhash64(F.lit(t), *[F.col(c).bitwiseAND(F.lit(signed(m))) for c, m in zip(("high", "low"), pair)]).alias("key"),
        )
        for t, pair in enumerate(masks)
    ]
    entries = saved(entries, "simhash_entries")
    tables = entries.select(F.explode(F.array(*keys)).alias("k"), "*").select("k.*", "high", "low", "weight", "asked")
    sizes = tables.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("asked").cast("int")).alias("n_asked")
    )
    large, count = saved_rows(
        sizes.filter((F.col("n") > BLOCK) & (F.col("n_asked") > 0)).select(
            "key",
            F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"),
            F.ceil(F.col("n_asked") / BLOCK).cast("int").alias("asked_parts"),
        ),
        "simhash_large",
    )
    dealt = lookup(tables, large, ["key"], entries=count) if count else tables.select(
        "*", F.lit(None).cast("int").alias("parts"), F.lit(None).cast("int").alias("asked_parts")
    )
    parts, asked_parts = F.coalesce("parts", F.lit(1)), F.coalesce("asked_parts", F.lit(1))
    own, own_asked = F.pmod(F.xxhash64("low", "high"), parts), F.pmod(F.xxhash64("low", "high"), asked_parts)

    def units(count: Column, unit) -> Column:
        return F.transform(F.sequence(F.lit(0), count - 1), unit)

    def unit(i, j, side: bool):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("is_query"))

    as_entry = units(asked_parts, lambda i: unit(i, own, False))
    as_query = units(parts, lambda j: unit(own_asked, j, True))
    spread = dealt.select(
        "table", "key", "high", "low", "weight",
        F.explode(F.when(F.col("asked"), F.concat(as_entry, as_query)).otherwise(as_entry)).alias("u"),
    )
    ordered = (
        spread.select("key", "u.i", "u.j", "u.is_query", "table", "high", "low", "weight")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )
    wide = np.array([list(m) for m in masks], np.uint64)

    def compare(rows: np.ndarray, query: np.ndarray, out: list) -> None:
        """``rows`` has table, high, low and weight of one unit."""
        table, high, low, weight = rows
        high, low, weight = high.view(np.uint64), low.view(np.uint64), weight[~query]
        for q in np.flatnonzero(query):
            x, y = high[q] ^ high[~query], low[q] ^ low[~query]
            meet = (table[~query] == table[q]) & (np.bitwise_count(x).astype(int) + np.bitwise_count(y) <= radius)
            for t in range(len(wide)):  # the pair counts in the first table it meets in
                same = ((x & wide[t, 0]) | (y & wide[t, 1])) == 0
                meet &= same if t == table[q] else ~same | (t > table[q])
            n = int(weight[meet].sum())
            if n:
                out.append((rows[1][q], rows[2][q], n))

    def run(batches: Iterator[pa.RecordBatch]):
        held = None  # rows of a unit that may go on in the next batch
        for batch in chain(batches, [None]):
            out: list = []
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            if held is not None and held.num_rows:
                ids = np.stack([held.column(c).to_numpy() for c in ("key", "i", "j")])
                cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
                edges = np.array([0, *cuts.tolist(), *([held.num_rows] if batch is None else [])])
                query = held.column("is_query").to_numpy()
                rows = np.stack([held.column(c).to_numpy().astype(np.int64) for c in ("table", "high", "low", "weight")])
                queries = np.concatenate([[0], np.cumsum(query)])
                for a, b in zip(edges[:-1], edges[1:]):
                    if queries[b] > queries[a]:
                        compare(rows[:, a:b], query[a:b], out)
                held = held.slice(edges[-1])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["high", "low", "n"])

    return ordered.mapInArrow(run, "high long, low long, n long").groupBy("high", "low").agg(F.sum("n").alias("n_near"))


def mark_fingerprints(docs: DataFrame, *, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, a whole number, and ``text``): ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (hex), ``near_edited``, ``near_next`` and
    ``n_near``.

    ``n_near`` is, for rows whose id is divisible by 20, the number of other rows whose fingerprint is
    within ``radius`` bits, by the block tables; for other rows it is null.

    A null text counts as empty. An empty text has a fingerprint of zeros, and is near to nothing
    but its like: its ``n_near`` is 0. Rows of one id follow each other in the order of their texts' hashes. A
    row without an id has no place in the order: nothing follows it, its edited text is its first half, and ``near_next`` is
    null; other rows may still find it near. A single row comes after itself. An empty table gives an empty result. Other
    columns are not looked at.
    """
    prints = saved(fingerprints(docs), "simhash_prints")

    def half(start: int) -> Column:
        """The eight bytes from ``start``, counted from 1, as a signed number."""
        return F.conv(F.hex(F.substring("print", start, 8)), 16, -10).cast("long")

    rows = prints.withColumns({"high": half(1), "low": half(9), "asked": F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False))})
    full = rows.filter("high <> 0 or low <> 0")
    counts, entries = saved_rows(near_counts(full.select("high", "low", "asked"), F.col("asked"), radius), "simhash_near")
    found = lookup(rows, counts, ["high", "low"], entries=entries)
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("print")).alias("fingerprint"),
        F.lower(F.hex("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(F.col("asked"), F.coalesce(F.col("n_near") - 1, F.lit(0))).alias("n_near"),
    )
