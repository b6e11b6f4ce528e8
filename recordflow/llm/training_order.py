"""Token sequences in training order: a keyed permutation gives each sequence a global slot.

A Feistel network over the smallest square domain permutes the sequence numbers, and walks on along
a cycle while a number lies outside of them. Ranges of slots are shards: binary files of records of a
fixed stride, so any slot is found by its number, and a reader goes on where it stopped.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from recordflow.llm.merge_replay import blocks
from recordflow.llm.shingles import mix

ROUNDS = 6
#: Characters of text that are packed at a time.
BLOCK_CHARS = 4_000_000
#: A record: id of the first document, number of documents, number of tokens (big-endian), then the
#: tokens (16 bits, little-endian), then a line feed as a guard.
HEADER = np.dtype([("doc", ">i8"), ("docs", ">i4"), ("tokens", ">i4")])
GUARD = 1


@lru_cache(maxsize=2)
def library(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def stride(length: int) -> int:
    return HEADER.itemsize + 2 * length + GUARD


class Permutation:
    """A bijection of 0 .. size-1 that depends on a key."""

    def __init__(self, size: int, key: str):
        self.size = size
        self.half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        digest = hashlib.blake2b(key.encode(), digest_size=8 * ROUNDS).digest()
        self.keys = np.frombuffer(digest, "<u8")

    def _network(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in keys:
            left, right = right, left ^ (mix(right + key) & self.mask)
        return (right << self.half) | left  # halves exchanged, so that the reversed keys undo it

    def _walk(self, numbers: np.ndarray, keys) -> np.ndarray:
        out = self._network(numbers.astype(np.uint64), keys)
        while (outside := out >= self.size).any():
            out[outside] = self._network(out[outside], keys)
        return out.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self.keys)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self.keys[::-1])


class Packer:
    """Lays documents end to end, each followed by ``stop``, and cuts them into sequences."""

    def __init__(self, length: int, stop: int):
        self.length, self.stop = length, stop
        self.tokens, self.owners, self.ids = np.empty(0, np.uint16), np.empty(0, np.int64), []

    def add(self, doc_ids: list, texts, last: bool = False) -> np.ndarray:
        """The records of all whole sequences; with ``last``, of the rest as well."""
        parts, owners = [self.tokens], [self.owners]
        for doc_id, ids in zip(doc_ids, texts):
            parts += [np.array(ids, np.uint16), np.array([self.stop], np.uint16)]
            owners.append(np.full(len(ids) + 1, len(self.ids)))
            self.ids.append(doc_id)
        tokens, owner = np.concatenate(parts), np.concatenate(owners)
        n = len(tokens) // self.length
        used = n * self.length
        sizes = np.full(n, self.length)
        if last and used < len(tokens):
            sizes = np.append(sizes, len(tokens) - used)
            fill = self.length - sizes[-1]
            tokens = np.append(tokens, np.full(fill, self.stop, np.uint16))
            owner = np.append(owner, np.full(fill, owner[-1]))
            n, used = n + 1, len(tokens)
        record = np.dtype([*HEADER.descr, ("body", "<u2", (self.length,)), ("guard", "u1")])
        out = np.zeros(n, record)
        grid = owner[:used].reshape(n, self.length)
        ids = np.array([-1 if i is None else i for i in self.ids], np.int64)
        if n:
            out["doc"], out["docs"] = ids[grid[:, 0]], grid[:, -1] - grid[:, 0] + 1
            out["tokens"], out["body"], out["guard"] = sizes, tokens[:used].reshape(n, self.length), 10
        first = int(owner[used]) if used < len(owner) else len(self.ids)
        self.tokens, self.owners, self.ids = tokens[used:], owner[used:] - first, self.ids[first:]
        return out


def write(
    docs: DataFrame, path: str, tokenizer: str, pattern: str, *, stop: int, length: int, per_shard: int, key: str
) -> int:
    """Write the sequences of ``docs`` (``doc_id``, ``text``) below ``path`` and return their number.

    Documents are tokenised whole, in the order of the table's partitions, and packed into sequences
    of ``length`` tokens, each document followed by ``stop``; a partition's last sequence is filled up
    with ``stop``. Shard s is the folder ``shard=s`` with one file, which has slots s * per_shard and
    on, in order.

    The first pass only counts each partition's sequences, one number of which comes to the driver,
    and the second one tokenises again and writes: keeping the tokens in between takes as much disk
    as the shards. Both need the same partitions, as a table of files gives them; a partition that
    changes between the passes ends the job. A task that is lost is repeated with the same slots.

    A null or empty text is one ``stop``. A null id is written as -1. Rows that repeat are written
    each. An empty table writes a folder without shards and returns 0. Other columns are not looked at.
    """
    source = docs.select("doc_id", F.col("text").cast("string"))

    def records(batches):
        encode, packer = library(tokenizer, pattern).encode_ordinary, Packer(length, stop)
        for doc_ids, texts in blocks(batches, BLOCK_CHARS):
            yield packer.add(doc_ids, map(encode, texts))
        yield packer.add([], [], last=True)

    def count(batches):
        encode = library(tokenizer, pattern).encode_ordinary
        n = -(-sum(len(encode(t)) + 1 for _, texts in blocks(batches, BLOCK_CHARS) for t in texts) // length)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int64())})

    counts = sorted(map(tuple, source.mapInArrow(count, "part int, n long").collect()))
    ends = list(accumulate(n for _, n in counts))
    total = ends[-1] if ends else 0
    starts = {part: (end - n, end) for (part, n), end in zip(counts, ends)}

    def place(batches):
        order = Permutation(total, key)
        at, end = starts.get(TaskContext.get().partitionId(), (0, 0))
        for rows in records(batches):
            for a in range(0, len(rows), 4096):
                part = rows[a : a + 4096]
                slots = order.slots(np.arange(at, at + len(part)))
                at += len(part)
                body = [r.tobytes()[:-GUARD] for r in part]  # the writer ends each line with the guard
                yield pa.RecordBatch.from_arrays(
                    [pa.array((slots // per_shard).astype(np.int32)), pa.array(slots), pa.array(body, pa.binary())],
                    ["shard", "slot", "record"],
                )
        if at != end:
            raise RuntimeError("the table's partitions changed between counting and writing")

    shards = max(-(-total // per_shard), 1)
    (
        source.mapInArrow(place, "shard int, slot long, record binary")
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", "slot")
        .select("shard", F.col("record").cast("string").alias("record"))
        .write.partitionBy("shard")
        .text(path)
    )
    return total


def read(spark: SparkSession, path: str, *, length: int, per_shard: int, first: int = 0) -> DataFrame:
    """The records from slot ``first`` on: ``slot``, ``shard``, ``offset`` of the record in its file,
    ``first_doc_id``, ``n_docs``, ``n_tokens`` and ``tokens`` (binary). Earlier shards are not read."""
    size = stride(length)
    files = spark.read.format("binaryFile").load(path)
    if "shard" not in files.columns:  # no sequences were written
        files = files.withColumn("shard", F.lit(0))
    files = files.filter(F.col("shard") >= first // per_shard)
    place = F.explode(F.sequence(F.lit(0), F.expr(f"int(length(content) div {size}) - 1")))
    rows = files.select("shard", "content", place.alias("place")).select(
        "shard", "place", F.expr(f"substring(content, place * {size} + 1, {size})").alias("record")
    )

    def number(start: int, count: int):
        return F.conv(F.hex(F.substring("record", start, count)), 16, -10).cast("long")

    return rows.select(
        (F.col("shard").cast("long") * per_shard + F.col("place")).alias("slot"),
        "shard",
        (F.col("place").cast("long") * size).alias("offset"),
        number(1, 8).alias("first_doc_id"),
        number(9, 4).cast("int").alias("n_docs"),
        number(13, 4).cast("int").alias("n_tokens"),
        F.substring("record", HEADER.itemsize + 1, 2 * length).alias("tokens"),
    ).filter(F.col("slot") >= first)
