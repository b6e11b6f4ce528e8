"""Alignment of two tokenizers' tokens, and how often the corpus links each pair of token ids.

A text's bytes are cut wherever tokens of both tokenizers end, and the tokens of a group between two
cuts are linked. The distinct id pairs get a minimal perfect hash, sharded by the first id; tasks add
up dense vectors of document counts indexed by it, which are summed as a tree; and a second pass aligns the texts
again and looks the counts up.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from recordflow.llm.digest_cache import splits_at_words
from recordflow.llm.shingles import mix
from recordflow.operators.lookups import saved, saved_rows

#: Pairs of one shard of the hash, on average.
SHARD_PAIRS = 1 << 20
#: Up to so many pairs (17 bytes each) the table goes to all tasks; beyond it, the texts' pairs go to the shards.
BROADCAST_PAIRS = 2_000_000
#: Characters of aligned chunks that a worker holds, and of texts that are aligned in one step.
CHUNK_CHARS = 6_000_000
STEP_CHARS = 2_000_000
#: Slots of a level of the hash for each key that is left.
SPARE = 1.5

SPACE_MARK = "▁"
#: Neither tokenizer has a token over a space between another character and a letter, digit or underscore.
CUT = re.compile(rf"(?<=[^ {SPACE_MARK}]) (?=\w)")
#: Chunks that such a space can stand on both sides of; TOGETHER of them are encoded at once.
INNER = re.compile(rf"\w[^{SPACE_MARK}]*(?<! )", re.DOTALL)
TOGETHER = 2000
#: Documents whose pairs are counted in one step.
DOCUMENTS = 100
SEEDS = mix(np.arange(1, 129, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys, which it keeps for verification.

    Every level hashes the keys that are left into slots and settles those that have a slot of their own. A key's
    index is the number of used slots before its own.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray, keys: np.ndarray):
        self.sizes, self.words, self.keys = sizes, words, keys
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            if len(sizes) == len(SEEDS):
                raise ValueError("the keys are not distinct")
            size = 64 * int(np.ceil(SPARE * len(left) / 64))
            place = mix(left ^ SEEDS[len(sizes)]) % np.uint64(size)
            single = np.bincount(place.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            levels.append(single)
            left = left[~single[place.astype(np.int64)]]
        used = np.concatenate(levels) if levels else np.zeros(0, bool)
        words = np.packbits(used, bitorder="little").view("<u8")
        out = cls(np.array(sizes, np.int64), words, np.zeros(len(keys), np.uint64))
        out.keys[out._index(keys)] = keys
        return out

    def _index(self, keys: np.ndarray) -> np.ndarray:
        index = np.full(len(keys), -1, np.int64)
        left, offset = np.arange(len(keys)), 0
        for seed, size in zip(SEEDS, self.sizes.tolist()):
            if not len(left):
                break
            place = (mix(keys[left] ^ seed) % np.uint64(size)).astype(np.int64) + offset
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            used = (self.words[word] >> bit) & np.uint64(1) == 1
            word, bit = word[used], bit[used]
            lower = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            index[left[used]] = self.before[word] + np.bitwise_count(lower)
            left, offset = left[~used], offset + size
        return index

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, or -1 for a key that is not in the hash."""
        index = self._index(keys)
        known = np.flatnonzero(index >= 0)
        index[known[self.keys[index[known]] != keys[known]]] = -1
        return index

    def parts(self) -> tuple[bytes, bytes, bytes]:
        return self.sizes.tobytes(), self.words.tobytes(), self.keys.tobytes()

    @classmethod
    def of(cls, sizes: bytes, words: bytes, keys: bytes) -> PerfectHash:
        return cls(np.frombuffer(sizes, np.int64), np.frombuffer(words, "<u8"), np.frombuffer(keys, np.uint64))


class Tokens:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.width = len(self.bytes_b)
        self.lengths_a = np.array([len(x) for x in self.bytes_a])
        self.lengths_b = np.array([len(x) for x in self.bytes_b])
        crossing = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}")
        self.by_words = splits_at_words(self.a) and not any(crossing.search(p) for p in pieces)

    def chunks(self, text: str) -> list[str]:
        """The text in pieces that can be encoded one by one, each after a space."""
        return CUT.split(text) if self.by_words else [text]

    def encode(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The chunks in another order, tokens of A and of B of all of them, and how many each one has; a chunk
        whose bytes do not come back has none.

        Chunks that may follow each other in a text are encoded many at a time, as one text; their bytes tell
        them apart again.
        """
        inner = [c for c in chunks if self.by_words and INNER.fullmatch(c)]
        alone = list(set(chunks) - set(inner))
        order, sides = [], ([], [])
        for at in range(0, len(inner), TOGETHER):
            part = inner[at : at + TOGETHER]
            text = " ".join(part)
            raw = [c.encode() for c in part]
            ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
            whole = b" " + b" ".join(raw)
            ids = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)
            if any(b"".join(map(k.__getitem__, x)) != whole for k, x in zip((self.bytes_a, self.bytes_b), ids)):
                alone += part
                continue
            order += part
            for side, x, lengths in zip(sides, ids, (self.lengths_a, self.lengths_b)):
                x = np.array(x, np.int64)
                cuts = np.searchsorted(np.cumsum(lengths[x]), ends, side="right")
                side.append((x, np.diff(cuts, prepend=0)))
        if alone:
            order += alone
            ids_a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in alone], add_special_tokens=False)]
            ids_b = self.b.encode(alone, num_threads=1)
            for i, c in enumerate(alone):
                whole = (" " + c).encode()
                if any(b"".join(map(k.__getitem__, x[i])) != whole for k, x in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))):
                    ids_a[i], ids_b[i] = [], []
            for side, ids in zip(sides, (ids_a, ids_b)):
                flat = np.array([x for own in ids for x in own], np.int64)
                side.append((flat, np.fromiter(map(len, ids), np.int64, len(ids))))
        (flat_a, n_a), (flat_b, n_b) = ([np.concatenate(x) for x in zip(*side)] for side in sides)
        return order, flat_a, flat_b, n_a, n_b


def byte_letters() -> dict[str, int]:
    """The bytes of the letters that byte-level vocabularies are written in."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The common ends of two rising lists that end alike, and the group of each token."""
    cuts = ends_a[ends_b[np.searchsorted(ends_b, ends_a)] == ends_a] if len(ends_a) else ends_a
    return cuts, np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Aligner:
    """Aligned chunks of one worker, and their sums under a table of pair counts."""

    def __init__(
        self,
        tokens: Tokens,
        look_up: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
        *,
        written: bool = True,
    ):
        self.tokens, self.look_up, self.written = tokens, look_up, written
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[str] = []
        self.keys = np.zeros(0, np.uint64)
        #: For each chunk whether its bytes come back, tokens of A and B, groups, links, best links, sum of counts.
        self.sums = np.zeros((0, 7), np.int64)
        self.chars = 0

    def learn(self, chunks: list[str]) -> None:
        if self.chars > CHUNK_CHARS:
            self.clear()
        new = list(set(chunks) - self.known.keys())
        if not new:
            return
        new, flat_a, flat_b, n_a, n_b = self.tokens.encode(new)
        self.known.update(zip(new, range(len(self.sums), len(self.sums) + len(new))))
        # Chunks end where tokens of both end, so one alignment of all of them gives that of each.
        cuts, group_a, group_b = groups_of(
            np.cumsum(self.tokens.lengths_a[flat_a]), np.cumsum(self.tokens.lengths_b[flat_b])
        )
        count_a, count_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        begin_a, begin_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
        # Each token of A with all tokens of B in its group.
        times = count_b[group_a]
        place = np.concatenate([[0], np.cumsum(times)])
        partner = flat_b[ranges(begin_b[group_a], times)]
        keys = (np.repeat(flat_a, times) * self.tokens.width + partner).astype(np.uint64)
        last_a = np.cumsum(n_a)
        last = np.searchsorted(begin_a, last_a)  # groups up to and with each chunk
        links = place[last_a]
        sums = np.zeros((len(new), 7), np.int64)
        sums[:, 0], sums[:, 1], sums[:, 2] = n_a > 0, n_a, n_b
        sums[:, 3], sums[:, 4] = np.diff(last, prepend=0), np.diff(links, prepend=0)
        if self.look_up is not None:
            counts, best = self.look_up(keys)
            for column, values in ((5, best), (6, counts)):
                total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                sums[:, column] = np.diff(total[links], prepend=0)
        else:
            self.keys = np.concatenate([self.keys, keys])
            self.starts = np.concatenate([[0], np.cumsum(np.concatenate([self.sums[:, 4], sums[:, 4]]))])
        if self.written:
            ids_a, ids_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
            spans = zip(begin_a.tolist(), count_a.tolist(), begin_b.tolist(), count_b.tolist())
            groups = [f"{','.join(ids_a[x : x + m])}|{','.join(ids_b[y : y + n])}" for x, m, y, n in spans]
            ends = last.tolist()
            self.text += [";".join(groups[x:y]) for x, y in zip([0, *ends], ends)]
        self.sums = np.concatenate([self.sums, sums])
        self.chars += sum(map(len, new))

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The sums of each text, and the places of its chunks; a text without tokens has zeros and none."""
        cut = [self.tokens.chunks(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(cut))
        self.learn(flat)
        places = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        total = np.concatenate([np.zeros((1, 7), np.int64), np.cumsum(self.sums[places], axis=0)])
        sums = np.diff(total[np.concatenate([[0], ends])], axis=0)
        begin = np.concatenate([[0], ends[:-1]])
        whole = (sums[:, 0] == ends - begin) & (ends > begin)
        sums[~whole] = 0
        return sums, [places[x:y] if ok else places[:0] for x, y, ok in zip(begin.tolist(), ends.tolist(), whole.tolist())]

    def linked(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of a document, and how often each is linked in it."""
        if not len(places):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return np.unique(self.keys[ranges(self.starts[places], self.sums[places, 4])], return_counts=True)

    def counted(self, documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of some documents, and how many of them link each."""
        found, times = [], []
        for a in range(0, len(documents), DOCUMENTS):
            part = documents[a : a + DOCUMENTS]
            places = np.concatenate(part)
            if not len(places):
                continue
            length = self.sums[places, 4]
            owner = np.repeat(np.repeat(np.arange(len(part)), [len(p) for p in part]), length)
            keys = self.keys[ranges(self.starts[places], length)]
            distinct, place = np.unique(keys, return_inverse=True)
            # The pairs of a document are distinct, those of several are not.
            once = np.unique(place * len(part) + owner) // len(part)
            found.append(distinct)
            times.append(np.bincount(once, minlength=len(distinct)))
        if not found:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        keys, place = np.unique(np.concatenate(found), return_inverse=True)
        return keys, np.bincount(place, np.concatenate(times), len(keys)).astype(np.int64)

    def digest(self, places: np.ndarray) -> str:
        if not len(places):
            return ""
        return hashlib.sha256(";".join(map(self.text.__getitem__, places.tolist())).encode()).hexdigest()


@lru_cache(maxsize=1)
def tokens_of(path_a: str, path_b: str) -> Tokens:
    return Tokens(path_a, path_b)


def steps(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of STEP_CHARS characters or one text."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= STEP_CHARS or i + 1 == len(texts):
            yield start, i + 1
            start, size = i + 1, 0


def shard_of(keys: np.ndarray, width: int, shards: int) -> np.ndarray:
    """Pairs of one first id are in one shard."""
    return (mix(keys // np.uint64(width)) % np.uint64(shards)).astype(np.int64)


class Shards:
    """The hash, and once they are known the counts, of all shards."""

    def __init__(self, rows: list[dict], width: int):
        self.width = width
        self.hashes = [PerfectHash.of(r["sizes"], r["words"], r["keys"]) for r in rows]
        self.counts = [np.frombuffer(r["counts"], np.int64) for r in rows if "counts" in r]
        self.best = [np.frombuffer(r["best"], bool) for r in rows if "best" in r]

    def slots(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, places among ``keys``, slots)"""
        shards = shard_of(keys, self.width, len(self.hashes))
        for s, found in enumerate(self.hashes):
            at = np.flatnonzero(shards == s)
            if len(at):
                yield s, at, found.slots(keys[at])

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for s, at, slots in self.slots(keys):
            counts[at], best[at] = checked(self.counts[s], slots), checked(self.best[s], slots)
        return counts, best


def checked(values: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return values[known_slots(slots)]


def best_pairs(keys: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Whether each pair has the highest count of its first id."""
    _, first = np.unique(keys // np.uint64(width), return_inverse=True)
    highest = np.zeros(first.max() + 1 if len(first) else 0, np.int64)
    np.maximum.at(highest, first, counts)
    return counts == highest[first]


def runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that follow each other and agree in the first columns, one batch's part at a time."""
    for batch in batches:
        held, key = [], None
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:columns] != key and held:
                yield key, held
                held = []
            key = row[:columns]
            held.append(row[columns:])
        if held:
            yield key, held


HASH = "shard int, sizes binary, words binary, keys binary"


def hashed(keys: DataFrame, width: int, shards: int) -> DataFrame:
    """One row per shard with the minimal perfect hash of its pairs (``key``, distinct)."""

    def place(batches):
        for batch in batches:
            found = shard_of(batch.column(0).to_numpy().astype(np.uint64), width, shards)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), batch.column(0)], ["shard", "key"])

    def row(shard: int, held: list[np.ndarray]) -> pa.RecordBatch:
        parts = PerfectHash.build(np.concatenate(held).astype(np.uint64)).parts()
        columns = [pa.array([shard], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]]
        return pa.RecordBatch.from_arrays(columns, ["shard", "sizes", "words", "keys"])

    def build(batches):
        current, held = None, []
        for batch in batches:
            shard, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if current is not None and shard[a] != current:
                    yield row(current, held)
                    held = []
                current = int(shard[a])
                held.append(key[a:b])
        if held:
            yield row(current, held)

    placed = keys.mapInArrow(place, "shard int, key long")
    return placed.repartition("shard").sortWithinPartitions("shard", "key").mapInArrow(build, HASH)


def pack(vector: np.ndarray) -> bytes:
    return zlib.compress(vector.astype("<i8").tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), "<i8")


def tree_sum(vectors: DataFrame) -> DataFrame:
    """(``shard``, ``vector``) from (``shard``, ``branch``, ``vector``), first by branches."""

    def add(batches):
        current, total = None, None
        for key, rows in runs(batches, 2):
            if key != current:
                if current is not None:
                    yield vector_row(*current, total)
                current, total = key, 0
            for (vector,) in rows:
                total = total + unpack(vector)
        if current is not None:
            yield vector_row(*current, total)

    for branch in (F.col("branch"), F.lit(0)):
        vectors = vectors.select("shard", branch.alias("branch"), "vector")
        vectors = vectors.repartition("shard", "branch").sortWithinPartitions("shard", "branch").mapInArrow(add, VECTORS)
    return vectors.select("shard", "vector")


def align(docs: DataFrame, path_a: str, path_b: str, *, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A is a byte-level tokenizer file that encodes a space and the text, and B a sentencepiece file that puts the
    space there itself; every executor has both. A pair's count is the number of rows of ``docs`` that
    link it. ``n_best`` are the links whose count is the highest of their A id, ties included.

    A null or empty text, and one whose tokens do not give its bytes back, has no tokens: zeros and
    an empty digest; it counts for no pair. Rows that repeat count each time. Null ids need no care,
    and an empty table gives an empty result. Other columns are not looked at.

    Up to ``broadcast_pairs`` distinct pairs the table of counts is sent to all tasks. Beyond that
    nothing whole is: the pairs of the texts are sent to the shards of the table, a third of a
    shard's work at most lying in one task, and their sums come back.
    """
    spark = docs.sparkSession
    blocks = saved(linked_blocks(docs.select(F.col("text").cast("string")), path_a, path_b), "linked")

    def distinct_pairs(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(batch.column(0)[i].as_buffer(), np.int64))], ["key"])

    keys, n_pairs = saved_rows(blocks.select("some").mapInArrow(distinct_pairs, "key long").distinct(), "link_pairs")
    width = tokens_of(path_a, path_b).width
    shards = max(1, -(-n_pairs // SHARD_PAIRS))
    index = saved(hashed(keys, width, shards), "link_hash")
    if n_pairs <= broadcast_pairs:
        vectors = counted_at_blocks(blocks, index, width)
    else:
        vectors = counted_at_shards(blocks, index, width, shards)
    table = saved(with_best(index, tree_sum(vectors), width), "link_counts")
    if n_pairs <= broadcast_pairs:
        return looked_up_at_texts(spark, docs, table, path_a, path_b, width)
    return looked_up_at_shards(docs, table, path_a, path_b, width, shards)


def linked_blocks(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(``some``, ``times``): the distinct pairs of a step of texts, and how many of its texts link each."""

    def run(batches):
        aligner = Aligner(tokens_of(path_a, path_b), written=False)
        for batch in batches:
            bodies = batch.column(0).to_pylist()
            for a, b in steps(bodies):
                keys, times = aligner.counted(aligner.documents(bodies[a:b])[1])
                if len(keys):
                    columns = [pa.array([keys.tobytes()], pa.binary()), pa.array([times.astype("<i4").tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["some", "times"])

    return texts.mapInArrow(run, "some binary, times binary")


def collected(table: DataFrame) -> list[dict]:
    """The rows of a table whose size has been checked, by shard."""
    return [r.asDict() for r in table.orderBy("shard").collect()]


def pairs_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        some, times = (batch.column(c)[i].as_buffer() for c in ("some", "times"))
        yield np.frombuffer(some, np.uint64), np.frombuffer(times, "<i4")


def counted_at_blocks(blocks: DataFrame, index: DataFrame, width: int) -> DataFrame:
    """(``shard``, ``branch``, ``vector``): for each task and shard the documents of each pair."""
    sent = blocks.sparkSession.sparkContext.broadcast(collected(index))

    def count(batches):
        shards = Shards(sent.value, width)
        vectors = [np.zeros(len(h.keys), np.int64) for h in shards.hashes]
        for batch in batches:
            for keys, times in pairs_of(batch):
                for s, at, slots in shards.slots(keys):
                    vectors[s][known_slots(slots)] += times[at]
        branch = TaskContext.get().partitionId() % 32
        for s, vector in enumerate(vectors):
            if vector.any():
                yield vector_row(s, branch, vector)

    return blocks.mapInArrow(count, VECTORS)


VECTORS = "shard int, branch int, vector binary"


def vector_row(shard: int, branch: int, vector: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([shard], pa.int32()), pa.array([branch], pa.int32()), pa.array([pack(vector)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "branch", "vector"])


def known_slots(slots: np.ndarray) -> np.ndarray:
    if len(slots) and slots.min() < 0:
        raise ValueError("a pair is not in the table: the texts changed between two passes")
    return slots


def branches(df: DataFrame, shards: int) -> int:
    """Parts of each shard's work, so that all tasks have some."""
    return max(3, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)


def at_shards(rows: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """``rows`` (``shard``, ``branch``, ...) behind the row of their shard in ``table``, one task for each branch."""
    copies = table.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("first", F.lit(True))
    both = copies.unionByName(rows.withColumn("first", F.lit(False)), allowMissingColumns=True)
    return both.repartition("shard", "branch").sortWithinPartitions("shard", "branch", F.desc("first"))


def counted_at_shards(blocks: DataFrame, index: DataFrame, width: int, shards: int) -> DataFrame:
    """As ``counted_at_blocks``, with the pairs of each block sent to their shards."""
    n = branches(blocks, shards)

    def ship(batches):
        for batch in batches:
            for keys, times in pairs_of(batch):
                shard = shard_of(keys, width, shards)
                out = []
                for s in np.unique(shard).tolist():
                    part = shard == s
                    out.append((s, zlib.crc32(keys[part].tobytes()) % n, keys[part].tobytes(), times[part].tobytes()))
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["shard", "branch", "some", "times"]
                )

    rows = blocks.mapInArrow(ship, "shard int, branch int, some binary, times binary")

    def count(batches):
        current = found = vector = None
        for key, held in runs(batches, 2):
            for sizes, words, keys, some, times in held:
                if sizes is not None:
                    if current is not None and vector.any():
                        yield vector_row(*current, vector)
                    current, found = key, PerfectHash.of(sizes, words, keys)
                    vector = np.zeros(len(found.keys), np.int64)
                else:
                    vector[known_slots(found.slots(np.frombuffer(some, np.uint64)))] += np.frombuffer(times, "<i4")
        if current is not None and vector.any():
            yield vector_row(*current, vector)

    ordered = at_shards(rows, index, n).select("shard", "branch", "sizes", "words", "keys", "some", "times")
    return ordered.mapInArrow(count, VECTORS)


def with_best(index: DataFrame, sums: DataFrame, width: int) -> DataFrame:
    """The hash of each shard with ``counts`` by slot, and whether each is the ``best`` of its A id."""

    def run(batches):
        for batch in batches:
            for shard, sizes, words, keys, vector in zip(*(c.to_pylist() for c in batch.columns)):
                counts = unpack(vector)
                best = best_pairs(np.frombuffer(keys, np.uint64), counts, width)
                values = [sizes, words, keys, counts.astype(np.int64).tobytes(), best.tobytes()]
                columns = [pa.array([shard], pa.int32()), *[pa.array([v], pa.binary()) for v in values]]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "sizes", "words", "keys", "counts", "best"])

    both = index.join(sums.hint("shuffle_hash"), "shard").select("shard", "sizes", "words", "keys", "vector")
    return both.mapInArrow(run, f"{HASH}, counts binary, best binary")


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def looked_up_at_texts(spark, docs: DataFrame, table: DataFrame, path_a: str, path_b: str, width: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(collected(table))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        aligner = Aligner(tokens_of(path_a, path_b), Shards(sent.value, width).look_up)
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            for a, b in steps(bodies):
                sums, documents = aligner.documents(bodies[a:b])
                digests = pa.array(map(aligner.digest, documents), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *[pa.array(sums[:, i]) for i in range(1, 7)], digests],
                    ["doc_id", *COLUMNS, "groups_sha256"],
                )

    counts = ", ".join(f"{c} long" for c in COLUMNS)
    schema = f"doc_id {kind}, {counts}, groups_sha256 string"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def looked_up_at_shards(docs: DataFrame, table: DataFrame, path_a: str, path_b: str, width: int, shards: int) -> DataFrame:
    n = branches(docs, shards)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        aligner = Aligner(tokens_of(path_a, path_b))
        for batch in batches:
            bodies = batch.column(2).to_pylist()
            for a, b in steps(bodies):
                parts = []
                sums, documents = aligner.documents(bodies[a:b])
                for places in documents:
                    keys, times = aligner.linked(places)
                    shard = shard_of(keys, width, shards)
                    parts.append([
                        {"shard": s, "some": keys[shard == s].tobytes(), "times": times[shard == s].tobytes()}
                        for s in np.unique(shard).tolist()
                    ])
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(a, b - a) for i in (0, 1)],
                        *[pa.array(sums[:, i]) for i in range(1, 5)],
                        pa.array(map(aligner.digest, documents), pa.string()),
                        pa.array(parts, pa.list_(pa.struct([("shard", pa.int32()), ("some", pa.binary()), ("times", pa.binary())]))),
                    ],
                    ["place", "doc_id", *COLUMNS[:4], "groups_sha256", "parts"],
                )

    counts = ", ".join(f"{c} long" for c in COLUMNS[:4])
    schema = f"place long, doc_id {kind}, {counts}, groups_sha256 string, parts array<struct<shard: int, some: binary, times: binary>>"
    numbered = docs.select(F.monotonically_increasing_id().alias("place"), "doc_id", F.col("text").cast("string"))
    aligned = saved(numbered.mapInArrow(run, schema), "aligned")
    rows = aligned.select("place", F.explode("parts").alias("p")).select(
        "p.shard", F.pmod(F.xxhash64("place"), F.lit(n)).cast("int").alias("branch"), "place", "p.some", "p.times"
    )

    def look_up(batches):
        found = counts = best = None
        for _, held in runs(batches, 2):
            out = []
            for sizes, words, keys, numbers, marks, place, some, times in held:
                if sizes is not None:
                    found = PerfectHash.of(sizes, words, keys)
                    counts, best = np.frombuffer(numbers, np.int64), np.frombuffer(marks, bool)
                else:
                    slots, weight = found.slots(np.frombuffer(some, np.uint64)), np.frombuffer(times, np.int64)
                    out.append((place, int(checked(best, slots) @ weight), int(checked(counts, slots) @ weight)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["place", *COLUMNS[4:]])

    ordered = at_shards(rows, table, n).select(
        "shard", "branch", "sizes", "words", "keys", "counts", "best", "place", "some", "times"
    )
    sums = ordered.mapInArrow(look_up, "place long, n_best long, count_sum long")
    sums = sums.groupBy("place").agg(*[F.sum(c).alias(c) for c in COLUMNS[4:]])
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in COLUMNS[4:]]
    return aligned.drop("parts").join(sums, "place", "left").select("doc_id", *COLUMNS[:4], *zero, "groups_sha256")
