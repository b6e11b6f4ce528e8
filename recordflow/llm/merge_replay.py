"""Byte-level BPE: merges replayed in rank order over all distinct words of a block of the corpus.

The words of a block are laid end to end as one array of tokens. An inverted index maps the rank of
a token pair to the positions at which the pair stands; ranks are taken in ascending order, all
positions of a rank are merged at once, and only the pairs of the touched neighbours are looked up
again. Words seen in earlier blocks are not replayed. A block is a bounded number of characters of
one task's documents: words of the whole corpus at once would have to be shuffled back to each of
their occurrences, which moves more bytes than the corpus has.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

#: Characters of text in a block, and characters of cached words a worker holds between blocks.
BLOCK_CHARS = 8_000_000
CACHE_CHARS = 5_000_000
#: Tokens in an output batch, at which it is handed on; one document may be longer.
BATCH_TOKENS = 500_000
#: The pattern's matches never reach over a space that a letter, digit or underscore follows.
WORD_START = re.compile(r" (?=\w)")
HEAD = "\0"
SHIFT = 20


class Merges:
    """The merge table of a vocabulary and the replay over words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[(left << SHIFT) | right] = rank
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.key_ranks = np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[order], np.int32(-1))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge; -1 where there is none or a side is -1."""
        key = (left.astype(np.int64) << SHIFT) | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.key_ranks[at], np.int32(-1))

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The token ids of each word, as the bytes of 32-bit integers."""
        if not words:
            return []
        tok = np.append(self.byte_ids[np.frombuffer(b"".join(words), np.uint8)], np.int32(-1))
        n = len(tok) - 1  # stands for "no neighbour"
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        starts = np.concatenate(([0], ends[:-1]))
        nxt = np.arange(1, n + 2, dtype=np.int32)
        prv = np.arange(-1, n, dtype=np.int32)
        nxt[ends - 1] = n
        prv[starts] = n
        nxt[n] = n
        alive = np.ones(n + 1, bool)
        rank_at = self.pair_ranks(tok, tok[nxt])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def post(where: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            where, ranks = where[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            firsts = ranks[np.concatenate(([0], cuts))].tolist() if len(ranks) else []
            for r, part in zip(firsts, np.split(where, cuts)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        mergeable = np.flatnonzero(rank_at >= 0)
        post(mergeable.astype(np.int32), rank_at[mergeable])
        again = []  # positions in words that gained a pair of a lower rank than the one being merged
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            pos = parts[0] if len(parts) == 1 else np.concatenate(parts)
            pos = pos[rank_at[pos] == r]
            if len(parts) > 1:
                pos = np.unique(pos)
            if not len(pos):
                continue
            clash = nxt[pos[:-1]] == pos[1:]
            if clash.any():  # a pair that overlaps the one before it: every second of a row of them
                i = np.arange(len(pos))
                row = np.maximum.accumulate(np.where(np.concatenate(([False], clash)), 0, i))
                pos = pos[(i - row) % 2 == 0]
            gone = nxt[pos]
            after = nxt[gone]
            tok[pos] = r
            nxt[pos] = after
            prv[after] = pos
            alive[gone] = False
            rank_at[gone] = -1
            touched = np.concatenate((pos, prv[pos]))
            ranks = self.pair_ranks(tok[touched], tok[nxt[touched]])
            rank_at[touched] = ranks
            found = ranks >= 0
            if found.any():
                touched, ranks = touched[found], ranks[found]
                if ranks.min() < r:
                    again.append(touched[ranks < r])
                post(touched, ranks)
        alive[n] = False
        kept = np.concatenate(([0], np.cumsum(alive[:n])))
        ids = tok[:n][alive[:n]].tobytes()
        out = [ids[a:b] for a, b in zip((4 * kept[starts]).tolist(), (4 * kept[ends]).tolist())]
        if again:
            for w in np.unique(np.searchsorted(ends, np.concatenate(again), side="right")).tolist():
                out[w] = np.array(self.one_by_one(words[w]), np.int32).tobytes()
        return out

    def one_by_one(self, word: bytes) -> list[int]:
        """The rule itself: merge the leftmost pair of the lowest rank until there is none."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, len(self.ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]


class Encoder:
    """Encodes documents in blocks, with the words of earlier blocks at hand."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merges = Merges(ranks)
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.known_chars = 0

    def learn(self, words: list[str]) -> None:
        """Add words as ``words`` gives them."""
        pieces: list[str] = []
        ends = []
        for word in words:
            pieces += self.pattern.findall(word[1:] if word[0] == HEAD else " " + word)
            ends.append(len(pieces))
        distinct = list(set(pieces))
        ids = dict(zip(distinct, self.merges.replay([p.encode() for p in distinct])))
        start = 0
        for word, end in zip(words, ends):
            self.known[word] = b"".join(map(ids.__getitem__, pieces[start:end]))
            start = end
        self.known_chars += sum(map(len, words))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text of a block."""
        if self.known_chars > CACHE_CHARS:
            self.known.clear()
            self.known_chars = 0
        missing: set[str] = set()
        for text in texts:
            missing.update(self.words(text))
        self.learn([w for w in missing if w not in self.known])
        for text in texts:
            yield np.frombuffer(b"".join(map(self.known.__getitem__, self.words(text))), np.int32)

    @staticmethod
    def words(text: str) -> list[str]:
        """The text cut before each word's space, which is left out; the head, which has none, is marked."""
        words = WORD_START.split(text)
        words[0] = HEAD + words[0]
        return words


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def blocks(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of successive rows; a null text is empty."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= block_chars:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, path: str, pattern: str, *, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(``doc_id``, ``ids`` array of int) for every row of ``docs`` (``doc_id``, ``text``).

    ``path`` names a file of base64 tokens and ranks that every executor has, and ``pattern`` splits
    a text. A null or empty text has no ids; rows that repeat or have a null id are encoded like any
    other; an empty table gives an empty result. Other columns are not looked at.
    """
    schema = docs.select("doc_id").schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches):
        with_words = encoder(path, pattern)
        for ids, texts in blocks(batches, block_chars):
            out_ids, out, size = [], [], 0
            for doc_id, tokens in zip(ids, with_words.encode(texts)):
                out_ids.append(doc_id)
                out.append(tokens)
                size += len(tokens)
                if size >= BATCH_TOKENS:
                    yield list_batch(out_ids, out)
                    out_ids, out, size = [], [], 0
            if out_ids:
                yield list_batch(out_ids, out)

    def list_batch(out_ids, out):
        ends = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out)))
        return pa.RecordBatch.from_arrays([pa.array(out_ids, id_type), lists], ["doc_id", "ids"])

    id_type = arrow_type(docs, "doc_id")
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes end to end, by id, with the start and length of each."""
    with open(path, "rb") as lines:
        tokens = dict((int(b), base64.b64decode(a)) for a, b in map(bytes.split, lines))
    lengths = np.zeros(max(tokens) + 1, np.int64)
    for i, t in tokens.items():
        lengths[i] = len(t)
    flat = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)
    return flat, np.cumsum(lengths) - lengths, lengths


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(``doc_id``, ``ids``, ``decoded`` binary): the bytes that the ids stand for, without loss.

    Null or empty ``ids`` decode to no bytes. The bytes need not be UTF-8 when the ids are not those
    of a whole text.
    """
    schema = encoded.select("doc_id", "ids").schema.add("decoded", "binary")

    def run(batches):
        flat, start, length = vocabulary(path)
        for batch in batches:
            lists = batch.column(1)
            for a in range(0, batch.num_rows, 256):
                part = lists.slice(a, 256)
                counts = np.array([len(x) if x is not None and x.is_valid else 0 for x in part], np.int64)
                ids = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = length[ids]
                done = np.cumsum(sizes)
                source = np.repeat(start[ids] - (done - sizes), sizes) + np.arange(done[-1] if len(done) else 0)
                edges = np.concatenate(([0], done))[np.concatenate(([0], np.cumsum(counts)))]
                data = pa.py_buffer(flat[source].tobytes())
                decoded = pa.Array.from_buffers(
                    pa.binary(), len(part), [None, pa.py_buffer(edges.astype(np.int32).tobytes()), data]
                )
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, 256), part, decoded], schema_names)

    schema_names = ["doc_id", "ids", "decoded"]
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)
