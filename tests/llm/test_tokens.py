"""Byte-level BPE, the digest cache and training order against the libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from recordflow.llm import merge_replay, training_order
from recordflow.llm.digest_cache import count_tokens, counter

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "aaa", " ", "  ", "\n", "\t", "'s", "'ll", "'", "é", "7", "!?", "...", "_", "<|endoftext|>", "ab",
    " ", "\x1c", "日本", "x" * 50, "\r\n", "\x85", "᠎", "​", " ", "İ", "👩‍🚀",
]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return merge_replay.Encoder(RANKS, public_tokenizers.PATTERN)


def mixed_texts(n):
    rng = random.Random(3)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_ids_equal_the_library_on_mixed_texts(library, own):
    texts = mixed_texts(3000)
    assert [ids.tolist() for ids in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_ids_equal_the_library_on_all_characters(library, own):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"{c}{c}b {c}" for c in chars[i : i + 64]) for i in range(0, len(chars), 64)]
    assert all(library.encode_ordinary(t) == ids.tolist() for t, ids in zip(texts, own.encode(texts)))


def test_ids_equal_the_library_on_long_runs(library, own):
    texts = ["a" * 3001, " " * 1000, "ab" * 2000, "=" * 999, "aab" * 700 + "\n" * 77]
    assert [ids.tolist() for ids in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_one_by_one_is_the_same(own):
    words = [w.encode() for w in (" merging", " aaaaaaa", "日本", " 12345678", "x")]
    assert [np.frombuffer(b, np.int32).tolist() for b in own.merges.replay(words)] == [own.merges.one_by_one(w) for w in words]


def test_encode_and_decode_odd_rows(odd, empty, library):
    encoded = merge_replay.encode(odd, RANKS, public_tokenizers.PATTERN, block_chars=100)
    rows = merge_replay.decode(encoded, RANKS).collect()
    got = sorted((r.doc_id or -1, bytes(r.decoded), tuple(r.ids)) for r in rows)
    want = [(r.doc_id or -1, (r.text or "").encode(), tuple(library.encode_ordinary(r.text or ""))) for r in odd.collect()]
    assert got == sorted(want)
    assert merge_replay.decode(merge_replay.encode(empty, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_counts_equal_the_library():
    texts = mixed_texts(2000)
    library = Tokenizer.from_file(JSON)
    assert counter(JSON)(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_take_whole_texts(name):
    assert all(n > 0 for n in counter(public_tokenizers.path(name))(["One text.", "Two  texts"]))


def test_cache_is_used_and_extended(spark, odd, empty, tmp_path):
    cache = str(tmp_path / "counts")
    first = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(odd, JSON, cache).collect()}
    library = Tokenizer.from_file(JSON)
    want = set()
    for r in odd.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False))
        want.add((r.doc_id, len((r.text or "").encode()), n, n > 1024))
    assert first == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({r.text or "" for r in odd.collect()})  # each distinct text once
    more = odd.select("doc_id", "text").union(spark.createDataFrame([(50, "new text")], "doc_id long, text string"))
    assert count_tokens(more, JSON, cache).count() == odd.count() + 1
    assert spark.read.parquet(cache).count() == stored + 1
    assert count_tokens(empty, JSON, cache).count() == 0


def test_stored_counts_are_believed(spark, tmp_path):
    cache = str(tmp_path / "counts")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    version = hashlib.sha256(open(JSON, "rb").read()).hexdigest()
    digest = hashlib.sha256(b"a b c").digest()
    stored = spark.createDataFrame([(bytearray(digest), 77, version)], "digest binary, n_tokens long, tokenizer string")
    stored.write.partitionBy("tokenizer").parquet(cache)
    assert count_tokens(docs, JSON, cache).first().n_tokens == 77


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_one_to_one_and_can_be_undone(size):
    order = training_order.Permutation(size, "k")
    slots = order.slots(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size))
    assert order.numbers(slots).tolist() == list(range(size))
    if size >= 64:
        assert slots.tolist() != training_order.Permutation(size, "other").slots(np.arange(size)).tolist()


def test_training_order_keeps_every_token(spark, odd, empty, library, tmp_path):
    layout = {"length": 32, "per_shard": 100}
    path = str(tmp_path / "order")
    docs = odd.select("doc_id", "text")
    n = training_order.write(docs, path, RANKS, public_tokenizers.PATTERN, stop=50256, key="k", **layout)
    rows = training_order.read(spark, path, **layout).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(n))
    assert all(r.offset == (r.slot % 100) * training_order.stride(32) and r.shard == r.slot // 100 for r in rows)
    order = training_order.Permutation(n, "k")
    numbers = order.numbers(np.arange(n))
    flow = np.concatenate([np.frombuffer(bytes(rows[s].tokens), "<u2")[: rows[s].n_tokens] for s in np.argsort(numbers)])
    docs_back = sorted(map(tuple, np.split(flow, np.flatnonzero(flow == 50256) + 1)))
    want = sorted([(*library.encode_ordinary(r.text or ""), 50256) for r in odd.collect()] + [()])
    assert docs_back == want
    later = training_order.read(spark, path, first=150, **layout)
    assert sorted(r.slot for r in later.collect()) == list(range(150, n))
    assert training_order.write(empty, path + "0", RANKS, public_tokenizers.PATTERN, stop=1, key="k", **layout) == 0
    assert training_order.read(spark, path + "0", **layout).count() == 0
