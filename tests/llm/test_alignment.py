"""Cross-tokenizer alignment against whole-text encoding by the libraries, and the perfect hash."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from recordflow.llm import alignment

PATHS = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def token_bytes(libraries, ids_a, ids_b):
    a, b = libraries
    letters = alignment.byte_letters()
    from_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    from_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    return from_a, from_b


def brute_groups(libraries, text):
    """[(ids of A, ids of B)] by one walk over the bytes, or none."""
    if not text:
        return []
    a, b = libraries
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    tokens = token_bytes(libraries, *ids)
    if any(b"".join(t) != (" " + text).encode() for t in tokens):
        return []
    out, place, ends = [], [0, 0], [0, 0]
    while place[0] < len(ids[0]) or place[1] < len(ids[1]):
        group = ([], [])
        while not group[0] or ends[0] != ends[1]:
            side = int(ends[1] < ends[0])
            if not group[0]:
                side = 0
            group[side].append(ids[side][place[side]])
            ends[side] += len(tokens[side][place[side]])
            place[side] += 1
        out.append(group)
    return out


def brute(libraries, rows):
    groups = [(i, brute_groups(libraries, t)) for i, t in rows]
    links = [(i, g, [(x, y) for a, b in g for x in a for y in b]) for i, g in groups]
    counts = Counter(pair for _, _, pairs in links for pair in set(pairs))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for i, g, pairs in links:
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(pairs),
            sum(counts[p] == highest[p[0]] for p in pairs), sum(counts[p] for p in pairs),
            hashlib.sha256(written.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=str)


def aligned(df, **options):
    return sorted((tuple(r) for r in alignment.align(df, *PATHS, **options).collect()), key=str)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_documents_equal_the_libraries(documents, libraries, monkeypatch, broadcast_pairs):
    monkeypatch.setattr(alignment, "SHARD_PAIRS", 700)
    assert aligned(documents, broadcast_pairs=broadcast_pairs) == brute(libraries, texts_of(documents))


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_odd_rows_equal_the_libraries(odd, empty, libraries, broadcast_pairs):
    got = aligned(odd, broadcast_pairs=broadcast_pairs)
    assert got == brute(libraries, texts_of(odd))
    assert (3, 0, 0, 0, 0, 0, 0, "") in got and (4, 0, 0, 0, 0, 0, 0, "") in got
    assert aligned(empty, broadcast_pairs=broadcast_pairs) == []


def test_chunks_are_aligned_like_whole_texts(libraries):
    rng = np.random.default_rng(3)
    alphabet = list("ab1_ '.-\n\t▁éあ́​\U0001f600") + ["  ", " a", "<s>", "<|endoftext|>", "'s ", " ▁"]
    texts = ["".join(rng.choice(alphabet, rng.integers(1, 30))) for _ in range(400)]
    for start in range(1, 0x30000, 128):  # every character between words and spaces
        some = [chr(c) for c in range(start, start + 128) if not 0xD800 <= c < 0xE000]
        texts += ["x".join(some), " ".join(some), " a ".join(some)]
    aligner = alignment.Aligner(alignment.tokens_of(*PATHS))
    for text, sums, places in zip(texts, *aligner.documents(texts)):
        groups = brute_groups(libraries, text)
        assert sums[1:4].tolist() == [sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups)], text
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        assert aligner.digest(places) == (hashlib.sha256(written.encode()).hexdigest() if groups else ""), text


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 5000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = rng.choice(2**40, n, replace=False).astype(np.uint64)
    built = alignment.PerfectHash.of(*alignment.PerfectHash.build(keys).parts())
    assert sorted(built.slots(keys).tolist()) == list(range(n))
    others = np.setdiff1d(rng.integers(0, 2**40, 3000).astype(np.uint64), keys)
    assert (built.slots(others) == -1).all()
    with pytest.raises(ValueError):
        alignment.PerfectHash.build(np.array([7, 7], np.uint64))


def test_workers_forget_chunks(documents, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 1000)
    monkeypatch.setattr(alignment, "STEP_CHARS", 3000)
    aligner = alignment.Aligner(alignment.tokens_of(*PATHS))
    for _, text in texts_of(documents)[:60]:
        sums, _ = aligner.documents([text])
        assert sums[0, 3] == len(brute_groups(libraries, text))
    assert aligner.chars < 1000 + 200_000
