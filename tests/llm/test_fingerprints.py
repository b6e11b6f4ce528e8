"""SimHash fingerprints against a plain version, and the block tables against all pairs."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.llm import simhash


def brute(rows):
    """(doc_id, n_chars, digest, prints, likenesses) by one sort of all rows."""
    named = sorted([(i, t or "") for i, t in rows if i is not None], key=lambda r: -r[0])
    out = []
    for k, (i, text) in enumerate(named):
        after = named[(k + 1) % len(named)][1]
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        prints = [simhash.fingerprint(t) for t in (text, edited, after)]
        out.append((
            i, n, hashlib.sha256(edited.encode()).hexdigest(), prints[0].hex(), prints[1].hex(),
            simhash.likeness(*prints[:2]), simhash.likeness(prints[0], prints[2]),
        ))
    return out


def distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def brute_near(prints, radius):
    """For ids divisible by 20, the other rows within the radius."""
    out = {}
    for k, (i, p) in enumerate(prints):
        if i is not None and i % 20 == 0:
            near = sum(distance(p, q) <= radius for m, (_, q) in enumerate(prints) if m != k and int(q, 16))
            out[i] = near if int(p, 16) else 0
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_documents_equal_brute_force(spark, documents, partitions):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = simhash.mark_fingerprints(documents.repartition(partitions)).collect()
    assert sorted(tuple(r)[:7] for r in got) == sorted(brute(rows))
    near = brute_near([(r.doc_id, r.fingerprint) for r in got], simhash.RADIUS)
    assert {r.doc_id: r.n_near for r in got if r.n_near is not None} == near


def test_fingerprint_equals_a_plain_vote():
    text = "The cat sat on the mat, the cat sat; the dog did not. " * 3 + "日本語 x"
    words = re.findall(r"[ぁ-ヿ㐀-鿿]|\w+?(?![^\W぀-ヿ㐀-鿿])", text.lower())
    hashes, weights = simhash.terms(text)
    pairs = {(a, b) for a, b in zip(words, words[1:])}
    assert len(hashes) == len(pairs)
    votes = [0.0] * simhash.BITS
    for h, w in zip(hashes.tolist(), weights):
        raw = simhash.mix(np.array([h], np.uint64) ^ simhash.HALVES).tobytes()
        for i in range(simhash.BITS):
            votes[i] += w if raw[i // 8] >> (7 - i % 8) & 1 else -w
    want = bytes(sum((votes[8 * k + j] > 0) << (7 - j) for j in range(8)) for k in range(simhash.BITS // 8))
    assert simhash.fingerprint(text) == want


def test_likeness_follows_what_is_shared():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    for share in (0.0, 0.3, 0.6, 0.9):
        off = []
        for _ in range(30):
            a = rng.sample(words, 400)
            b = a[: int(400 * share)] + rng.sample(words, 400 - int(400 * share))
            off.append(simhash.likeness(*(simhash.fingerprint(" ".join(x)) for x in (a, b))) - share)
        assert abs(sum(off) / len(off)) < 0.1
    assert simhash.likeness(simhash.EMPTY, simhash.EMPTY) == 1.0
    assert math.isclose(simhash.likeness(bytes(16), bytes([255] * 16)), 0.0)


@pytest.mark.parametrize("block", [simhash.BLOCK, 8])
@pytest.mark.parametrize("radius", [1, 4, 9])
def test_block_tables_find_all_pairs(spark, monkeypatch, block, radius):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(radius)
    centres = [rng.getrandbits(128) for _ in range(6)]
    prints = []
    for i in range(300):
        x = rng.choice(centres) if i % 3 else rng.getrandbits(128)
        for _ in range(rng.randint(0, radius)):
            x ^= 1 << rng.randrange(128)
        prints.append((i, f"{x:032x}"))
    rows = [(i, *np.array([p[:16], p[16:]], object).tolist()) for i, p in prints]
    df = spark.createDataFrame(rows, "doc_id long, h string, l string").select(
        "doc_id", *[F.conv(c, 16, -10).cast("long").alias(n) for c, n in (("h", "high"), ("l", "low"))]
    )
    counts = simhash.near_counts(df, F.col("doc_id") % 20 == 0, radius)
    got = {r.doc_id: r.n_near - 1 for r in df.join(counts, ["high", "low"]).filter("doc_id % 20 = 0").collect()}
    assert got == brute_near(prints, radius)


def test_odd_rows(odd, empty, spark):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = simhash.mark_fingerprints(odd).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r)[:7] for r in got if r.doc_id is not None) == sorted(brute(rows))
    nameless = sorted((r.n_chars, r.near_next, r.n_near) for r in got if r.doc_id is None)
    assert nameless == [(0, None, None), (13, None, None)]
    assert simhash.mark_fingerprints(empty).count() == 0
    one = simhash.mark_fingerprints(spark.createDataFrame([(20, "a b c d")], "doc_id int, text string")).first()
    assert (one.doc_id, one.near_next, one.n_near) == (20, 1.0, 0)
