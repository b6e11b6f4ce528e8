"""Token counts by a digest cache: only texts whose digest is new to the tokenizer are encoded."""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from recordflow.operators.lookups import lookup, saved

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
#: Characters of counted words that a worker holds.
WORD_CHARS = 8_000_000
WORDS_AT_ONCE = 10_000
#: Characters between two hand-overs of results.
BLOCK_CHARS = 16_000_000
#: A byte-level pre-tokenizer never reaches over a space that a letter, digit or underscore follows.
WORD_START = re.compile(r" (?=\w)")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, *, limit: int = 1024) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_bytes``, ``n_tokens`` and
    ``over_limit``.

    ``tokenizer`` is a file every executor has: ``.json`` for tokenizers, ``.model`` for
    sentencepiece. ``cache`` is a folder in a shared store; counts that lie there under the digest of
    the text and of the tokenizer file are used, and those of other texts are encoded once per
    distinct text and appended. Two jobs may append the same count; a reader takes one.

    A null text counts as empty, with no tokens. Rows that repeat, null ids and an empty table need
    no care. Other columns are not looked at.
    """
    spark = docs.sparkSession
    version = hashlib.sha256(Path(tokenizer).read_bytes()).hexdigest()
    body = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", body.alias("body"), F.unhex(F.sha2(body, 256)).alias("digest"))
    rows = saved(
        texts.select("doc_id", "digest", F.octet_length("body").cast("long").alias("n_bytes")), "count_rows"
    )
    distinct = texts.groupBy("digest").agg(F.any_value("body").alias("body"))
    try:
        known = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        distinct = distinct.join(known.select("digest"), "digest", "left_anti")

    def run(batches):
        count = counter(tokenizer)
        for batch in batches:
            digests, bodies = batch.column(0), batch.column(1)
            start = size = 0
            block = []
            for i, body in enumerate(bodies):
                block.append(body.as_py())
                size += len(block[-1])
                if size >= BLOCK_CHARS or i + 1 == len(bodies):
                    numbers = pa.array(count(block), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [digests.slice(start, len(block)), numbers], ["digest", "n_tokens"]
                    )
                    start, size, block = i + 1, 0, []

    missed = distinct.mapInArrow(run, "digest binary, n_tokens long").withColumn("tokenizer", F.lit(version))
    missed.write.mode("append").partitionBy("tokenizer").parquet(cache)
    counts = (
        spark.read.schema(CACHE_SCHEMA)
        .parquet(cache)
        .filter(F.col("tokenizer") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    return lookup(rows, counts, ["digest"]).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


@lru_cache(maxsize=2)
def counter(path: str):
    """A function from a list of texts to their numbers of tokens, as the library gives them."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def whole(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    return by_words(tokenizer, whole) if splits_at_words(tokenizer) else whole


def splits_at_words(tokenizer) -> bool:
    """Whether a text's tokens are those of its words, each taken with the space before it."""
    split = tokenizer.pre_tokenizer
    return (
        tokenizer.normalizer is None
        and type(split).__name__ == "ByteLevel"
        and split.use_regex
        and not split.add_prefix_space
        and not any(t.lstrip or t.rstrip or " " in t.content for t in tokenizer.get_added_tokens_decoder().values())
    )


def by_words(tokenizer, whole):
    """Count each distinct word once and add up.

    New words go to the library many at a time, as one text. No token reaches over a word's end, so
    the tokens' lengths in bytes tell them apart again.
    """
    known: dict[str, int] = {}
    size = 0
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    vocabulary = tokenizer.get_vocab()
    lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        lengths[i] = len(token)  # a byte-level token has one character for each byte

    def together(words: list[str]) -> list[int]:
        spaced = [" " + w for w in words]
        ids = tokenizer.encode("".join(spaced), add_special_tokens=False).ids
        ends = np.cumsum([len(w.encode()) for w in spaced])
        tokens_before = np.searchsorted(np.cumsum(lengths[ids]), ends, side="right")
        return np.diff(tokens_before, prepend=0).tolist()

    def split(text: str) -> list[str]:
        words = WORD_START.split(text)
        words[0] = "\0" + words[0]  # the head has no space before it
        return words

    def count(texts: list[str]) -> list[int]:
        nonlocal size
        if size > WORD_CHARS:
            known.clear()
            size = 0
        missing: set[str] = set()
        for text in texts:
            missing.update(split(text))
        new = [w for w in missing if w not in known]
        apart = [w for w in new if w[0] == "\0"]
        if any(t in text for t in special for text in texts):
            apart += [w for w in new if w[0] != "\0" and any(t in w for t in special)]
        known.update(zip(apart, whole([w[1:] if w[0] == "\0" else " " + w for w in apart])))
        rest = [w for w in new if w not in known]
        for a in range(0, len(rest), WORDS_AT_ONCE):
            part = rest[a : a + WORDS_AT_ONCE]
            known.update(zip(part, together(part)))
        size += sum(map(len, new))
        return [sum(map(known.__getitem__, split(text))) for text in texts]

    return count
