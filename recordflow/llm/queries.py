"""The registered queries of the training-data operators, and their SQL where SQL can state them.

Each takes (spark, folder of tables), applies one operator to its whole table and returns all rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from recordflow.llm import alignment, filter_audit, kd_trees, merge_replay, raking, semi_markov, training_order
from recordflow.llm.content_sort import mark_copies
from recordflow.llm.digest_cache import count_tokens
from recordflow.llm.multi_index import mark_near_copies
from recordflow.llm.simhash import mark_fingerprints
from recordflow.llm.splitters import assign_shards
from recordflow.llm.toxicity import mark_toxic
from recordflow.session import scratch_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_semi_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the digest are of the base spans; ``spans`` has the added ones as well."""
    found = semi_markov.find(read(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, semi_markov.KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    both = F.transform(
        F.concat("base", "added"),
        lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("place"), s["start"], s["end"], s["kind"]),
    )
    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, semi_markov.KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(both)).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op2_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_trees.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_feistel_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shards are written and read again; one row per sequence, with a digest of its tokens."""
    layout = {"length": 1024, "per_shard": 8192}
    path = scratch_path(spark, "training_order")
    tokenizer = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read(spark, sf_dir, "documents")
    training_order.write(docs, path, tokenizer, public_tokenizers.PATTERN, stop=50256, key="epoch 0", **layout)
    rows = training_order.read(spark, path, **layout)
    return rows.select(*rows.columns[:-1], F.sha2("tokens", 256).alias("tokens_sha256"))


def op4_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = merge_replay.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return merge_replay.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_near_copies(read(spark, sf_dir, "documents"), width=2, percent=80)


def op6_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(read(spark, sf_dir, "documents"), keep="largest")


def op7_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache holds the texts of every tenth id from an earlier count; the others are encoded now."""
    tokenizer, cache = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "token_counts")
    docs = read(spark, sf_dir, "documents")
    count_tokens(docs.filter(F.col("doc_id") % 10 == 0), tokenizer, cache)
    return count_tokens(docs, tokenizer, cache)


def op8_levenshtein_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_toxic(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = raking.by_form(read(spark, sf_dir, "documents"), raking.SAMPLE, rounds=raking.ROUNDS)
    return mixed.select("doc.doc_id", *raking.POWERS, "n_tokens", "weight", "probability", "kept")


def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"), shards=40)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_fingerprints(read(spark, sf_dir, "documents"))


def op12_perfect_hash_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(read(spark, sf_dir, "documents"), *paths)


def op13_lehmer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


LLM_QUERIES = {f.__name__: f for f in (op1_semi_markov, op2_kd_trees, op3_feistel_order, op4_merge_replay, op5_multi_index, op6_content_sort, op7_digest_cache, op8_levenshtein_lexicon, op9_raking, op10_sampled_splitters, op11_simhash, op12_perfect_hash_alignment, op13_lehmer_audit)}

LLM_ORACLES = {
    "op2_kd_trees": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op9_raking": raking.oracle(),
    "op13_lehmer_audit": filter_audit.oracle(),
    "op5_multi_index": """
        WITH RECURSIVE lowered AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM lowered
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                WHEN len(w) = 1 THEN w
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
            FROM words
        ), shingles AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
        ), pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
                AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION
            SELECT r.doc_id, p.b FROM reached r JOIN pairs p ON p.a = r.other
        ), lowest AS (
            SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN lowest USING (doc_id)
    """,
    "op6_content_sort": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
