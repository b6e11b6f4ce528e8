"""Content sort, splitters and raking: whole results on odd rows, hot groups and empty tables."""

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from recordflow.llm import stages
from recordflow.llm.content_sort import mark_copies
from recordflow.llm.raking import SAMPLE, by_form, rake, tempered
from recordflow.llm.splitters import OVERHEAD, assign_shards


def test_copies_of_odd_rows(odd):
    rows = mark_copies(odd).collect()
    assert len(rows) == odd.count()
    kept = Counter((r.keep_id, r.text_sha256) for r in rows if r.kept)
    assert set(kept.values()) == {1}
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert by_id[2][0].keep_id == 1 and by_id[2][0].group_size == 2 and not by_id[2][0].kept
    assert by_id[4][0].keep_id == 3 and by_id[4][0].group_size == 3  # null and empty texts are equal
    assert sorted(r.kept for r in by_id[6]) == [False, True] and by_id[6][0].group_size == 2
    assert by_id[7][0].group_size == 1
    assert sorted(r.kept for r in by_id[None]) == [False, True]


def test_largest_id_and_normalised_text(spark):
    df = spark.createDataFrame([(1, "A"), (2, "a"), (3, "b")], "doc_id long, text string")
    rows = {r.doc_id: r for r in mark_copies(df, keep="largest", normalise=F.lower).collect()}
    assert (rows[1].keep_id, rows[1].kept, rows[2].kept, rows[3].kept) == (2, False, True, True)


def test_a_third_of_all_rows_in_one_group(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
    )
    rows = mark_copies(df).collect()
    hot = [r for r in rows if r.doc_id % 3 == 0]
    assert {(r.keep_id, r.group_size) for r in hot} == {(0, 1000)} and sum(r.kept for r in rows) == 2001


def test_copies_of_nothing(empty):
    assert mark_copies(empty).count() == 0


def sharded(df, shards):
    rows = assign_shards(df, shards).collect()
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows, sizes


def test_shards_of_odd_rows(odd):
    rows, _ = sharded(odd, 5)
    texts = Counter((r.doc_id, r.text) for r in odd.collect())
    want = Counter((i, len((t or "").encode()) + OVERHEAD, zlib.crc32((t or "").encode())) for i, t in texts.elements())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)} and {r.shard for r in rows} <= set(range(5))


def test_shards_are_near_equal(documents):
    rows, sizes = sharded(documents, 8)
    mean, most = sum(sizes.values()) / 8, max(r["size"] for r in rows)
    assert len(sizes) == 8 and all(abs(n - mean) <= most + 1 for n in sizes.values())


def test_shards_of_one_repeated_row(spark):
    df = spark.range(4000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    _, sizes = sharded(df, 8)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 40


def test_shards_of_nothing(empty):
    assert assign_shards(empty, 4).count() == 0


def test_raking_meets_the_targets(documents):
    sums = {"source": {f"src{i}": 1.0 for i in range(20)}, "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}}
    rows = rake(
        documents, {"source": F.col("source"), "lang": F.col("lang")}, F.octet_length("text"), sums
    ).select("source", "lang", "n_tokens", "weight").collect()
    total = sum(r.n_tokens for r in rows)
    # The last dimension is met as it was scaled last; the others as far as the rounds got.
    for lang, share in sums["lang"].items():
        got = sum(r.n_tokens * r.weight for r in rows if r.lang == lang) / total
        assert abs(got - share) < 0.001


def test_raking_odd_rows(odd, empty):
    rows = by_form(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.probability <= 1 and r.kept is not None for r in rows)
    assert {r.source for r in rows} == {"s0", "s1", "s2", "(none)"}
    assert by_form(empty).count() == 0


def test_a_rare_source_does_not_scale_the_others_down(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.col("id") % 2).alias("source"),
        F.when(F.col("id") % 5 == 0, "de").otherwise("en").alias("lang"),
        F.repeat(F.lit("word "), 80).alias("text"),
    )
    rare = spark.createDataFrame([(6000, "rare", "xx", "word " * 400)], docs.schema)

    def tokens(df, kept):
        return by_form(df, sample=SAMPLE).filter(kept).agg(F.sum("n_tokens")).first()[0]

    for df in (docs, docs.union(rare)):
        assert abs(tokens(df, "kept") / tokens(df, "true") - SAMPLE) < 0.02
    rows = by_form(docs.union(rare), sample=SAMPLE).select("source", "lang", "n_tokens", "probability", "kept").collect()
    assert all(r.kept and r.probability == 1 for r in rows if r.source == "rare")
    drawn = {}
    for r in rows:
        drawn[r.source] = drawn.get(r.source, 0.0) + r.n_tokens * r.probability
    assert abs(drawn["s0"] / drawn["s1"] - 1) < 0.001


def test_mixing_keeps_its_sample_next_to_a_rare_source(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "repeat('word ', 80) AS text")
    rare = spark.createDataFrame([(3000, "rare", "xx", "word " * 400)], docs.schema)
    assert stages.mix_sources(spark, docs.union(rare), "").count() > 0.6 * docs.count()


def test_powers_of_one_keep_everything(documents):
    rows = rake(documents, {"lang": F.col("lang")}, F.octet_length("text"), {"lang": tempered(1)}).collect()
    assert all(r.kept for r in rows)
