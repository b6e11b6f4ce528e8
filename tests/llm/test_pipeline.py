"""Each stage of the pipeline against brute force on its own input."""

import base64

import public_tokenizers
import pytest
import tiktoken
from test_search import brute_components

import corpus_pipeline
from recordflow.llm import stages, toxicity


@pytest.fixture(scope="module")
def steps(spark, small, tmp_path_factory):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, small).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_and_columns(steps):
    assert list(steps) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "byte_bpe"]
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.columns == before.columns, name
        rows = by_id(before)
        assert all(rows[r.doc_id] == r for r in after.collect()), name


def test_exact_dedup_keeps_the_lowest_of_each_text(steps):
    before, after = steps["exact_dedup"]
    lowest = {}
    for r in before.collect():
        lowest[r.text or ""] = min(r.doc_id, lowest.get(r.text or "", r.doc_id))
    assert sorted(by_id(after)) == sorted(lowest.values())


def test_near_dedup_keeps_one_of_each_group(steps):
    before, after = steps["near_dedup"]
    want = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(by_id(after)) == sorted(set(want.values()))


def test_toxicity_keeps_what_is_under_the_threshold(spark, steps, small):
    before, after = steps["toxicity"]
    labels = spark.read.parquet(f"{small}/labels.parquet")
    marks = toxicity.mark_toxic(before, labels).filter("predicted = 0")
    assert sorted(by_id(after)) == sorted(r.doc_id for r in marks.collect())


def test_last_stage_encodes_and_decodes(steps):
    before, after = steps["byte_bpe"]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = by_id(before)
    rows = after.collect()
    assert len(rows) == len(texts) > 0
    for r in rows:
        text = texts[r.doc_id].text or ""
        assert (r.ids, r.n_tokens, r.text) == (library.encode_ordinary(text), len(r.ids), text)


def test_run_gives_the_last_stage(spark, small, steps):
    assert sorted(by_id(corpus_pipeline.run(spark, small))) == sorted(by_id(steps["byte_bpe"][1]))


def test_stages_take_odd_and_empty_rows(spark, odd, empty, small):
    for name, stage in stages.STAGES:
        assert stage(spark, empty, small).count() == 0, name
        after = stage(spark, odd, small)
        assert after.count() > 0, name
        if name != "byte_bpe":
            assert after.columns == odd.columns and after.select("_key", "_toxicity").distinct().collect() == [("keep", 0.25)]
    once = stages.drop_copies(spark, odd, small).collect()
    assert len(once) == 8 and sum(r.doc_id == 6 for r in once) == 1
