"""The five stages on given documents, each held to what it promises of its own input."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from test_duplicates import brute_components, brute_passages

from fleetscope.llm import bpe, mixing, quality

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def results(spark, sf_dir, tmp_path_factory):
    """What every stage got and returned, written and read again."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / "out")
        stage(spark, docs, sf_dir).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_all_but_the_last_keep_the_columns(results):
    for name, (before, after) in list(results.items())[:-1]:
        assert after.schema.names == before.schema.names, name


def test_rejected_documents_are_gone(results, spark, sf_dir):
    before, after = results["quality rules"]
    judged = quality.judge(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert sorted(pairs(after)) == sorted(pairs(judged.where("kept")))
    assert 0 < after.count() < before.count()


def test_one_of_each_group_stays(results):
    before, after = results["near-duplicates"]
    expected = {component for _, _, component in brute_components(pairs(before), 5)}
    assert sorted(d for d, _ in pairs(after)) == sorted(expected)


def test_no_long_passage_is_left_twice(results):
    _, after = results["repeated passages"]
    assert sum(map(len, brute_passages(pairs(after)).values())) <= 100


def test_documents_come_as_often_as_the_mix_says(results):
    before, after = results["source mix"]
    expected = {r["doc_id"]: r["copies"] for r in mixing.copies(before).collect() if r["copies"]}
    assert Counter(d for d, _ in pairs(after)) == expected


def test_ids_are_those_of_the_text(results):
    before, after = results["token ids"]
    tokens = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    expected = {d: plain.encode_ordinary(t or "") for d, t in pairs(before)}
    rows = after.collect()
    assert len(rows) == before.count()
    assert all(r["decodes"] and r["ids"] == expected[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in rows)
