"""Top-k search and language-model scores against brute force."""

import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from messy import frame, prose, rows_of, texts, words_of

from fleetscope.llm import kdtree, pitman_yor, queries, tables

# ---- top-k ---------------------------------------------------------------------------------------


def brute_top(rows, k):
    """(query_id, rank, vec_id, score) with exact integers; rows are (vec_id, components)."""
    out = []
    for i, (q, a) in enumerate(rows):
        if q % 20 == 0:
            clip = lambda s: max(-(2**63), min(2**63 - 1, s))
            scores = [(clip(sum(x * y for x, y in zip(a, b))), v) for j, (v, b) in enumerate(rows) if j != i]
            best = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
            out += [(q, r, v, s) for r, (s, v) in enumerate(best, 1)]
    return sorted(out, key=repr)


def top(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id long, whole array<long>")
    got = kdtree.top_k(df, kdtree.F.col("vec_id") % 20 == 0, k)
    return rows_of(got, "query_id", "rank", "vec_id", "score")


@pytest.fixture
def small_trees(monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD", 60)
    monkeypatch.setattr(kdtree, "LEAF", 8)
    monkeypatch.setattr(kdtree, "BLOCK", 4)


def test_many_trees_and_blocks_with_ties(spark, small_trees):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 6).tolist()) for i in range(200)] + [(300 + i, [1, 1, 1, 1, 1, 1]) for i in range(100)]
    assert top(spark, rows) == brute_top(rows, 20)


def test_few_rows_shared_ids_and_huge_components(spark, small_trees):
    rows = [(0, [1, 2]), (0, [1, 2]), (5, [3]), (20, [])]
    assert top(spark, rows) == brute_top(rows, 20)
    huge = [(i, [2**40 * (-1) ** i, i - 7, 2**62]) for i in range(25)]
    assert top(spark, huge, 5) == brute_top(huge, 5)
    assert top(spark, []) == []


def test_given_vectors_and_those_that_take_no_part(spark, sf_dir, tmp_path):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    bad = [(900_000, None, 1), (900_020, [1.0, None], 1), (900_040, [float("nan")] * 64, 1), (900_060, [float("inf")] * 64, 1), (None, [0.1] * 64, 1)]
    given.unionByName(spark.createDataFrame(bad, given.schema)).write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = [(r["vec_id"], [math.floor(64 * float(x)) for x in r["embedding"]]) for r in given.collect()]
    got = queries.registered()["op7_top_k"](spark, str(tmp_path))
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == brute_top(rows, 20)


# ---- language model ------------------------------------------------------------------------------


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def brute_base(rows):
    tokens = [words_of(t) + [None] for _, t in rows]
    counts = Counter(w for (d, _), own in zip(rows, tokens) if not held_out(d) for w in own)
    n, v = counts.total(), len(counts)
    base = [sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own) for own in tokens]
    return sorted(
        ((d, held_out(d), len(own), sum(counts[w] > 0 for w in own), n, round(b, 6)) for (d, _), own, b in zip(rows, tokens, base)),
        key=repr,
    )


def checked(got):
    rows = got.collect()
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in rows)
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    return sorted(((*(r[c] for c in columns), round(r["base_score"], 6)) for r in rows), key=repr)


def test_scores_of_a_messy_table(spark):
    assert checked(pitman_yor.score(frame(spark))) == brute_base(texts())


def test_many_parts_and_frequent_words_change_nothing_but_the_draws(spark, monkeypatch):
    rows = [(i, prose(i, 120, 300)) for i in range(120)]
    monkeypatch.setattr(pitman_yor, "PART_TOKENS", 1500)
    some = pitman_yor.score(frame(spark, rows))
    assert checked(some) == brute_base(rows)
    again = pitman_yor.score(frame(spark, rows))
    assert rows_of(some, "doc_id", "score") == rows_of(again, "doc_id", "score")


def test_a_part_is_seated_and_summed_by_blocks(spark, monkeypatch):
    rows = [(i, prose(i, 150, 400)) for i in range(100)]
    whole = pitman_yor.score(frame(spark, rows))
    likely = sum(r["score"] for r in whole.collect())
    monkeypatch.setattr(pitman_yor, "BLOCK_PAIRS", 300)
    some = pitman_yor.score(frame(spark, rows))
    assert checked(some) == brute_base(rows)
    assert abs(sum(r["score"] for r in some.collect()) / likely - 1) < 0.01  # other draws of the same
    n = np.arange(1, 1001)
    load = (n.astype(np.uint64), np.full(1000, 7), np.tile(np.arange(7), 1000), np.ones(7000, dtype=np.uint32))
    cut = list(pitman_yor.blocks(pitman_yor.Model(np.zeros(0, np.uint64)), 0, pickle.dumps(load)))
    assert max(len(b.count) for b in cut) <= 300 and np.concatenate([b.words for b in cut]).tolist() == n.tolist()


def test_a_part_sends_its_sums_by_batch():
    rows = [(i, "same" if i else "other") for i in range(50)]
    batch = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows], "held": [False] * 50}).to_batches()[0]
    listed = []
    for part, load in pitman_yor._packed(batch, 7, 64, np.zeros(0, np.uint64)):
        merged = pitman_yor._merge(pitman_yor.pd.DataFrame({"part": [part] * 2, "load": [load] * 2}))
        entries, places = (pickle.loads(merged[c][0]) for c in ("entries", "places"))
        sums = list(pitman_yor.document_sums([np.ones(9)], entries, places))
        assert [first for first, _, _ in sums] == [7, 7] and all((t == v).all() for _, _, (t, v) in sums)
        listed.append(len(sums[0][1]))
    assert sorted(listed) == [1, 49, 50]


def test_large_rows_are_read_one_at_a_time(spark):
    rows = spark.range(6, numPartitions=1).selectExpr("id", "cast(repeat(sha2(cast(id as string), 512), 16384) as binary) as load")
    files = tables.stored(rows, "large-rows", "uncompressed", tables.ROW_BY_ROW).inputFiles()
    assert [pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups for f in files] == [6]


def test_nothing_to_learn_from(spark):
    rows = [(i, prose(i, 30)) for i in range(200) if held_out(i)]
    got = pitman_yor.score(frame(spark, rows)).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"]) for r in got} == {(0, 0, 0.0)}
    assert pitman_yor.score(frame(spark, [])).collect() == []


def test_held_out_texts_are_less_surprising_than_by_counts(spark, sf_dir):
    got = [r for r in queries.registered()["op8_language_model"](spark, sf_dir).collect() if r["held_out"]]
    n = sum(r["n_tokens"] for r in got)
    assert sum(r["score"] for r in got) / n > sum(r["base_score"] for r in got) / n


def test_tables_follow_their_conditional():
    seats = pitman_yor.Seating(0.5)
    n, opens = 20_000, 0.8
    weight = np.exp(seats.ways[6, 1:7]) * opens ** np.arange(1, 7)
    drawn = seats.draw(np.full(n, 6), np.full(n, opens), np.random.default_rng(1))
    share = np.bincount(drawn, minlength=7)[1:] / n
    assert np.abs(share - weight / weight.sum()).max() < 0.02
    # ways to seat by enumeration: two blocks of three customers
    assert np.isclose(np.exp(seats.ways[3, 2]), 3 * 0.5) and np.isclose(np.exp(seats.ways[3, 1]), 0.5 * 1.5)
    assert seats.draw(np.array([0, 1, 5000]), np.array([0.1, 9.0, 5.0]), np.random.default_rng(1)).tolist()[:2] == [0, 1]


def test_probabilities_add_up_to_one(monkeypatch):
    """Over the known words and the unknown one, for contexts with customers and one without."""
    monkeypatch.setattr(pitman_yor, "BURN_IN", 1)
    monkeypatch.setattr(pitman_yor, "SAMPLES", 1)
    tokens, context, _ = pitman_yor.token_stream(pa.array([prose(1, 200, 30)]))
    pairs = Counter(zip(tokens.tolist(), context.tolist()))
    known = sorted({w for w, _ in pairs})
    contexts = sorted({c for _, c in pairs} | {7})
    full = [(w, c) for w in sorted([*known, 1]) for c in contexts]  # 1: a word that never occurs
    firsts = np.array(sorted([*known, 1]), dtype=np.uint64)
    load = (firsts, np.full(len(firsts), len(contexts)), np.array([c for _, c in full]), np.array([pairs[p] for p in full]))
    model = pitman_yor.Model(np.zeros(0, np.uint64), tokens=len(tokens), vocabulary=len(known))
    model.context_customers = np.bincount(context, minlength=pitman_yor.CONTEXTS).astype(float)
    none = np.zeros(0, np.int64)
    for _ in range(3):
        for tables, _, own in pitman_yor.Part(model, 0, pickle.dumps(load)).run():
            if own is not None:
                model.states[-1].drawn_tables = float(own.sum())
        if len(model.states) < 2:
            by_context = np.bincount(load[2], tables, pitman_yor.CONTEXTS)
            model.states.append(pitman_yor.State(by_context, float(len(known)), none, none))
    log_p, _, _ = pitman_yor.Part(model, 0, pickle.dumps(load)).log_probabilities()
    for c in contexts:
        assert abs(sum(10**p for p, (_, own) in zip(log_p, full) if own == c) - 1) < 1e-9
