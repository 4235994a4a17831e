"""Near duplicates and repeated passages against brute force."""

import glob
import itertools
import os
import random
import tempfile
import time

import numpy as np
import pytest
from messy import frame, prose, rows_of, texts, words_of
from pyspark.sql import functions as F

from fleetscope.llm import near, queries, substrings, tables


def shingle_set(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1 if w else 0))}


def brute_components(rows, k):
    """(doc_id, set size, least id reachable) of each row; rows are compared in all pairs."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and 100 * len(a & b) >= 80 * len(a | b):
            parent[find(j)] = find(i)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def chain(n):
    """Texts of which only neighbours are similar enough, and many unlike texts that share most words."""
    base = prose(20, 200).split()
    out, text = [], list(base)
    for step in range(n):
        out.append(" ".join(text))
        for i in range(7):
            text[(step * 7 + i) * 4 % 200] = f"n{step}_{i}"
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_components_like_brute_force(spark, k):
    rows = texts() + [(100 + i, t) for i, t in enumerate(chain(12))]
    got = near.with_least_id(near.classes(frame(spark, rows), k=k))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(rows, k)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_components_of_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.registered()["op3_near_duplicates"](spark, sf_dir)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(rows, 2)


def test_sketch_fills_all_coordinates_and_estimates():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [pool[:1000], pool[100:1100], pool[2000:2001], pool[2500:2503]]
    bounds = np.cumsum([0, *map(len, sets)])
    table = near.sketches(np.concatenate(sets), bounds)
    assert (table != near._EMPTY).all()
    assert abs((table[0] == table[1]).mean() - 900 / 1100) < 0.1
    assert not (table[0] == table[2]).any()


def test_parities_never_differ_in_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 6000, dtype=np.uint64)
    sets = [rng.choice(pool[: 200 * 2**i], size, replace=False) for i in range(5) for size in (0, 1, 90, 150)]
    sets += [pool[:147], pool[16:163], pool[:5000], pool[1000:6000]]
    bits = near.parities(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2):
        apart = sum(int(x).bit_count() for x in (bits[i] ^ bits[j]).view(np.uint64))
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))
        assert i >= 20 or (apart == 0) == (set(a.tolist()) == set(b.tolist()))
    assert sum(int(x).bit_count() for x in (bits[20] ^ bits[21]).view(np.uint64)) >= 28  # of 32


@pytest.mark.parametrize("edits", [8, 12])
def test_copies_of_one_text_that_are_hardly_alike(spark, edits):
    """Copies of one text that link with it or not, and hardly ever with each other."""
    rng = random.Random(edits)
    base = prose(31, 150).split()
    rows = []
    for i in range(150):
        text = list(base)
        for at in rng.sample(range(150), edits + i % 3):
            text[at] = rng.choice(base)
        rows.append((i, " ".join(text)))
    got = near.with_least_id(near.classes(frame(spark, rows), k=2))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(rows, 2)


def test_one_of_each_group_stays(spark):
    docs = frame(spark)
    kept = near.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = sorted([r["doc_id"] for r in kept.collect()], key=repr)
    # texts without words all stay; rows alike in id and text are one document, other copies too
    assert ids == sorted([1, 4, 5, 6, 7, 8, None, None, 9, 10, 11, 12, 13, 14, 14], key=repr)
    assert near.deduplicate(frame(spark, [])).collect() == []


def test_long_chains_get_one_name(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 300)], "a long, b long")
    named = dict(rows_of(near.components(links), "key", "component"))
    assert set(named.values()) == {0, 200} and len(named) == 63


# ---- passages ------------------------------------------------------------------------------------


def all_windows(values, least):
    """Every passage's window by definition: the widest range around its least value."""
    found = set()
    for i in range(len(values)):
        for j in range(i + least, len(values) + 1):
            c = i + int(np.argmin(values[i:j]))
            a, b = c, c + 1
            while a > 0 and values[a - 1] > values[c]:
                a -= 1
            while b < len(values) and values[b] >= values[c]:
                b += 1
            found.add((a, c, b))
    return found


def test_windows_cover_every_passage_once():
    rng = np.random.default_rng(2)
    values = (rng.integers(0, 40, 60) << 32).astype(np.uint64)  # with ties
    begin, place, end = substrings.compact_windows(values, np.array([0, 60]), 7)
    assert set(zip(begin.tolist(), place.tolist(), end.tolist())) == all_windows(values, 7)
    empty = substrings.compact_windows(values, np.array([0, 0, 3, 3]), 7)
    assert all(len(part) == 0 for part in empty)


def brute_passages(rows):
    """Words of each document that lie in a run of 50 words that a document before it has too."""
    seen, covered = {}, {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        w = words_of(t)
        runs = [tuple(w[i : i + 50]) for i in range(len(w) - 49)]
        for i, run in enumerate(runs):
            if seen.setdefault(run, (d, t)) != (d, t):
                covered.setdefault(d, set()).update(range(i, i + 50))
    return covered


def test_every_long_passage_is_found(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = given + [(10_000 + (d or 0), t) for d, t in texts() if d in (1, 2, 4, 5, 6, 7, 9, 11)]
    found = {}
    for r in substrings.passages(frame(spark, rows)).collect():
        found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
        assert r["end_word"] - r["start_word"] >= 50 and r["similarity"] >= 0.8 and r["match_id"] < r["doc_id"]
        one, two = (words_of(dict(rows)[r[c]]) for c in ("doc_id", "match_id"))
        a = shingle_set(" ".join(one[r["start_word"] : r["end_word"]]), 5)
        b = shingle_set(" ".join(two[r["match_start"] : r["match_end"]]), 5)
        assert abs(len(a & b) / len(a | b) - r["similarity"]) < 1e-9
    exact = brute_passages(rows)
    assert set(exact) <= set(found)
    total = sum(map(len, exact.values()))
    assert sum(len(exact[d] - found[d]) for d in exact) <= 0.01 * total
    copies = {d for d, t in rows if sum(t == other for _, other in rows) > 1}
    near_copies = set(found) - set(exact) - copies
    assert all(any(r[0] == d for r in rows) for d in near_copies)


def test_clean_documents_have_no_passages(spark):
    rows = [(i, prose(50 + i, 400, 100_000)) for i in range(20)]
    assert substrings.passages(frame(spark, rows)).collect() == []


def test_repeated_passages_are_cut_out(spark):
    docs = frame(spark)
    out = substrings.cut(docs)
    assert out.columns == docs.columns
    left = {r["doc_id"]: r for r in out.where("doc_id is not null").collect()}
    assert 2 not in left and left[1]["text"] == texts()[0][1]
    assert left[4]["text"] == texts()[4][1]
    assert words_of(left[5]["text"]) == words_of(prose(5, 200))
    assert left[5]["n_chars"] == len(left[5]["text"])
    assert left[6]["text"] is None and left[7]["text"] == "" and left[10]["text"] == texts()[13][1]
    assert substrings.cut(frame(spark, [])).collect() == []


def test_a_passage_in_very_many_documents_is_paired_with_the_first(spark):
    passage = prose(90, 70)
    rows = [(i, f"{prose(1000 + i, 60, 100_000)} {passage}") for i in range(300)]
    found = substrings.passages(frame(spark, rows).repartition(7))
    ids = [r["doc_id"] for r in found.collect()]
    assert sorted(set(ids)) == list(range(1, 300)) and len(ids) < 2 * 300


def test_a_short_part_in_an_earlier_document_hides_no_passage(spark):
    rows = []
    for i in range(30):  # the first has too little of the passage, the next two have all of it
        passage = prose(5000 + i, 60, 100_000).split()
        parts = [passage[8:52], passage, passage]
        around = [[prose(9000 + 10 * i + j + 5 * side, 70, 100_000) for side in (0, 1)] for j in range(3)]
        rows += [(10 * i + j, " ".join([a, *part, b])) for j, (part, (a, b)) in enumerate(zip(parts, around))]
    exact = brute_passages(rows)
    assert set(exact) == {10 * i + 2 for i in range(30)}
    for parts in (1, 9):  # in one batch, and in several
        found = {}
        for r in substrings.passages(frame(spark, rows).repartition(parts)).collect():
            found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
        assert all(own <= found.get(d, set()) for d, own in exact.items())


def test_partners_like_brute_force():
    """A window has a partner for every mask on which an earlier document's of its key agrees."""
    rng = np.random.default_rng(4)
    n = 300
    key, doc = np.sort(rng.integers(0, 12, n)), np.zeros(n, np.int64)
    for k in set(key.tolist()):
        doc[key == k] = np.sort(rng.integers(0, 9, (key == k).sum()))
    left, right = rng.integers(0, 70, n), rng.integers(20, 70, n)
    whole = rng.integers(0, 1 << 48, (2, 12, 2))
    before, after = (whole[side, key, rng.integers(0, 2, n)] ^ (1 << rng.integers(0, 48, n)) * (rng.random(n) < 0.5) for side in (0, 1))
    before, after = before & ((1 << np.minimum(left, 48)) - 1), after & ((1 << np.minimum(right, 48)) - 1)
    own, other, alike = substrings._partners(key, doc, left << 16 | right, before, after)
    chosen = {}
    for a, b, sure in zip(own.tolist(), other.tolist(), alike.tolist()):
        assert key[a] == key[b] and doc[b] < doc[a]
        if sure:
            chosen.setdefault(a, []).append(b)

    def agree(a, b, mask):
        l, r = mask.tolist()
        wide = all(l >> min(left[i], 48) == 0 and r >> min(right[i], 48) == 0 for i in (a, b))
        return wide and not (before[a] ^ before[b]) & l and not (after[a] ^ after[b]) & r

    for a in range(n):
        earlier = [b for b in range(n) if key[b] == key[a] and doc[b] < doc[a]]
        shared = lambda masks, rows: [m.tolist() for m in masks if any(agree(a, b, m) for b in rows)]  # noqa: E731, B023
        exact = shared(substrings.EXACT, earlier)
        assert exact == shared(substrings.EXACT, chosen.get(a, []))
        assert exact or shared(substrings.LOOSE, earlier) == shared(substrings.LOOSE, chosen.get(a, []))


def test_no_partner_hides_one_that_shares_more_stretches():
    """Three earlier windows agree in two stretches each, the fourth in all three of them."""
    rng = np.random.default_rng(5)
    stretch = (1 << 12) - 1
    own = rng.integers(0, 1 << 48, 2)
    shared = [(0, 1), (1, 2), (0, 2), (0, 1, 2), (0, 1, 2), (1, 2)]
    sides = [[~own[0] & ~sum(stretch << 12 * i for i in s) | own[0] & sum(stretch << 12 * i for i in s), ~own[1]] for s in shared]
    before, after = (np.array([*(s[side] for s in sides), own[side]]) & ((1 << 48) - 1) for side in (0, 1))
    n = len(before)
    a, b, alike = substrings._partners(np.zeros(n, np.int64), np.arange(n), np.full(n, 48 << 16 | 48), before, after)
    partners = {int(y) for x, y, sure in zip(a, b, alike) if x == n - 1 and sure}
    assert 3 in partners and not partners & {1, 2, 4, 5}


def test_partners_share_all_stretches_of_any_earlier_window():
    rng = np.random.default_rng(6)
    n = 240
    key, doc = np.sort(rng.integers(0, 8, n)), np.arange(n)
    left, right = rng.integers(0, 70, n), rng.integers(20, 70, n)
    whole, other = rng.integers(0, 1 << 48, (2, 8)), rng.integers(0, 1 << 48, (2, n))
    stretches = np.array([[sum(0xFFF << 12 * i for i in range(4) if rng.random() < 0.6) for _ in range(n)] for _ in range(2)])
    before, after = whole[:, key] & stretches | other & ~stretches
    before, after = before & ((1 << np.minimum(left, 48)) - 1), after & ((1 << np.minimum(right, 48)) - 1)
    own, partner, alike = substrings._partners(key, doc, left << 16 | right, before, after)
    chosen = {}
    for a, b in zip(own[alike].tolist(), partner[alike].tolist()):
        chosen.setdefault(a, []).append(b)

    def agree(a, b, mask):
        l, r = mask
        wide = all(l >> min(left[i], 48) == 0 and r >> min(right[i], 48) == 0 for i in (a, b))
        return wide and not (before[a] ^ before[b]) & l and not (after[a] ^ after[b]) & r

    common = lambda a, b: {i for i, m in enumerate(substrings.STRETCHES) if agree(a, b, m)}
    hidden = 0
    for a in range(n):
        if any(agree(a, b, m) for b in chosen.get(a, []) for m in substrings.EXACT.tolist()):
            continue
        for b in range(a):
            own = common(a, b) if key[a] == key[b] else set()
            if len(own) > 1:
                hidden += 1
                assert any(own <= common(a, u) for u in chosen[a])
    assert hidden > 100


def near_passages(n, seed):
    """(doc_id, text) in pairs: a passage of 50 to 56 words and a changed copy of a similarity just over 0.8."""
    rng, rows = random.Random(seed), []
    while len(rows) < 2 * n:
        passage = prose(rng.random(), rng.randint(50, 56), 100_000).split()
        changed, last = list(passage), None
        while True:
            at, kind = rng.randrange(len(changed)), rng.randrange(3)
            changed[at : at + (kind != 1)] = [f"x{rng.random()}"] if kind != 2 else []
            a, b = (shingle_set(" ".join(t), 5) for t in (passage, changed))
            similarity = len(a & b) / len(a | b)
            if similarity < 0.8:
                break
            if len(changed) >= 50:
                last = (similarity, " ".join(changed))
        if last and last[0] < 0.84:
            for text in (" ".join(passage), last[1]):
                rows.append((len(rows), f"{prose(rng.random(), 70, 100_000)} {text} {prose(rng.random(), 70, 100_000)}"))
    return rows


def test_near_passages_are_candidates(spark):
    n = 1000
    docs = frame(spark, near_passages(n, 7)).select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    met = {(r["doc"], r["doc2"]) for r in substrings.candidates(docs).collect()}
    assert [i for i in range(n) if (2 * i + 1, 2 * i) not in met] == []


def test_a_stored_table_leaves_no_shuffle_files(spark):
    folder = os.environ.get("SPARK_LOCAL_DIRS", spark.conf.get("spark.local.dir", tempfile.gettempdir()))
    files = lambda: set(glob.glob(f"{folder}/blockmgr-*/*/shuffle_*.data"))
    before, setting = files(), spark.conf.get(tables.FREE_SHUFFLES)
    table = tables.stored(spark.range(100_000).groupBy(F.col("id") % 1000).count(), "counts")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert files() - before == set() and spark.conf.get(tables.FREE_SHUFFLES) == setting
    assert table.agg(F.sum("count")).first()[0] == 100_000
