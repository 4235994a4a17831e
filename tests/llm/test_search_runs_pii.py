"""Ranked search, periodic runs and personal data against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import duck, duck_rows, spark_rows
from messy import LOWER, SPACED, frame, prose, rows_of, texts

from fleetscope.llm import lexical, pii, queries, runs

# ---- ranked search ---------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def ranked(docs, asked, k):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in asked:
        found = []
        for d, c in held:
            m = 100 - 50 + (50 * c.total() * n) // total
            score = 0
            for t in set(terms_of(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, tmp_path, docs, asked, k):
    path = str(tmp_path / "index")
    lexical.build(docs, path)
    return rows_of(lexical.search(spark, path, asked, k), "item_id", "rank", "id", "score")


def some_queries():
    own = [t for _, t in texts()]
    return [
        (1, own[0][:200]),
        (2, "same line HERE here"),
        (3, None),
        (4, " ... "),
        (5, own[14]),  # the very long text
        (None, "w1 w2 w3"),
        (6, "漢字 spaces Ärger"),
        (7, "nowhere"),
    ]


ASKED = "item_id long, text string, rank int, score long, q long, key string, terms string"


@pytest.mark.parametrize("segment, window, k", [(8 << 20, 128, 3), (2000, 2, 3), (2000, 2, 100), (1, 128, 2)])
def test_search_equals_brute_force(spark, tmp_path, monkeypatch, segment, window, k):
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(lexical, "WINDOW", window)
    asked = spark.createDataFrame([(*q, 7, 7, 7, "x", "y") for q in some_queries()], ASKED)
    found = searched(spark, tmp_path, frame(spark), asked, k)
    assert found == ranked([(d, t) for d, t in texts()], some_queries(), k)


def test_search_in_blocks_of_few_terms(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", 20_000)
    docs = [(i, prose(i, 120, vocabulary=300)) for i in range(200)]
    asked = [(i, prose(1000 + i, 30, vocabulary=300)) for i in range(12)]
    found = searched(spark, tmp_path, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string"), 10)
    assert found == ranked(docs, asked, 10)


def test_search_of_nothing(spark, tmp_path):
    docs, asked = frame(spark), spark.createDataFrame(some_queries(), "item_id long, text string")
    assert searched(spark, tmp_path / "a", docs.limit(0), asked, 5) == []
    assert searched(spark, tmp_path / "b", docs, asked.limit(0), 5) == []
    assert searched(spark, tmp_path / "c", docs.where("text = '' or text is null"), asked, 5) == []


def test_search_equals_sql(spark, sf_dir):
    found = spark_rows(queries.registered()["op11_ranked_search"](spark, sf_dir))
    assert found == duck_rows(duck(sf_dir), queries.oracles()["op11_ranked_search"])


# ---- periodic runs ---------------------------------------------------------------------------------


def brute_runs(w, least=6, times=4):
    n, out = len(w), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q):
                s = w[i : i + size]
                if not any(all(s[k] == s[k + p] for k in range(size - p)) for p in range(1, q)):
                    out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for start, size, q in found for i in range(start + q, start + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def some_words(rng):
    kinds, n = rng.choice([1, 2, 2, 3, 4]), rng.randint(0, 60)
    w = [rng.randrange(kinds) for _ in range(n)]
    if n > 4 and rng.random() < 0.6:
        stretch = [rng.randrange(kinds) for _ in range(rng.randint(1, 9))]
        at = rng.randrange(n)
        w = w[:at] + (stretch * 60)[: n - at]
        if rng.random() < 0.5:
            w[rng.randrange(n)] = 9
    return w


@pytest.mark.parametrize("least, times", [(6, 4), (4, 2), (2, 2), (9, 3), (1, 2)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(least * 10 + times)
    for _ in range(1500):
        w = some_words(rng)
        assert runs.runs_of(np.array(w, dtype=np.int64), least, times) == brute_runs(w, least, times), w


@pytest.mark.parametrize("own", [["x"] * 3000, [str(i) for i in range(500)] * 5, ["a", "b"] * 1000 + ["a"]])
def test_long_runs(own):
    found, left = runs.analyse(" ".join(own))
    period = len(set(own))
    assert found == [(0, len(own), period)] and left == " ".join(own[:period])


def test_runs_of_a_messy_table(spark):
    docs = frame(spark).withColumnsRenamed({"h": "runs", "ids": "collapsed"})
    found = runs.find(docs)
    assert set(found.columns) == set(docs.columns) - {"text"}
    got = rows_of(found.selectExpr("doc_id", "collapsed", "to_json(runs) as j"), "doc_id", "collapsed", "j")
    expected = []
    for d, text in texts():
        w = SPACED.findall(text or "")
        own = brute_runs(w) if len(w) < 1000 else []
        listed = "[" + ",".join('{"start":%d,"length":%d,"period":%d}' % r for r in own) + "]"
        expected.append((d, collapsed(w, own), listed))
    assert got == sorted(expected, key=repr)
    assert runs.find(docs.limit(0)).count() == 0


def test_runs_of_given_documents(spark, sf_dir):
    got = {r["doc_id"]: tuple(r) for r in queries.registered()["op12_periodic_runs"](spark, sf_dir).collect()}
    with_runs = 0
    for d, text in duck(sf_dir).execute("select doc_id, text from documents").fetchall():
        w = SPACED.findall(text or "")
        if len(w) > 1500:
            continue
        h = zlib.crc32(str(d).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        own = brute_runs(w)
        top = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None, None, None)
        with_runs += bool(own)
        lines = "".join("%d,%d,%d\n" % r for r in own)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[d] == (d, len(own), *top, 1000 * top[1] // top[2] if own else None, sha(lines), sha(collapsed(w, own)))
    assert with_runs > 10


# ---- personal data ---------------------------------------------------------------------------------

RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
}


def digits(match):
    return re.sub("[^0-9]", "", match)


def luhn(number):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    return [(k, m.start(), m.end()) for k, (p, good) in RULES.items() for m in re.finditer(p, text or "") if good(m[0])]


TRICKY = [
    "a@b.c-d_x@y.z, a@b@c.d; x@y. .@-.- a@b..c %@1.2.3@4.5",
    "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3.0000255 0.0.0.0 01.02.03.04.9 1..2.3.4.5",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111 11111111 4111111111111111-0 4111  1111 1111 1111 1111",
    "x4111111111111111y 4111111111111112 -4111 1111-11111111 6304000000000000000 63040000000000000000",
    "+1 (319) 555-5132 +1-2 +49 30 1234567. +12345678901234567 ++1 234 56 78 +1 ((( +44(0)20-7946-0958)))",
    "😀 a@b.cd 漢字 10.0.0.1 + 4111111111111111 é+33 1 23 45 67 89",
    "." * 300 + "@" + "1." * 300 + "-" * 50,
    "1" * 3000 + " " + "a" * 3000 + "@" + "1 2-" * 1000 + "+" * 100 + "+1" + "(" * 1000,
    " ".join(f"10.0.{i % 300}.{i % 256} u{i}@h{i}.org" for i in range(700)),  # more than a block of matches
]


def test_base_spans_of_tricky_texts(spark):
    rows = [*enumerate(TRICKY, 100), *texts()]
    docs = frame(spark, rows).withColumnsRenamed({"h": "spans", "key": "candidates"})
    found = pii.find(docs)
    assert set(found.columns) == set(docs.columns)
    got = rows_of(found.selectExpr("doc_id", "transform(filter(spans, s -> s.base), s -> struct(s.kind, s.start, s.end)) as b"), "doc_id", "b")
    got = [(d, [tuple(s) for s in b]) for d, b in got]
    assert sorted(got, key=repr) == sorted([(d, base_spans(t)) for d, t in rows], key=repr)
    assert pii.find(docs.limit(0)).count() == 0
    assert rows_of(pii.find(docs.limit(0).unionAll(docs.where("text is null"))).selectExpr("size(spans) as n"), "n") == [(0,), (0,)]


def labelled_texts():
    """Texts with personal data of the kinds that no base rule has, and texts that only look like it."""
    rng = random.Random(5)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexed = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(32))
    good, bad = [], []
    for i in range(150):
        good.append(f"{prose(i, 8)} password = {hexed()} {prose(i + 1, 8)}")
        good.append(f"{prose(i, 8)} please call (2{number(2)}) 555-{number(4)} {prose(i + 1, 8)}")
        good.append(f"{prose(i, 8)} ssn 2{number(2)}-4{number(1)}-1{number(3)} {prose(i + 1, 8)}")
        bad.append(f"{prose(i, 8)} password = changeme1111111 {prose(i + 1, 8)}")
        bad.append(f"{prose(i, 8)} order 000-00-0000 {prose(i + 1, 8)}")
        bad.append(f"{prose(i, 8)} serial 0{number(2)}-000-0000 {prose(i + 1, 8)}")
        bad.append(prose(i, 20))
    return good, bad


def test_classifier_tells_data_from_its_likes(spark):
    good, bad = labelled_texts()
    rows = [(i, t) for i, t in enumerate(good + bad)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id"])
    hit = {r["doc_id"] for r in found.where("size(spans) > 0").collect()}
    assert len(hit & set(range(len(good)))) >= 0.95 * len(good)
    assert len(hit - set(range(len(good)))) <= 0.02 * len(bad)


def brute_em(seen):
    """The same expectation-maximisation over (kind, votes) -> count."""
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    post = {key: sigmoid(sum(key[1])) for key in seen}
    for round_ in range(pii.ROUNDS + 1):
        good = sum(n * post[k] for k, n in seen.items())
        bad = sum(n * (1 - post[k]) for k, n in seen.items())
        ratios = []
        for j in range(len(pii.LABELERS)):
            for vote in (-1, 0, 1):
                here = [k for k in seen if k[1][j] == vote]
                up = (sum(seen[k] * post[k] for k in here) + (1 if vote == 1 else 0.5)) / (good + 2)
                down = (sum(seen[k] * (1 - post[k]) for k in here) + (1 if vote == -1 else 0.5)) / (bad + 2)
                ratios.append(math.log(up / down))
        odds = []
        for kind in range(len(pii.KINDS)):
            here = [k for k in seen if k[0] == kind]
            odds.append(math.log((sum(seen[k] * post[k] for k in here) + 1) / (sum(seen[k] * (1 - post[k]) for k in here) + 1)))
        if round_ == pii.ROUNDS:
            return ratios, odds
        post = {k: sigmoid(odds[k[0]] + sum(ratios[3 * j + v + 1] for j, v in enumerate(k[1]))) for k in seen}


def test_reliabilities_equal_brute_force(spark):
    good, bad = labelled_texts()
    docs = spark.createDataFrame([(t,) for t in good + bad + TRICKY], "text string")
    found = pii.candidates(docs).cache()
    seen = Counter((c["kind"], tuple(c["votes"])) for r in found.collect() for c in r["candidates"])
    ratios, odds = brute_em(seen)
    got = pii.reliabilities(found).first()
    assert got["ratios"] == pytest.approx(ratios, abs=1e-9) and got["odds"] == pytest.approx(odds, abs=1e-9)
    found.unpersist()
