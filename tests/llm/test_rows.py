"""Quality rules, mixing, pages and licenses against SQL or brute force."""

import math
import random
import struct
from collections import Counter

import pytest
import xxhash
from compare import duck, duck_rows, spark_rows
from messy import SPACED, frame, prose, rows_of, texts, words_of

from fleetscope.llm import licenses, mixing, pages, quality, queries

# ---- quality -------------------------------------------------------------------------------------


def counts_of(text):
    text = text or ""
    w = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(runs)
    covered = {j for i, run in enumerate(runs) if often[run] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    n = len(w)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return (n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def hashed(data, seed=42):
    value = xxhash.xxh64_intdigest(data, seed & (2**64 - 1))
    return value - 2**64 if value >= 2**63 else value


def grams_of(text):
    own = [hashed(w.encode()) for w in SPACED.findall(text or "")]
    chained = lambda a, b: hashed(struct.pack("<q", b), hashed(struct.pack("<q", a)))
    pairs = [hashed(b"twice") if a == b else chained(a, b) for a, b in zip(own, own[1:])]
    return [g % quality.BUCKETS for g in own + pairs]


def brute_scores(rows, fits):
    raw, good = Counter(), Counter()
    for d, t in rows:
        raw.update(grams_of(t))
        if d in fits:
            good.update(grams_of(t))
    ratio = lambda b: math.log((good[b] + 1) / (good.total() + quality.BUCKETS) / ((raw[b] + 1) / (raw.total() + quality.BUCKETS)))
    return [sum(map(ratio, g)) / max(len(g), 1) for g in (grams_of(t) for _, t in rows)]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, None), (4, 1, 0), (5, 1, 0), (13, 0, 0), (14, 1, 1), (None, 1, 0), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_rules_of_a_messy_table(spark, labels):
    docs = frame(spark)
    got = quality.judge(docs, labels)
    assert [c for c in docs.columns if c not in got.columns] == []
    fits = {r["doc_id"] for r in quality.trusted_ids(labels).where("fits").collect()}
    assert fits and None not in fits and 14 not in fits
    expected = [(d, *counts_of(t), round(s, 9)) for (d, t), s in zip(texts(), brute_scores(texts(), fits))]
    columns = ["doc_id", *quality._COUNTS, "base_failed", "score"]
    rows = [tuple(round(r[c], 9) if c == "score" else r[c] for c in columns) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    assert all(not r["kept"] for r in got.where("base_failed").collect())


def test_without_labels_the_base_rules_decide(spark, labels):
    got = quality.judge(frame(spark), labels.limit(0)).collect()
    assert all(r["score"] == 0 and r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.judge(frame(spark, []), labels).collect() == []


def test_kept_rows_have_their_own_columns(spark, labels):
    docs = frame(spark)
    out = quality.keep(docs, labels)
    assert out.columns == docs.columns and {r["n_words"] for r in out.collect()} == {99}


def test_verdicts_agree_with_labels(spark, sf_dir):
    judged = queries.registered()["op9_quality_rules"](spark, sf_dir)
    known = judged.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    good = [r["kept"] for r in known if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in known if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_threshold_is_the_trusted_tail(spark):
    rows = [(i, prose(i, 60, 200)) for i in range(400)]
    docs, trusted = frame(spark, rows), spark.createDataFrame([(i, i % 2 == 0) for i in range(400)], "doc_id long, fits boolean")
    ratios = quality.log_ratios(docs, trusted).cache()
    scores = sorted(s for (d, _), s in zip(rows, brute_scores(rows, set(range(0, 400, 2)))) if d % 2)
    tail = scores[0] + (scores[1] - scores[0]) * quality.TAIL * (len(scores) - 1)
    assert abs(quality.threshold(docs, trusted, ratios).first()[0] - min(tail, 0)) < 1e-9


@pytest.mark.parametrize("piece", [1_000_000, 9_000])
def test_every_trusted_document_counts(spark, monkeypatch, piece):
    """More of them than a list that was cut at 20,000 had."""
    monkeypatch.setattr(quality, "PIECE", piece)
    labels = spark.range(25_000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    trusted = quality.trusted_ids(labels)
    assert trusted.count() == 25_000
    rows = [(i, prose(i, 30, 50)) for i in range(60)]
    ratios = quality.log_ratios(frame(spark, rows), trusted).first()["ratios"]
    fits = {r["doc_id"] for r in trusted.where("fits").collect()}
    scores = [sum(ratios[g] for g in grams_of(t)) / len(grams_of(t)) for _, t in rows]
    assert all(abs(a - b) < 1e-9 for a, b in zip(scores, brute_scores(rows, fits)))
    rest = sorted(s for (d, _), s in zip(rows, scores) if d not in fits)
    tail = rest[0] + (rest[1] - rest[0]) * quality.TAIL * (len(rest) - 1)
    found = quality.threshold(frame(spark, rows), trusted, quality.log_ratios(frame(spark, rows), trusted)).first()[0]
    assert abs(found - min(tail, 0)) < 1e-9


# ---- mixing --------------------------------------------------------------------------------------


def test_mix_like_sql(spark, sf_dir):
    got = queries.registered()["op4_source_mix"](spark, sf_dir)
    assert spark_rows(got) == duck_rows(duck(sf_dir), mixing.COPIES_SQL)


def by_source(rows):
    out = {}
    for r in rows:
        held = out.setdefault(r["source"], {"size": r["source_size"], "target": r["target"], "taken": 0, "largest": 0})
        held["taken"] += r["taken"]
        held["largest"] = max(held["largest"], r["size"])
    return out


def test_mix_of_a_messy_table(spark):
    rows = mixing.copies(frame(spark)).collect()
    assert [(r["size"]) for r in sorted(rows, key=lambda r: r["n_chars"])] == [len(words_of(t)) for _, t in texts()]
    total = sum(r["size"] for r in rows)
    found = by_source(rows)
    assert set(found) == {"a", "b", "c", None} and abs(sum(s["target"] for s in found.values()) - total) < 1e-6 * total
    for own in found.values():
        assert own["target"] <= 3 * own["size"] + 1e-9 and abs(own["taken"] - own["target"]) <= own["largest"]
    assert all(r["taken"] in {0, r["size"], 2 * r["size"], 3 * r["size"]} for r in rows)
    again = mixing.copies(frame(spark).repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_small_sources_stop_at_three_times(spark):
    rows = [(i, prose(i, 40)) for i in range(400)]
    docs = frame(spark, rows).withColumn("source", mixing.F.expr("case when doc_id < 4 then 'c' when doc_id < 200 then 'a' else 'b' end"))
    found = by_source(mixing.copies(docs).collect())
    assert found["c"]["target"] == 3 * 160 and found["c"]["taken"] == 480
    left = 400 * 40 - 480
    assert abs(found["a"]["target"] - left / 3) < 1e-6 and abs(found["b"]["target"] - 2 * left / 3) < 1e-6


def test_mix_repeats_rows_with_their_own_columns(spark):
    docs = frame(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns and {r["size"] for r in out.collect()} == {-1}
    times = Counter(r["n_chars"] for r in out.collect())
    assert times == {r["n_chars"]: r["copies"] for r in mixing.copies(docs).collect() if r["copies"]}
    assert mixing.mix(frame(spark, [])).collect() == []


# ---- pages ---------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var a="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site name</h1><nav><ul><li><a href="/">Home</a></li></ul></nav></header>
<div class="cookie-notice">We use cookies</div><!-- <p>hidden</p> -->%s<aside>Popular now</aside>
<section id="comments"><p>A long reader comment that goes on and on, for more than eighty characters in just one line of text.</p></section>
<form><label>Mail</label><input name="a"></form><footer><p>&copy; Site</p></footer></body></html>"""
BODY = """<h1>A &amp; B</h1><p><b>Unclosed<br>line<p>Caf&eacute;  &lt;b&gt;\n is\tshort.</p><div class="ad"><div>Buy</div></div>
<ul><li>One</li><li>Two <a href="u">linked</a></li></ul><p>%s</p><p>End.</p>"""
LONG = "word " * 60


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><div>%s</div></main>", "<div id='content'>%s</div>"])
def test_main_text_of_a_page(wrap):
    got = pages.main_text(PAGE % (wrap % (BODY % LONG))).split("\n\n")
    assert got == ["A & B", "Unclosed line", "Café <b> is short.", "One", "Two linked", LONG.strip(), "End."]


def test_awkward_pages():
    assert [pages.main_text(p) for p in (None, "", "<p>", "<nav>x</nav>", "<!-- never closed <p>x")] == [""] * 5
    assert pages.main_text("<article><script>never closed") == ""
    assert pages.main_text("<article>a < b and <i>c</i></article>") == "a < b and c"
    assert pages.main_text("<article><nav>never closed<p>text</article>").endswith("text")
    assert len(pages.main_text("<article>" + "<p>x y</p>" * 50_000 + "</article>")) == 50_000 * 5 - 2


def test_short_texts_and_names_of_states():
    long = LONG.strip()
    assert pages.main_text("<div id=content><h1>Recipe</h1><p>Mix and bake.</p></div>") == "Recipe\n\nMix and bake."
    for name in ("has-sidebar", "post with-sidebar", "share-enabled", "no-comments"):
        assert pages.main_text(f"<div class='{name}'><p>{long}</p><p>{long}</p></div>") == f"{long}\n\n{long}"
    for name in ("sidebar", "post sidebar", "left-sidebar", "has-image comments"):
        assert pages.main_text(f"<div class='{name}'><p>{long}</p></div><div><p>{long}.</p></div>") == f"{long}."
    assert pages.main_text("<div class=x>a</div>") == "a" and pages.main_text("<nav>x</nav><div></div>") == ""


def test_given_pages_keep_their_articles(spark, sf_dir):
    import html
    import re

    for row in queries.registered()["op10_main_text"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", article))
        assert row["text"] == "\n\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])


def test_pages_table_with_clashing_columns(spark):
    rows = [(1, "u", PAGE % BODY, "old", "x"), (1, "u", PAGE % BODY, "old", "x"), (None, None, None, None, None)]
    out = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, more string"))
    assert out.columns == ["page_id", "url", "more", "text", "n_chars"]
    assert sorted(r["n_chars"] for r in out.collect())[0] == 0 and out.count() == 3


# ---- licenses ------------------------------------------------------------------------------------

NOTICE = next(t.text for t in licenses.TEXTS if t.label == "bsd")


def brute_places(text):
    import re

    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    found = []
    for phrase in licenses.PHRASES:
        p = phrase.text.split()
        found += [(i, phrase.label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), found


def test_phrases_and_texts_are_found(spark, tmp_path):
    notice = NOTICE.split()
    notice[9:9] = ["really", "so"]  # two words put in: the diagonal shifts
    rng = random.Random(1)
    bits = ["GNU General Public License", "gnu general", "public license", "MIT license, mit License", "cc-by", "CC by cc by", "é", "x9"]
    rows = [*texts(), (20, NOTICE), (21, prose(1, 50) + " " + " ".join(notice) + " " + NOTICE), (22, " ".join(notice[:8]))]
    rows += [(30 + i, " ".join(rng.choices(bits, k=40))) for i in range(30)] + [(7, "apache license " * 3000)]
    docs = frame(spark, rows)
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    got = queries.registered()["op6_license_scan"](spark, str(tmp_path)).collect()
    expected = []
    for d, t in rows:
        n, found = brute_places(t)
        starts = [i for i, _ in found]
        expected.append((d, n, len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))))
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(expected, key=repr)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[20]["labels"] == by_id[21]["labels"] == "bsd" and by_id[22]["labels"] == ""
    assert by_id[20]["score"] == 1 and 0 < by_id[22]["score"] < 0.5
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)
    spans = licenses.scan(docs.where("doc_id = 21")).first()["spans"]
    assert [s["label"] for s in spans if s["verified"]] == ["bsd", "bsd"]


def brute_lines(text):
    """(start, end, label, coverage, verified) of license texts, from all pairs of words in text and template."""
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    w, k, out = split(text), licenses.TEXT_K, []
    for template in licenses.TEXTS:
        t = split(template.text)
        size = len(t) - k + 1
        lines: dict[int, list[int]] = {}
        for place in range(len(w) - k + 1):
            for at in range(size):
                if w[place : place + k] == t[at : at + k]:
                    lines.setdefault(place - at, []).append(at)
        merged: dict[int, list[int]] = {}
        for d in lines:
            near = [x for x in lines if abs(x - d) <= licenses.NEIGHBOURS]
            merged.setdefault(min(near, key=lambda x: (-len(lines[x]), x)), []).append(d)
        for own in merged.values():
            share = len({at for d in own for at in lines[d]}) / size
            start, end = min(d + min(lines[d]) for d in own), max(d + max(lines[d]) for d in own) + k
            out.append((start, end, template.label, round(share, 9), share >= licenses.COVERED))
    return sorted(out)


def test_license_texts_like_brute_force(spark):
    again = "the following conditions are met"
    rng = random.Random(5)
    rows = [*texts(), (40, NOTICE + f": x y {again}: z w {again}: v"), (41, f"{again} a b {again}: " * 20 + NOTICE), (42, f"{NOTICE} " * 12)]
    for i in range(40):
        bits = []
        for template in rng.choices(licenses.TEXTS, k=4):
            w = template.text.split()
            for _ in range(rng.randrange(6)):
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice([[], ["new"], w[at : at + 6], rng.choices(w, k=3)])
            bits += w + prose(i, rng.choice([1, 30])).split()
        rows.append((50 + i, " ".join(bits)))
    got = {}
    for r in licenses.scan(frame(spark, rows)).collect():
        own = sorted((s["start"], s["end"], s["label"], round(s["coverage"], 9), s["verified"]) for s in r["spans"] if not s["phrase"])
        got.setdefault(r["doc_id"], []).append(own)
    expected = {}
    for d, t in rows:
        expected.setdefault(d, []).append(brute_lines(t))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in expected.items()}
    verified = {d: [s[2] for s in got[d][0] if s[4]] for d in (40, 41, 42)}
    assert verified == {40: ["bsd"], 41: ["bsd"], 42: ["bsd"] * 12}


def test_licenses_of_an_empty_table(spark):
    assert licenses.scan(frame(spark, [])).collect() == []
    assert rows_of(licenses.scan(frame(spark, [(None, None)])), "doc_id", "n_words", "spans") == [(None, 0, [])]


def test_texts_of_few_words_have_each_phrase_once(spark):
    rows = [(1, "MIT License"), (2, "CC BY"), (3, "the MIT License"), (4, "license"), (5, "Apache License, MIT License")]
    got = {r["doc_id"]: r["spans"] for r in licenses.scan(frame(spark, rows)).collect()}
    spans = {d: [(s["start"], s["end"], s["label"]) for s in own if s["phrase"]] for d, own in got.items()}
    assert spans == {1: [(0, 2, "mit")], 2: [(0, 2, "cc-by")], 3: [(1, 3, "mit")], 4: [], 5: [(0, 2, "apache"), (2, 4, "mit")]}
