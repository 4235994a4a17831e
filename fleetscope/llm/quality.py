"""Quality rules: counts of each whole text, and a log-likelihood ratio of hashed n-grams.

Words and pairs of words of a text are hashed into ``BUCKETS`` buckets. One multinomial over the buckets
comes from trusted documents, one from the raw corpus; a text's score is the mean, over its n-grams, of
the log of how much likelier the trusted one makes them. The threshold is read from trusted documents
that did not help to make the multinomial, and then every document is decided by comparison alone.

All of it is DataFrame functions: a text is an array of words within its row, so nothing but bucket
counts, bounded by ``BUCKETS``, and the scores of trusted documents is shuffled. Every trusted document
counts: each is in one of two halves, the one that makes the multinomial or the one that the threshold is
read from. Their ids are broadcast by ``PIECE`` of them, with one pass over the documents for each piece.

Cases: a null or empty text has no words, score 0 and fails the base rule; repeated rows and null ids
are rows like any other; without trusted documents all scores are 0 and only the base rule decides;
without trusted documents to read the threshold from, it is 0; input columns with the names of result
columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.tables import set_aside, stored
from fleetscope.llm.textcols import SPACES, let, word_array

BUCKETS = 1 << 14
PIECE = 1_000_000
WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Share of the trusted documents that may score below the threshold.
TAIL = 0.001

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_WORDS, _HASHES, _RATIOS = "__words", "__word_hashes", "__ratios"


def _hashes() -> Column:
    return F.transform(_WORDS, lambda w: F.xxhash64(w))


def _ngrams() -> Column:
    """Hashes of the words and of the pairs of words; reads the word hashes. A pair of equal words is the
    same n-gram whatever the word."""

    def both(own: Column) -> Column:
        second = lambda i: F.get(own, i + 1)
        pair = lambda h, i: F.when(h == second(i), F.xxhash64(F.lit("twice"))).otherwise(F.xxhash64(h, second(i)))
        pairs = F.slice(F.transform(own, pair), 1, F.greatest(F.size(own) - 1, F.lit(0)))
        return F.concat(own, pairs)

    return let(F.col(_HASHES), both)


def _bucket(ngram: Column) -> Column:
    return F.pmod(ngram, F.lit(BUCKETS)).cast("int")


def _windows() -> Column:
    """Hashes of all ``WINDOW`` words in a row, from those of half as many; reads the word hashes."""
    wider = lambda half: lambda own: F.transform(own, lambda h, i: F.xxhash64(h, F.get(own, i + half)))
    size, hashes = 1, F.col(_HASHES)
    while size < WINDOW:  # a power of two
        size, hashes = 2 * size, let(hashes, wider(size))
    return F.slice(hashes, 1, F.greatest(F.size(_HASHES) - (WINDOW - 1), F.lit(0)))


def _with_hashes(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn(_WORDS, word_array(F.col(text))).withColumn(_HASHES, _hashes())


def _repeated_words(windows: Column) -> Column:
    """Words that stand in windows found at least twice. Windows are sorted by hash so that equal ones
    meet; then the union of their spans is summed in order of place."""

    def spans(s: Column) -> Column:
        same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
        twice = F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("covered"))
        step = lambda a, p: F.struct(
            p.alias("last"), (a["covered"] + F.least(F.lit(WINDOW), p - a["last"])).alias("covered")
        )
        return F.aggregate(places, start, step, lambda a: a["covered"])

    by_hash = lambda own: F.sort_array(F.transform(own, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    once = lambda own: F.size(F.array_distinct(own)) == F.size(own)
    return let(windows, lambda own: F.when(once(own), F.lit(0)).otherwise(let(by_hash(own), spans)))


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed, and the
    word hashes in a column of this module's own."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")
    n_chars = F.length(whole)
    counted = _with_hashes(docs, text)
    counted = counted.withColumns(
        {
            "n_words": F.size(_HASHES),
            "word_chars": F.length(F.translate(whole, SPACES, "")),
            "n_symbols": n_chars - F.length(F.translate(whole, SYMBOLS, "")),
            "n_dup_lines": let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))),
            "n_repeat_words": _repeated_words(_windows()),
        }
    )
    counted = counted.withColumns({c: F.col(c).cast("long") for c in _COUNTS})
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).drop(_WORDS)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled good and not toxic; every second one, by hash, serves to make the
    multinomial, the others to read the threshold."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    return good.withColumn("fits", F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)


def _pieces(ids: DataFrame) -> list[DataFrame]:
    """All of ``ids`` (doc_id), in pieces of about ``PIECE``."""
    n = max(1, -(-ids.count() // PIECE))
    piece = F.pmod(F.xxhash64("doc_id", F.lit(n)), F.lit(n))
    return [F.broadcast(ids.where(piece == i)) for i in range(n)]


def log_ratios(docs: DataFrame, trusted: DataFrame, text: str = "text") -> DataFrame:
    """One row with an array: for each bucket, log(trusted share / raw share), both with one added.

    The raw counts are those of all documents; ``trusted`` has the ids of ``trusted_ids``.
    """
    first, *others = _pieces(trusted.where("fits").select("doc_id", F.lit(1).alias("__fits")))
    texts = docs.select("doc_id", text)
    rows = texts.join(first, "doc_id", "left").withColumn("__raw", F.lit(1))
    for piece in others:
        rows = rows.unionByName(texts.join(piece, "doc_id"), allowMissingColumns=True)
    grams = _with_hashes(rows, text).select("__raw", "__fits", F.explode(_ngrams()).alias("ngram"))
    grams = grams.select("__raw", "__fits", _bucket(F.col("ngram")).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("__raw").alias("raw"), F.count("__fits").alias("good"))
    every = docs.sparkSession.range(0, BUCKETS, 1, 1).withColumnRenamed("id", "bucket")
    filled = every.join(counts, "bucket", "left").na.fill(0, ["raw", "good"])
    listed = filled.agg(
        F.sum("raw").alias("all_raw"),
        F.sum("good").alias("all_good"),
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("by_bucket"),
    )
    share = lambda own, total: (own + 1) / (total + BUCKETS)
    ratio = lambda b: F.log(share(b["good"], F.col("all_good")) / share(b["raw"], F.col("all_raw")))
    ratios = F.transform("by_bucket", lambda b: F.when(F.col("all_good") > 0, ratio(b)).otherwise(F.lit(0.0)))
    return listed.select(ratios.alias("ratios"))


def _with_score(hashed: DataFrame, ratios: DataFrame) -> DataFrame:
    """``hashed`` with the mean log ratio of each row's n-grams. The ratios are read in one place only, so
    that they stay a constant of the plan and are not copied into every row."""
    n = F.greatest(2 * F.size(_HASHES) - 1, F.lit(1))
    total = F.aggregate(_ngrams(), F.lit(0.0), lambda a, g: a + F.get(F.col(_RATIOS), _bucket(g)))
    return hashed.withColumn(_RATIOS, ratios.scalar()).withColumn("score", total / n).drop(_RATIOS)


def threshold(docs: DataFrame, trusted: DataFrame, ratios: DataFrame, text: str = "text") -> DataFrame:
    """One row: the score that all but ``TAIL`` of the trusted documents not fitted to exceed; never
    above 0, where both multinomials agree. Only the lowest scores, up to the place of the threshold, meet."""
    first, *others = (docs.select("doc_id", text).join(p, "doc_id") for p in _pieces(trusted.where("not fits").select("doc_id")))
    rows = first
    for other in others:
        rows = rows.unionByName(other)
    scores = _with_score(_with_hashes(rows, text).where(F.size(_HASHES) >= 20), ratios).select("score")
    scores = stored(scores, "trusted-scores")
    place = TAIL * max(scores.count() - 1, 0)
    lowest = int(place) + 2
    low = F.percentile("score", F.lit(place / (lowest - 1)))
    return scores.orderBy("score").limit(lowest).agg(F.least(F.coalesce(low, F.lit(0.0)), F.lit(0.0)).alias("threshold"))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``base_rules``, the score, and ``kept``."""
    trusted = stored(trusted_ids(labels), "trusted")
    ratios = stored(log_ratios(docs, trusted, text), "log-ratios")
    least = stored(threshold(docs, trusted, ratios, text), "threshold")
    judged = _with_score(base_rules(docs, text), ratios).drop(_HASHES)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least.scalar()))


def keep(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with the columns of ``docs``.

    The filter also reads the row's place: a filter on that stays above the expressions of the verdict,
    where otherwise it would be moved below them with a copy of them all.
    """
    plain, back = set_aside(docs, [*_COUNTS, "base_failed", "score", "kept"])
    judged = judge(plain, labels, text).withColumn("__row", F.monotonically_increasing_id())
    return back(judged.where(F.col("kept") & (F.col("__row") >= 0)))
