"""The operators of this subpackage as registered queries over the given tables, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import bpe, dac, kdtree, lexical, licenses, mixing, near, pages, pii, pitman_yor, quality, runs, substrings
from fleetscope.llm.textcols import let, word_array
from fleetscope.session import configure, shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_repeated_passages(spark, sf_dir):
    """Passages of 50 words or more of all documents that an earlier document has too."""
    found = substrings.passages(table(spark, sf_dir, "documents"))
    return found.drop("text_hash", "match_hash")


@query
def op2_token_files(spark, sf_dir):
    """Ids of all documents, written to and read back from files of directly addressable codes."""
    path = shared_dir(spark, "token-files")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        dac.write(table(spark, sf_dir, "documents"), f.read(), path)
    return dac.checksums(spark, path)


@query
def op3_near_duplicates(spark, sf_dir):
    """Components of all documents linked by similar sets of pairs of words."""
    rows = near.classes(table(spark, sf_dir, "documents").select("doc_id", "text"), k=2, percent=80)
    return near.with_least_id(rows).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_source_mix(spark, sf_dir):
    """How many words the mix of all documents by target weights takes from each."""
    mixed = mixing.copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_byte_bpe(spark, sf_dir):
    """Digests of the ids of all documents, and of the bytes decoded from them."""
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, tokens, public_tokenizers.PATTERN).drop("text")
    return bpe.decode(coded, tokens).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_license_scan(spark, sf_dir):
    """License phrases and texts in all documents."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["phrase"])
    good = F.filter("spans", lambda s: s["verified"])
    starts = F.transform(base, lambda s: s["start"].cast("long"))
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(good).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )


@query
def op7_top_k(spark, sf_dir):
    """The 20 highest inner products of each query vector with all other vectors."""
    rows = table(spark, sf_dir, "embeddings").where(kdtree.usable("embedding") & F.col("vec_id").isNotNull())
    whole = rows.select("vec_id", kdtree.whole_numbers("embedding").alias("whole"))
    return kdtree.top_k(whole, F.pmod(F.col("vec_id"), F.lit(20)) == 0, 20)


@query
def op8_language_model(spark, sf_dir):
    """Scores of all documents by a model learnt from those that are not held out."""
    return pitman_yor.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_quality_rules(spark, sf_dir):
    """Counts, scores and verdicts of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, table(spark, sf_dir, "labels")).drop("text")


@query
def op10_main_text(spark, sf_dir):
    """Main text of all pages."""
    return pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op11_ranked_search(spark, sf_dir):
    """The 50 documents that score highest for each benchmark item, by an index of all documents."""
    path = shared_dir(spark, "lexical-index")
    lexical.build(table(spark, sf_dir, "documents"), path)
    found = lexical.search(spark, path, table(spark, sf_dir, "benchmark"), 50)
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where every tenth document, by crc32 of its id, repeats a stretch from some word on."""
    hashed = F.crc32(F.col("doc_id").cast("string"))

    def turned(own):
        n, g = F.size(own).cast("long"), F.floor(hashed / 10)
        first = F.pmod(g, n)
        period = 1 + F.floor((n - first) / (3 + F.pmod(g, F.lit(8))))
        source = lambda a, p: lambda w, i: F.when(i < a, w).otherwise(F.get(own, (a + F.pmod(i - a, p)).cast("int")))
        return let(first, lambda a: let(period, lambda p: F.array_join(F.transform(own, source(a, p)), " ")))

    chosen = F.coalesce(F.pmod(hashed, F.lit(10)) == 0, F.lit(False))
    text = let(word_array(F.col("text")), lambda own: F.when(F.size(own) > 0, turned(own)).otherwise(""))
    return docs.withColumn("text", F.when(chosen, text).otherwise(F.col("text")))


@query
def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of all documents, and digests of them and of the texts without the repetition."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.find(periodic_tails(docs))
    greatest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"], r["period"])))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.lit(""), F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""))
    return found.withColumn("_top", greatest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_top.start"),
        (-F.col("_top.n")).alias("length"),
        F.col("_top.period"),
        F.floor(-1000 * F.col("_top.n") / F.col("_top.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_personal_data(spark, sf_dir):
    """Spans of personal data in all documents."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *(of_kind(kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def registered() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return {"op4_source_mix": mixing.COPIES_SQL, "op11_ranked_search": lexical.SEARCH_SQL.format(k=50)}
