"""A corpus in five steps: bad documents go, near copies go, repeated passages go, sources are mixed to their
weights, and what is left becomes token ids.

Every stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns a DataFrame;
all but the last return the columns of ``documents``. ``run`` writes each stage's result to the shared folder
and reads it again as the next one's input, so a stage that has to run again starts from what is there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import bpe, mixing, near, quality, substrings
from fleetscope.llm.tables import stored
from fleetscope.session import configure

RANKS = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by sets of five words in a row."""
    return near.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has too."""
    return substrings.cut(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources by weight takes it."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token ids; decoding them gives the text again, which is checked row by row."""
    tokens = bpe.read_ranks(public_tokenizers.path(RANKS))
    coded = bpe.decode(bpe.encode(docs, tokens, public_tokenizers.PATTERN), tokens)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes")
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("token ids", token_ids),
]

#: Hashes, sketches and merges of these stages have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
