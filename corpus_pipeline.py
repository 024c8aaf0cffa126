"""From raw documents to token ids: five stages, each written and read again by the next.

Stages and their operators: quality rules, line dedup, n-gram Jaccard join,
mixing of the sources, byte-level BPE.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierframe.llm import byte_bpe, line_chunks, mixing, ngram_join, quality
from tierframe.llm.text import fresh, n_words
from tierframe.sources.staging import materialize

VOCABULARY = "byte_bpe_50k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the classifier learns from ``labels``."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier place has: two lines or more,
    or a line of 50 words or more.  One that has no word left goes."""
    left = line_chunks.without_repeats(docs, length_col="n_chars")
    # a plain filter would be put before the lines are cut, and cut them again for
    # every line; one on what an array is spread to stays behind
    there = fresh(docs, "there")
    row = F.array(F.struct(F.lit(True).alias(there), *docs.columns))
    kept = F.filter(row, lambda r: n_words(r["text"]) > 0)
    return left.select(F.inline_outer(kept)).filter(there).drop(there)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the smallest id.

    Near duplicates share four fifths of their 5-word shingles; the closer values of
    op1_ngram_join belong to that query alone.
    Rows of a null id are not compared and stay; of rows that share an id and a
    group one stays.
    """
    return ngram_join.representatives(docs, n=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken twice stands there twice."""
    return mixing.mixed_documents(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and ids of every row of the mix."""
    return byte_bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("source_mix", mix_sources),
    ("bpe_encoding", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is staged as Parquet for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL can express neither the classifier nor the merges; tests/llm checks the
# stages against a plain version
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
