"""The corpus pipeline: stages over ``documents``, each one operator of
``costmart.llm``; a stage works on all that its predecessor kept.

All stages but the last return the columns of ``documents``. Clean documents
pass every filter; the last stage gives one row of digests per document left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm import bpe, line_dedup, minmax, tiling, toxicity
from costmart.llm.common import prepare, stored, table
from costmart.llm.queries import vocabulary


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores 0.5 or more go."""
    prepare(spark)
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go out of the texts."""
    prepare(spark)
    out = line_dedup.dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays."""
    prepare(spark)
    return minmax.keep_one(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the token ids and of the decoded text."""
    prepare(spark)
    return bpe.encode_decode(docs, vocabulary())


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL cannot express the trained first stage nor the last; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
