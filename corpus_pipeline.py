"""The corpus pipeline: classify, deduplicate, join near copies, decontaminate, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from weft.llm.common import fold, fresh, scratch, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it is fitted as the op7 query's."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), lambda k: fold(k, 4) != 2)
    score = fresh("quality_score", docs)
    return quality.score(docs, model, out_col=score).filter(F.col(score) >= 0.7).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs, k=5, num=80, den=100)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents that were kept."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", keep_quality), ("exact dedup", keep_exact), ("n-gram jaccard join", keep_distinct), ("benchmark decontamination", keep_clean), ("packing", pack)]

#: SQL can't express the fitted classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again, and the tables it worked with are deleted."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch() as kept:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
            kept.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
