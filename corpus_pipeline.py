"""Corpus pipeline: what is left of ``documents`` after quality, exact and near dedup, mixed by source and packed.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of ``documents``, extra ones with them, whatever their names. There is no SQL for it (a boosted model, a similarity graph and a retrieval index); the tests hold each stage
against a brute-force version. In every stage a null text is empty, a null id is larger than any other, texts are looked at whole, however long, and an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eodlake.llm.common import saved, table
from eodlake.llm.exact import exact_filter
from eodlake.llm.minhash import near_filter
from eodlake.llm.mixing import mixed
from eodlake.llm.packing import pack, public_tokenizer
from eodlake.llm.quality import quality_filter


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Rows with equal texts have equal scores, so all or none of them stay; empty texts are scored too."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first (smallest id) of each group of equal texts; of rows with equal text and id one."""
    return exact_filter(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first (smallest id) of each group of near-duplicates (five-word shingles, similarity 0.8). Documents without words are near nothing and all stay."""
    return near_filter(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights: documents dropped, kept or repeated as whole ones. Null is a source of its own, the last."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens. An empty text is one end token; repeated rows are packed each on its own."""
    return pack(docs, **public_tokenizer())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mixing), ("pack", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
