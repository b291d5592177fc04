"""The corpus pipeline: quality rules, toxicity, near-duplicates, packing.

Every stage works on all that its predecessor kept, and what it decides takes effect. The first three return the columns of
their documents (and any others, under whatever names), the last returns pieces. What all stages do with odd rows:

* null, empty or white text: goes in the first stage (no words); where a stage meets it all the same, it is not toxic, is linked
  with nothing, and packs as the end id alone;
* repeated rows are rows of their own in the first two stages; of repeated rows of one id, each stays or goes with its id;
* ties: a near-duplicate group keeps its smallest id; pieces of one length are interchangeable;
* a null id is kept by the first three stages as its text allows, and is never a near-duplicate;
* very long texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mosaique.llm import near_dups, packing, quality, toxicity
from mosaique.llm.common import documents, removed, stored
from mosaique.llm.tokens import public_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a perplexity band of their language reject go; null text is rejected. Bands come from all
    documents given."""
    return quality.reject(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; all labels of the documents given are learned from (without any, none goes). Null and empty
    texts stay."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id. Documents without a word or without an id
    stay, all rows of one id go together."""
    return near_dups.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences; null and empty texts are the end id alone."""
    return packing.pack_documents(docs, public_path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("toxicity", toxic_documents), ("near_duplicates", near_duplicates), ("packing", packed)]

#: Perplexity, learned patterns and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        if before is not None:
            removed(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
