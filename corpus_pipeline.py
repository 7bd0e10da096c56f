"""Corpus preparation: one operator after another, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
in the shared folder and hands what it reads back to the next one. All stages but the last
return the columns of documents. Rows with a null text pass all filters: they have no words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import decontamination, packing, pii, simhash, toxicity
from lakemart.llm.common import read, stored, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from this corpus and its labels, does not call toxic."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of SimHash neighbours: four words, four bits."""
    return simhash.drop_near_duplicates(docs, words_each=4, most=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item of at least three words."""
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), least_words=3)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced; n_chars follows."""
    return pii.with_length(pii.sanitise(docs), "text", "n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", sanitise),
    ("best_fit_packing", pack),
]

#: SQL cannot express the learned scores, SimHash links or token ids of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
