"""Corpus pipeline over ``documents``: language ID, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; the first three return the columns of ``documents``.  Models
are learned as in the single queries: the language model from the documents at
hand, the toxicity model from their labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstack.llm import jaccard_join, langid, packing, toxicity
from tabstack.llm.common import id_remainder, materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_SHARE = 0.5     # a document needs a language that holds half of it


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; null, letterless and evenly mixed texts go, and texts that no learned language fits."""
    held = id_remainder("doc_id", 4) == 2
    langs, model = langid.fit(docs, ~held)
    found = langid.predict(docs, langs, model, keep=COLUMNS[1:], with_fit=True)
    kept = (F.col("lang_pred") != "und") & (F.col("score") >= MIN_SHARE)
    for lang, bar in langid.bars(docs.filter(held), langs, model).items():
        kept &= (F.col("lang_pred") != lang) | (F.col("fit") >= bar)
    return found.filter(kept).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 5) != 0)
    return toxicity.score(docs, model, keep=COLUMNS[1:]).filter("score < 0.5").select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group that links of five-word shingles, similarity 0.8 or more, join."""
    return jaccard_join.keep_first(docs).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in windows of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [("language_id", keep_language), ("toxicity", drop_toxic), ("near_duplicates", keep_one_of_each_group), ("packing", pack_windows)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
