"""Corpus pipeline: toxic documents go, then those of no clear language, then all
but one of each group of near-duplicates; what stays is packed for training.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
kept; all but the last return the columns they were given, whatever their
names. Stages give
defined results on null ids, texts, languages and labels, on empty tables and
repeated rows (see the operators' own docstrings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.llm import jaccard_groups, langid, packing, toxicity
from tallyho.llm.common import saved, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that toxicity (segments of token log-odds) does not predict as toxic.
    Without labelled documents of both kinds nothing is learned and all stay."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    if not model.odds:
        return docs
    found = toxicity.score(docs.select(F.struct("*").alias("row"), "text"), model, keep=["row"])
    return found.where("predicted = 0").select("row.*")


def language_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a clear language: not without a letter, not ambiguous. Without any
    labelled language nothing is learned and all documents stay."""
    model = langid.train(docs.select("doc_id", "text", "lang"))
    if not model.langs:
        return docs
    found = langid.predict(docs.select(F.struct("*").alias("row"), "text"), model, keep=["row"])
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous")).select("row.*")


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a 5-gram Jaccard similarity of 0.8 or more."""
    return jaccard_groups.keep_one(docs, n=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that stayed, by their sequence."""
    return packing.pack(docs.select("doc_id", "text"), packing.tokenizer_path())


STAGES = [
    ("toxicity", toxic_out),
    ("language_id", language_out),
    ("ngram_jaccard_join", near_duplicates_out),
    ("packing", packed),
]

#: The stages learn models, compare sets by hashes and run a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"stage-{name}")
    return docs
