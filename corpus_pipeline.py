"""From documents to packed sequences: each stage works on what the one before it kept.

Each stage takes nulls in any column, empty and very long texts, rows that repeat an id, an empty table (an empty result) and
columns of any other name, which it passes through; what it decides on them stands in its docstring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lettermill.llm import exact_dedup, language, minhash, mixing, packing
from lettermill.llm.common import table, written

#: A text of which the best language contains less than this share of the n-grams is in none of the languages.
LEAST_SHARE = 0.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter (null and empty ones too) and texts in no language that the labelled rows teach. A null
    label teaches nothing and doesn't matter for its own row; without labelled rows every text goes. A tie between languages
    keeps the text."""
    known = language.identify(docs, language.fit(docs), min_share=LEAST_SHARE)
    return known.where(f"lang_pred != '{language.UNDECIDED}'").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space apart; null counts as empty) the smallest doc_id stays; all rows of that id and text stay, and
    a null id only in a group of null ids."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 over five-word shingles the smallest doc_id stays; texts without words link with
    nothing and stay, a null id comes after all others."""
    return minhash.drop_near_copies(docs, threshold=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's budget of words, in random order: some documents go, some repeat, one a source is cut. A null source is a
    source of its own; texts without words take nothing and go."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document that is left, in sequences of at most 2048; a null or empty text is its end token, a
    repeated row is a document of its own."""
    return packing.packed(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express language identification or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
