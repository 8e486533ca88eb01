"""The corpus pipeline: language ID, near duplicates, repeated passages, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read
again as the next stage's ``docs``. All stages but the last keep the columns of ``documents`` and work
on every row they are given. Nulls, empty and very long texts, repeated rows and empty tables are
handled as the operators' docstrings say; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarnflow.llm import language, packing, pii, simhash, suffix
from tarnflow.llm.common import table, written

#: Least share of the bits a byte that contexts usually save in a text of the language.
LEAST_SAVING = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, without letters or unlike every language known; sets no column."""
    return language.keep_known(docs, LEAST_SAVING)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of SimHash near-duplicates the document of smallest id stays, once.

    Three-word shingles, fingerprints that differ in two bits or fewer. Rows without an id stay; texts without words are alike.
    """
    return simhash.keep_first(docs, distance=2, words=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes every byte of a 100-byte string that also starts earlier."""
    return suffix.remove_repeats(docs, length=100).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each span of personal data by its kind."""
    return pii.redact(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 1024 tokens: where each piece of each document goes."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("personal_data", redact),
    ("packing", pack),
]

#: The stages are models, hashes and byte-level work, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
