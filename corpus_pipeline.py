"""The corpus pipeline: each stage takes the documents that its predecessor kept.

Language identification, near-duplicates, repeated strings, the mix of sources, and token ids. A stage takes
(spark, docs, folder); all but the last return doc_id, text, lang, source, n_chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm import bpe_prefix, language, minhash, mixing, substrings
from precinct.llm.common import read_table
from precinct.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Text with more phrases than this for each symbol is like no learned language: prose in one has about a sixth. An unlearned
# language in the same script can have less. Texts of fewer characters say too little and are not judged by it.
MOST_PHRASES, FEW_CHARACTERS = 0.5, 32
# Per cent of the shingles of two near-duplicates that they share; op2 alone has its own, stricter threshold.
NEAR_PERCENT = 80


def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents without a letter, and longer ones that are like no learned language, in effect those in other scripts.

    Text of an unlearned language in a learned script mostly stays. Texts of fewer than 32 characters are only asked for a
    letter, and so are all where no document has a language to learn from.
    """
    references = language.learn(docs.filter(~language.held_out(F.col("doc_id"))))
    if not references:
        return docs.filter(F.col("text").rlike(language.LETTER)).select(*COLUMNS)
    found = language.identify(docs, references, *COLUMNS)
    kept = (F.col("lang_pred") != language.UNKNOWN) & ((F.col("phrase_rate") <= MOST_PHRASES) | (F.length("text") < FEW_CHARACTERS))
    return found.filter(kept).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return minhash.without_near_duplicates(docs.select(*COLUMNS), NEAR_PERCENT)


def repeated_string_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Removes byte strings that an earlier document, or an earlier place, has as well; all documents stay."""
    found = substrings.remove_repeats(docs, keep_text=True, carry=("lang", "source"))
    return found.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Brings the sources to their target weights: documents with the words that the mix takes of them.

    Where the mix takes a stretch of words, the white space between them stays; stretches are joined by line feeds. A document
    of which nothing is taken goes.
    """
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids, with the checksums of ids and decoded text."""
    return bpe_prefix.encode(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_strings", repeated_string_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

# SQL can express neither the learned language models nor the drawn mix; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
