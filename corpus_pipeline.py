"""A training corpus from documents: five stages, each of them one operator over what the one before kept.

Defined results for all stages: columns besides doc_id, text, source, lang and n_chars pass through, whatever
their names. Rows equal in everything are rows of their own, until near copies go. A null source is a source,
a null doc_id is kept like any other. An empty table gives an empty table, of the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillstone.llm import langid, line_dedup, mixing, packing, simhash
from quillstone.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: a null or empty text, or one without a letter, or nothing to learn from."""
    return langid.known_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in the one with the largest id; a null text stays null."""
    return line_dedup.dedup_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, texts that share 0.8 or more of their five-word shingles, the smallest id stays.

    Null ids rank last. Texts without words are copies of each other.
    """
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix takes; one without words is not taken."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of tokens; columns are those of the packing query."""
    return packing.with_checksums(packing.pack(docs, tokenizer=tokenizer_path()))


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("mixture", mixture), ("sequences", sequences)]

#: Fingerprints, apportionment and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before return is written to the shared folder and reread."""
    from quillstone.llm.common import shared_folder

    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
