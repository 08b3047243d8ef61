"""A training corpus from raw documents: quality rules, line dedup, near-duplicate documents, mixing, encoding.

Each stage works on the rows that the one before it kept and returns the columns of documents; the last returns the
encoded rows. `run` writes every stage's rows as Parquet in the shared folder and reads them again, so that a lost
executor never costs more than one stage; a stage's rows are deleted once the next one's are written.

Null and empty texts fail the quality rules and go there. A null lang or source is a group of its own, a null doc_id a row
like others. Repeated rows pass the quality rules alike and are one document for line dedup and the n-gram join, which keeps
one of them. Ties (a similarity of just 80 %) count as similar. An empty table gives an empty result in every stage. Texts
may be of any length. Extra columns, whatever their names, are passed on by all stages but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import bpe, linededup, mixing, ngramjoin, quality
from corpusloom.llm.queries import vocabulary
from corpusloom.session import ensure_checkpoint_dir, remove


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and the tokeniser's bands accept."""
    return quality.accepted(docs, vocabulary("piece_bpe_32k.model"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that are like an earlier line; n_chars follows the text."""
    return linededup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return ngramjoin.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as the mix takes it."""
    return mixing.drawn(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    return bpe.digests(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates), ("mixing sources", mix_sources), ("BPE encoding", encode)]

#: SQL can't express entropy balancing or the encoding; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        made.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
