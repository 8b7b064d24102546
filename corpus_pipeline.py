"""A cleaning pipeline over ``documents``: each stage works on all that the one before it kept.

Documents judged bad go; of each group of similar documents the one of the smallest id stays; passages of the benchmark are
cut out, and documents that mostly consist of them go; sources are mixed to their target weights, which repeats some
documents and leaves out others; and the token ids of the mix are written to files and read back.

Defined cases: all columns of the documents go along to the mix, whatever their names; a null or empty text has no words, is judged like any text, links
with nothing and is taken 0 words of; rows without id stay until the mix; repeated rows of one text are one group; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from showroom.llm import decontaminate, jaccard_join, mixing, quality, token_files
from showroom.llm.shared import new_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are not judged bad. Without labels, all of them."""
    return quality.good(docs, table(spark, folder, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of linked documents the one of the smallest id; documents without words or id stay."""
    return jaccard_join.first_of_each(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without passages of the benchmark; documents that mostly consist of them go. Without test items nothing changes."""
    return decontaminate.decontaminate(docs, table(spark, folder, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a source cut to the words that its target leaves; ties go by key, then id."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of the files, one per document of the mix."""
    read = token_files.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_test_items),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID / binary output", token_ids),
]

#: The first stage trains a classifier, and the last one needs a tokenizer; SQL can state neither.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are a Parquet table in the shared folder."""
    docs = table(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = new_folder(spark, f"pipeline-{number}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
