"""The corpus pipeline: from raw documents to token ids.

Each stage takes the documents its predecessor kept (a Parquet table, read
again) and calls one operator; all but the last return the columns of
``documents``. Rows leave for one reason per stage:

1. quality classifier: rows predicted to be of label 0;
2. exact dedup: all but one row of each group of equal texts;
3. SimHash near-dedup: all but one row of each component of fingerprints
   within three bits of each other;
4. benchmark decontamination: rows that contain a benchmark item;
5. SentencePiece encoding: nothing leaves; rows get their token ids.

Rows with null texts count as empty texts, rows with null ids are rows like
any other, extra columns pass through the first four stages.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import decontaminate, exact_dedup, pieces, quality, simhash
from meterlake.llm.queries import sized, table, tokenizer_file
from meterlake.llm.tables import batches_of_texts
from meterlake.scratch import delete_path, scratch_path


def _stage(operator):
    """A stage: Arrow batches that suit texts, and a result in as many files as
    the bytes of its input's texts ask for."""

    @functools.wraps(operator)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        batches_of_texts(spark)
        return sized(operator(spark, docs, sf_dir), docs)

    return run_stage


@_stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs, words=simhash.WORDS, max_bits=simhash.MAX_BITS)


@_stage
def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids."""
    rows = pieces.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_file("piece_bpe_32k.model"))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("benchmark decontamination", uncontaminated),
    ("SentencePiece encoding", encoded),
]

# a trained model, bit fingerprints and piece merges: no SQL for the rows
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``. Between stages the rows are a Parquet
    table in the shared folder: a lost executor repeats one stage at most. A
    table goes when the next one is written; the last stays for the result."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
