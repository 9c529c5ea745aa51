"""The corpus pipeline: language ID, toxicity, near duplicates, benchmark
decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next one's docs. The first four return the columns of
documents and drop rows; the last returns each kept document's token ids and the
digests of its round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.llm import bpe, decontaminate, language, ngram_jaccard, toxicity
from tabreg.llm.common import write_table
from tabreg.llm.queries import RANKS, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, learned from the documents' own lang; rejected documents go."""
    return language.accepted(docs, language.train(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10, learned from ``labels``; documents predicted toxic go."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1; the smallest doc_id of each group stays."""
    return ngram_jaccard.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4; documents that hold an item of ``benchmark`` go."""
    return decontaminate.accepted(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: packed token ids, and digests of the ids and the decoded bytes."""
    # written between, so that one Python worker, not two, runs beside each task
    out = bpe.decode(write_table(bpe.encode(docs, RANKS), "ids"), RANKS)
    return out.select("doc_id", "ids", bpe.n_tokens().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language_stage), ("toxicity", toxicity_stage), ("ngram_jaccard", duplicates_stage),
          ("decontamination", benchmark_stage), ("byte_bpe", token_stage)]

# Learned models decide in the first two stages: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs
