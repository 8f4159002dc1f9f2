"""The corpus pipeline: five stages, each over all that the one before it kept.

    spark-submit corpus_pipeline.py <folder of the tables> <output>
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import exact_dedup, mixing, pieces, simhash, toxicity
from tidemill.llm.common import free_names
from tidemill.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold. The model learns from the labelled part of the raw table."""
    raw, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.without_toxic(docs, toxicity.fit(raw, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return exact_dedup.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts with close fingerprints."""
    return simhash.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their sampled pieces, and whether these spell the text: all columns, then
    ``ids`` and ``lossless``, with underscores in front where ``docs`` has such columns.

    The encoded rows are stored, so that a task has one Python worker at a time, not one for each direction."""
    ids, back, lossless = free_names(docs, "ids", "decoded", "lossless")
    rows = stored(docs.withColumn(ids, pieces.encoder(docs)), "pieces")
    rows = rows.withColumn(back, pieces.decoder(rows, ids))
    return rows.withColumn(lossless, F.col(back) == F.coalesce("text", F.lit(""))).drop(back)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("SentencePiece", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no trained classifier, such hash or sampler; tests compare with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL}

if __name__ == "__main__":
    run(SparkSession.builder.appName("corpus pipeline").getOrCreate(), sys.argv[1]).write.parquet(sys.argv[2])
