"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> the documents that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import leaks, mixing, near, shards, toxicity
from tideline.llm.common import free_name
from tideline.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half, learned from the labelled documents of the tables."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    kept = toxicity.with_scores(docs, model, score=score).where(F.col(score) < 0.5)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.without_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def write(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences of the mix, written to shards and read back."""
    return shards.training_order(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("token_output", write),
]
