"""The corpus pipeline: toxic documents out, near copies out, benchmark leaks out, mixed, written.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  ``run`` writes each stage's rows as Parquet in the shared folder and reads them
again as the next stage's documents.  SQL cannot express the learned and randomised stages, so
``ORACLE_SQL`` is None and the tests hold every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.common import written
from tideline.llm.stages import STAGES
from tideline.sources.tables import table

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
