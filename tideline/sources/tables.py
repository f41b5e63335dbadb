"""Stored tables: the flat event table, its stream twin, and reading a sink back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.times import wall_to_instant


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """Stream over ``<name>*.parquet``; zoneless ``ts`` becomes an instant so it can be watermarked."""
    schema = spark.read.parquet(f"{folder}/{name}*.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(f"{folder}/{name}*.parquet")
    for field in schema.fields:
        if field.dataType.typeName() == "timestamp_ntz":
            stream = stream.withColumn(field.name, wall_to_instant(field.name))
    return stream


def read_back(spark: SparkSession, path: str, sql: str, args: dict | None = None, view: str = "sink") -> DataFrame:
    """Run SQL over a table a sink has written; ``{sink}`` in the text names it."""
    return spark.sql(sql, args=args or {}, **{view: spark.read.parquet(path)})


def read_back_jdbc(spark: SparkSession, url: str, sql: str, **options: str) -> DataFrame:
    """The same against a database, with the query pushed down to it."""
    return spark.read.format("jdbc").options(url=url, query=sql, **options).load()


def ordered(df: DataFrame, *columns: str, limit: int | None = None) -> DataFrame:
    """ORDER BY with an optional LIMIT (planned as a distributed top-k)."""
    result = df.orderBy(*[F.col(c) for c in columns])
    return result if limit is None else result.limit(limit)
