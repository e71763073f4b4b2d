"""Loading the parquet tables the operators run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def as_instants(df: DataFrame) -> DataFrame:
    """Naive parquet timestamps (TIMESTAMP_NTZ) become UTC instants.

    The session zone is UTC, so the cast keeps the wall-clock value.
    """
    cols = [F.col(f.name).cast(T.TimestampType()).alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def as_naive(df: DataFrame) -> DataFrame:
    """Inverse of :func:`as_instants` for outputs compared with naive readers."""
    cols = [F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table with instants in UTC; projection/filters still push down."""
    return as_instants(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL by name (lazy, nothing is copied)."""
    df.createOrReplaceTempView(name)
    return df


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        register_view(table(spark, sf_dir, n), n)
