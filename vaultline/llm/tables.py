"""Helpers shared by the operators: inputs, materialised tables, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.session import scratch_path

BROADCAST_ROWS = 1_000_000     # a side of narrow rows is broadcast up to this count (about 32 MB)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage
    is cut, and a lost executor costs a read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are within the
    limit; else unmarked, so that the join shuffles both sides."""
    return F.broadcast(df) if rows <= limit else df


def column_named(df: DataFrame, name: str):
    """The column with exactly this name (names with dots included)."""
    return F.col(f"`{name}`")
