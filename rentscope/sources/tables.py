"""Readers for the parquet tables the jobs run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Parquet scan of one table; naming columns lets the scan prune early."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def growing(df: DataFrame) -> DataFrame:
    """A join side that grows with the input: joins to it are merged.

    A scan's size is planned from its files as they are packed, so a table of a few
    MB on disk may be hundreds in memory, all of them through the driver, if it is
    broadcast.  Tables of a fixed size (nations) are left to the planner."""
    return df.hint("merge")
