"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space between words, as the operators' contracts write it.
WORD_SPACE = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside an expression: ``let(x, f)`` is ``f(x)``
    with ``x`` evaluated a single time per row (a one-element transform)."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Runs of characters other than space and U+0009-U+000D; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SPACE), "")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Fewer rows per Arrow batch, so that a batch of long texts stays small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with small batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)
