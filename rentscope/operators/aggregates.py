"""Grouped aggregates.  All aggregate partially on the map side (hash
aggregates, or sort aggregates where a value is not of fixed width), so a hot
key is reduced in every input partition before the shuffle and never reaches
one task as raw rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import folds


def count_histogram(df: DataFrame, key: str, bucket: str = "bucket", n: str = "n_keys") -> DataFrame:
    """How many keys have 1, 2, 3, ... rows (two-level aggregate)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias(bucket))
    return per_key.groupBy(bucket).agg(F.count(F.lit(1)).alias(n))


def has_all(df: DataFrame, key: str, item: str, required: Sequence, distinct: bool = True,
            out: str = "n_matched") -> DataFrame:
    """Relational division: keys that have every value in ``required``.

    ``distinct=False`` counts rows like the source formula (duplicates can
    then satisfy it); the default counts distinct values."""
    req = list(required)
    f = df.filter(F.col(item).isin(*req))
    agg = F.count_distinct(item) if distinct else F.count(item)
    return f.groupBy(key).agg(agg.alias(out)).filter(F.col(out) == len(req))


def cond_pivot(df: DataFrame, cond: Column, true_name: str, false_name: str) -> DataFrame:
    """One-row conditional counts (sum of CASE) over the whole table."""
    return df.agg(F.count_if(~cond).cast("bigint").alias(false_name),
                  F.count_if(cond).cast("bigint").alias(true_name))


def day_span(df: DataFrame, key: str, ts: str, min_span: int = 1, out: str = "days_between") -> DataFrame:
    """Whole-day span between first and last date per key, kept if > min_span."""
    g = df.groupBy(key).agg(F.datediff(F.max(F.to_date(ts)), F.min(F.to_date(ts))).cast("bigint").alias(out))
    return g.filter(F.col(out) > min_span)


def duplicate_groups(df: DataFrame, keys: Sequence[str], out: str = "duplicate_groups") -> DataFrame:
    """Number of key groups that occur more than once."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return g.agg(F.count(F.lit(1)).alias(out))


def keys_with_min_rows(df: DataFrame, key: str, n: int, out: str = "n_keys") -> DataFrame:
    g = df.groupBy(key).agg(F.count(key).alias("_n")).filter(F.col("_n") >= n)
    return g.agg(F.count(F.lit(1)).alias(out))


def signed_sum(df: DataFrame, by, x: str, negative_when: Column, out: str) -> DataFrame:
    return df.groupBy(by).agg(F.sum(F.when(negative_when, -F.col(x)).otherwise(F.col(x))).alias(out))


def group_range(df: DataFrame, by, x: str, out: str = "difference") -> DataFrame:
    return df.groupBy(by).agg((F.max(x) - F.min(x)).alias(out))


def weighted_mean(df: DataFrame, x: str, w: str, out: str = "weighted_mean", digits: int = 1) -> DataFrame:
    return df.agg(F.round(F.try_divide(F.sum(F.col(x) * F.col(w)).cast("double"),
                                       F.sum(w).cast("double")), digits).alias(out))


def invert_index(df: DataFrame, key: str, value: str, out: str = "keys", entries: int = folds.ENTRIES) -> DataFrame:
    """value -> sorted lists of distinct keys, of a bounded size: (value, part,
    parts, out); a value of more keys has several rows (see ``operators.folds``).

    Pairs are de-duplicated first, by a partial aggregate."""
    pairs = df.select(value, key).where(F.col(key).isNotNull()).distinct()
    return folds.lists(pairs, [value], key, out, entries)


def word_frequency(df: DataFrame, words_col: Column, out_word: str = "word", out_n: str = "n") -> DataFrame:
    """Token frequency over whole texts: explode, drop empty tokens, then a
    partially aggregated count (each task pre-counts its words before the
    shuffle, so a very frequent word never reaches one task as raw rows)."""
    return (df.select(F.explode(words_col).alias(out_word))
              .where(F.length(out_word) > 0)
              .groupBy(out_word).agg(F.count(F.lit(1)).alias(out_n)))
