"""Grouping sets over mergeable measures.

Rows are aggregated once, at the finest grouping, into mergeable states: counts,
sums, extremes, a KLL sketch for quantiles and an HLL sketch for distinct
counts.  Grouping sets, rollups and cubes then merge these states: the rows are
multiplied by the number of sets only after they have become groups.  The
states are plain columns, so they can be stored and merged later on
(``streaming.refresh`` keeps them beside its buckets).

Quantiles are exact while a group has no more rows than ``k`` and have a rank
error of about 1.7 / k beyond; distinct counts likewise, some 1.6 % at 4096 bins.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 4096
LG_BINS = 12
STATE = ["n", "total", "lowest", "highest", "quantiles", "members"]


def states(df: DataFrame, by: Sequence, value: Column, member: Column, k: int = K) -> DataFrame:
    """(by, state columns) of a numeric value and of the members counted once each."""
    v = value.cast("double")
    return df.groupBy(*by).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("lowest"), F.max(v).alias("highest"),
        F.kll_sketch_agg_double(v, F.lit(k)).alias("quantiles"), F.hll_sketch_agg(member, F.lit(LG_BINS)).alias("members"))


def merged() -> list[Column]:
    """Aggregates that merge states."""
    return [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
            F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("quantiles"))).alias("quantiles"), F.hll_union_agg("members").alias("members")]


def measures(grouped: DataFrame, quantile: float = 0.5, name: str = "median") -> DataFrame:
    """States read as n, mean, lowest, highest, a quantile and the distinct count."""
    others = [c for c in grouped.columns if c not in STATE]
    return grouped.select(
        *others, "n", F.try_divide("total", "n").alias("mean"), "lowest", "highest",
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(quantile))).alias(name),
        F.hll_sketch_estimate("members").alias("n_members"))


def grouping_sets(fine: DataFrame, by: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Merged states for several groupings of the finest one; ``level`` names the
    columns of a row's grouping, those outside are NULL."""
    marks = F.concat_ws(",", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in by])
    return fine.groupingSets([[F.col(c) for c in s] for s in sets], *by).agg(marks.alias("level"), *merged())


def rollup(fine: DataFrame, by: Sequence[str]) -> DataFrame:
    return grouping_sets(fine, by, [by[:k] for k in range(len(by), -1, -1)])


def cube(fine: DataFrame, by: Sequence[str]) -> DataFrame:
    return grouping_sets(fine, by, [s for k in range(len(by), -1, -1) for s in combinations(by, k)])
