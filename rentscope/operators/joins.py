"""Join-shaped operators.

Broadcasts here are only of sides whose size is bounded by construction (a
one-row aggregate, a top-k); everything else is a plain join that AQE turns
into a broadcast at runtime when the measured side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps as a skew-split
sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """LEFT JOIN ... WHERE right.key IS NULL, written as the anti join it is."""
    return left.join(right, on=on, how="left_anti")


def above_group_avg(df: DataFrame, by, x: str, out: str = "group_avg") -> DataFrame:
    """Rows whose value exceeds their group's average (aggregate joined back)."""
    avg = df.groupBy(by).agg(F.avg(x).alias(out))
    return df.join(avg, on=by).filter(F.col(x) > F.col(out))


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The row is a scalar subquery (computed once, then used as a value), so no
    join -- cross, nested-loop or otherwise -- is planned."""
    packed = scalar.select(F.struct(*scalar.columns).alias("_s")).scalar()
    out = df.withColumn("_s", packed)
    return out.select(*df.columns, *[F.col(f"_s.{c}").alias(c) for c in scalar.columns])


def groups_above_mean_total(df: DataFrame, by, x: str, total: str = "total") -> DataFrame:
    """Group totals that exceed the mean of all group totals."""
    g = df.groupBy(by).agg(F.sum(x).alias(total))
    m = g.agg(F.avg(total).alias("_mean"))
    return with_scalar(g, m).filter(F.col(total) > F.col("_mean")).drop("_mean")


def max_below_max(df: DataFrame, x: str, out: str) -> DataFrame:
    """MAX(x) WHERE x < (SELECT MAX(x)): one row, NULL when no such value."""
    top = df.select(F.max(x)).scalar()
    return df.where(F.col(x) < top).agg(F.max(x).alias(out))


def offset_date_join(left: DataFrame, right: DataFrame, on, left_date: Column,
                     right_date: Column, days: int) -> DataFrame:
    """Equi-join on ``on`` plus right_date = left_date + days."""
    return left.join(right, on=on).filter(right_date == F.date_add(left_date, days))
