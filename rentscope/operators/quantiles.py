"""Exact medians of several measures per group, in one pass over the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered
from .slots import ROWS_PER_SLOT


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def median_by(df: DataFrame, by, values: dict[str, Column], extra: list | None = None, rows: int | None = None,
              rows_per_slot: int | None = None) -> DataFrame:
    """Exact median (midpoint of the two middle values for even counts) of
    each expression in ``values`` per group, plus optional extra aggregates.

    The built-in median merges a group's values into one buffer: it serves a
    table whose rows fit one slot (``rows``, counted unless given).  Otherwise
    the middle rows are found through slots and no group is ever buffered."""
    by = [by] if isinstance(by, str) else list(by)
    n = df.count() if rows is None else rows
    if n * len(values) <= (rows_per_slot or ROWS_PER_SLOT):
        aggs = [F.median(expr.cast("double")).alias(name) for name, expr in values.items()]
        return df.groupBy(*by).agg(*(extra or []), *aggs)
    # All measures in ONE ordered scan: stack them as (group, measure, value).
    pairs = [F.struct(F.lit(name).alias("_m"), expr.cast("double").alias("_v")) for name, expr in values.items()]
    long = df.select(*by, F.explode(F.array(*pairs)).alias("_kv")).select(*by, "_kv._m", "_kv._v")
    med = ordered.median(long, by + ["_m"], "_v", out="_med", rows=n * len(values), rows_per_slot=rows_per_slot)
    wide = med.groupBy(*by).agg(*[F.max(F.when(F.col("_m") == name, F.col("_med"))).alias(name)
                                  for name in values])
    base = df.groupBy(*by).agg(*extra) if extra else df.select(*by).distinct()
    return join_null_safe(base, wide, by)
