"""Ranking, running and share operators.

Every operator here partitions by its group keys, so the window's exchange is
a hash shuffle on those keys.  Where a group can be hot, the operator is
written as a partial aggregation instead (``latest_per_key``,
``share_of_group``) or is pre-pruned before the shuffle (rank filters become
WindowGroupLimit).  ``running_total``, ``ntile_per_group`` and ``pareto``
keep the plain window form for groups known to be small; the registered jobs
use the skew-safe forms in ``operators.ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list:
    if xs is None:
        return []
    if isinstance(xs, (str, Column)):
        return [xs]
    return list(xs)


def latest_per_key(df: DataFrame, keys, order: Sequence[str], carry: Sequence[str] | None = None,
                   first_col: str | None = None, last_col: str | None = None) -> DataFrame:
    """Newest row per key, plus first/last values of ``order[0]``.

    ``max_by(struct(carry), struct(order))`` is partially aggregated on the map
    side, so a key holding a third of all rows is reduced per input partition
    before anything is shuffled (a ``row_number`` window would send all of
    that key's rows to one task).  ``order`` lists the recency column first and
    tie-breaks after it, making the pick deterministic.
    """
    keys = _cols(keys)
    carry = [c for c in (carry or df.columns) if c not in keys]
    ts = order[0]
    aggs = [F.max_by(F.struct(*carry), F.struct(*order)).alias("_latest")]
    if first_col:
        aggs.append(F.min(ts).alias(first_col))
    if last_col:
        aggs.append(F.max(ts).alias(last_col))
    out = df.groupBy(*keys).agg(*aggs)
    extra = [c for c in (first_col, last_col) if c]
    return out.select(*keys, "_latest.*", *extra)


def top_n_per_group(df: DataFrame, by, order: Sequence[Column], n: int,
                    rank_col: str = "rn") -> DataFrame:
    """row_number() <= n per group; Spark prunes each partition to n rows per
    group before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*_cols(by)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def nth_per_key(df: DataFrame, by, order: Sequence[Column], n: int) -> DataFrame:
    """The n-th row per key (row_number = n)."""
    w = Window.partitionBy(*_cols(by)).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == n).drop("_rn"))


def share_of_group(df: DataFrame, by, x: str, out: str = "pct") -> DataFrame:
    """100 * x / group total (NULL when the total is 0).

    The group total is a partial aggregate joined back, which keeps hot groups
    split across tasks; a ``sum() over (partition by)`` would not."""
    by = _cols(by)
    tot = df.groupBy(*by).agg(F.sum(x).alias("_tot"))
    tot = tot.select(*[F.col(c).alias(f"_g_{c}") for c in by], "_tot")
    cond = F.lit(True)
    for c in by:  # NULL keys form one group, as in PARTITION BY
        cond = cond & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return (df.join(tot, cond, "left")
              .withColumn(out, F.lit(100.0) * F.try_divide(F.col(x), F.nullif(F.col("_tot"), F.lit(0))))
              .drop("_tot", *[f"_g_{c}" for c in by]))


def running_total(df: DataFrame, by, order: Sequence[Column], x: str, out: str = "running") -> DataFrame:
    w = Window.partitionBy(*_cols(by)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(x).over(w))


def ntile_per_group(df: DataFrame, by, order: Sequence[Column], n: int, out: str = "tile") -> DataFrame:
    w = Window.partitionBy(*_cols(by)).orderBy(*order)
    return df.withColumn(out, F.ntile(n).over(w))


def global_dense_top(df: DataFrame, x: str, n: int, out: str = "dense_rank",
                     descending: bool = True, only: int | None = None) -> DataFrame:
    """DENSE_RANK() OVER (ORDER BY x) <= n without a one-task global window.

    The n best distinct values are a top-k (TakeOrderedAndProject, a bounded
    per-partition heap), ranked among themselves (n rows), then broadcast back
    to the data: the broadcast side holds at most n rows by construction.
    ``only`` keeps a single rank (e.g. 2 for "second highest").
    """
    vals = df.select(x).distinct()
    o = F.col(x).desc() if descending else F.col(x).asc()  # the window's own NULL placement
    top = vals.orderBy(o).limit(n)
    ranked = top.withColumn(out, F.dense_rank().over(Window.orderBy(o)))
    if only is not None:
        ranked = ranked.filter(F.col(out) == only)
    ranked = ranked.withColumnRenamed(x, "_top_x")
    return (df.join(F.broadcast(ranked), F.col(x).eqNullSafe(F.col("_top_x")), "inner")
              .drop("_top_x"))


def pareto(df: DataFrame, by, x: str, tiebreak: Sequence[Column], cut: float = 80.0) -> DataFrame:
    """Rows whose cumulative share of their group's total is <= cut percent.

    One partitioning by ``by`` serves the running sum, the group total and the
    dense rank (same partition keys -> one exchange).  The row that crosses the
    cut is excluded, as in the source."""
    by = _cols(by)
    order = [F.col(x).desc()] + list(tiebreak)
    w_run = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*by)
    w_rank = Window.partitionBy(*by).orderBy(F.col(x).desc())
    out = (df.withColumn("cum_value", F.sum(x).over(w_run))
             .withColumn("group_total", F.sum(x).over(w_all))
             .withColumn("ranking", F.dense_rank().over(w_rank))
             .withColumn("cum_pct", F.lit(100.0) * F.try_divide(F.col("cum_value"), F.col("group_total"))))
    return out.filter(F.col("cum_pct") <= cut)
