"""Data-quality contracts: each returns the violating rows; the suite runs
every contract in one aggregation pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once (NULLs excluded)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def not_null_violations(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col(column).isNull()).select(*keep, column)


def non_negative_violations(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows where column < 0; NULL never violates."""
    return df.where(F.col(column) < 0).select(*keep, column)


def violations_long(df: DataFrame, columns: Sequence[str], contract: str, keep: Sequence[str] = ()) -> DataFrame:
    """All violations of one contract over several columns in ONE pass:
    each row is unpivoted into (column_name, value) pairs and filtered, so
    the table is read once however many columns are checked.  ``contract``
    is "not_null" or "non_negative"."""
    if contract == "not_null":
        flag = lambda c: F.col(c).isNull()
    elif contract == "non_negative":
        flag = lambda c: F.coalesce(F.col(c) < 0, F.lit(False))
    else:
        raise ValueError(contract)
    fields = lambda c: [F.lit(c).alias("column_name"), flag(c).alias("_bad")] + (
        [F.col(c).cast("double").alias("value")] if contract == "non_negative" else [])
    pairs = F.array(*[F.struct(*fields(c)) for c in columns])
    long = df.select(*keep, F.explode(pairs).alias("_kv")).select(*keep, "_kv.*")
    out = ["column_name", *keep] + (["value"] if contract == "non_negative" else [])
    return long.where(F.col("_bad")).select(*out)


def contract_report(df: DataFrame, unique: Sequence[str] = (), not_null: Sequence[str] = (),
                    non_negative: Sequence[str] = ()) -> DataFrame:
    """(contract, column_name, failures, passed) for every contract.

    not_null / non_negative are count_if aggregates in one pass; each unique
    contract is a grouped count (partial aggregate) folded to one number."""
    exprs = []
    for c in not_null:
        exprs.append(F.struct(F.lit("not_null").alias("contract"), F.lit(c).alias("column_name"),
                              F.count_if(F.col(c).isNull()).cast("bigint").alias("failures")))
    for c in non_negative:
        exprs.append(F.struct(F.lit("non_negative").alias("contract"), F.lit(c).alias("column_name"),
                              F.count_if(F.col(c) < 0).cast("bigint").alias("failures")))
    parts = []
    if exprs:
        one = df.agg(F.array(*exprs).alias("r"))
        parts.append(one.select(F.explode("r").alias("r")).select("r.*"))
    for c in unique:
        # one failing row per duplicated value, as the unique contract reports
        u = unique_violations(df, c).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
        parts.append(u.select(F.lit("unique").alias("contract"), F.lit(c).alias("column_name"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def assert_contracts(report: DataFrame) -> None:
    """Raise if any contract failed (collects one small row per contract)."""
    bad = [r for r in report.where(~F.col("passed")).collect()]
    if bad:
        raise ValueError("data-quality contracts failed: " +
                         ", ".join(f"{r.contract}({r.column_name})={r.failures}" for r in bad))
