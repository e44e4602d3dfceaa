"""Company register derived from the driver tables, stored as text the way
a CLOB export arrives: '$' prefixes, signs, and some cells that are not
numbers at all.  ``keep_numeric`` types it either by dropping bad rows
(strict) or by nulling bad cells (lenient)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import SIGNED_MONEY, UNSIGNED_INT, UNSIGNED_MONEY, strip_dollar
from ..sources.tables import table

MONEY_COLUMNS = ["operating_revenue", "profit", "total_assets", "total_liabilities", "total_equity"]
SIGNED_IN_STRICT = {"profit", "total_equity"}
INT_COLUMNS = ["nit", "ciiu", "cutoff_year"]
TEXT_COLUMNS = ["company_name", "supervisor", "region", "department", "city", "macrosector"]
COLUMNS = ["nit", "company_name", "supervisor", "region", "department", "city", "ciiu", "macrosector",
           "operating_revenue", "profit", "total_assets", "total_liabilities", "total_equity", "cutoff_year"]


def _fmt(x: Column) -> Column:
    return x.cast("decimal(14,2)").cast("string")


def companies_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    m40 = k % 40
    revenue = (F.when(m40 == 3, F.lit("1,000")).when(m40 == 5, F.lit("1e5")).when(m40 == 9, F.lit(""))
                .when(m40 == 11, F.lit(None).cast("string"))
                .otherwise(F.concat(F.lit("$"), _fmt(F.abs(bal)))))
    assets = F.concat(F.when(m40 == 13, F.lit("-")).otherwise(F.lit("$")), _fmt(F.abs(bal) + 1000))
    return j.select(
        F.when(k % 50 == 7, F.concat(F.lit("NIT-"), k.cast("string"))).otherwise(k.cast("string")).alias("nit"),
        F.col("c_name").alias("company_name"),
        F.col("r_name").alias("supervisor"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("department"),
        F.concat(F.col("n_name"), F.lit(" CITY")).alias("city"),
        F.when(k % 70 == 2, F.lit("46A9"))
         .otherwise((F.col("c_nationkey") * 100 + F.col("r_regionkey")).cast("string")).alias("ciiu"),
        F.col("c_mktsegment").alias("macrosector"),
        revenue.alias("operating_revenue"),
        F.concat(F.lit("$"), _fmt(bal)).alias("profit"),
        assets.alias("total_assets"),
        F.concat(F.lit("$"), _fmt(F.abs(bal) + 500)).alias("total_liabilities"),
        F.concat(F.lit("$"), _fmt(bal - 500)).alias("total_equity"),
        F.when(k % 60 == 1, F.lit("FY23")).otherwise(F.lit("2023")).alias("cutoff_year"),
    )


def _to_money(c: Column) -> Column:
    return strip_dollar(c).cast("decimal(38,2)").cast("double")


def keep_numeric(df: DataFrame, mode: str = "drop") -> DataFrame:
    """Type the numeric text columns.

    ``mode="drop"``: keep only rows where every numeric cell matches its
    pattern (a sign allowed only on profit and equity).  ``mode="null"``: keep
    every row, NULL each cell that does not match (sign allowed everywhere).
    A bare try_cast is not used: it would also accept '1e5'."""
    if mode == "drop":
        conds = [F.col(c).rlike(UNSIGNED_INT) for c in INT_COLUMNS]
        conds += [strip_dollar(F.col(c)).rlike(SIGNED_MONEY if c in SIGNED_IN_STRICT else UNSIGNED_MONEY)
                  for c in MONEY_COLUMNS]
        ok = conds[0]
        for x in conds[1:]:
            ok = ok & x
        kept = df.where(ok)
        typed = {c: F.col(c).cast("bigint") for c in INT_COLUMNS}
        typed.update({c: _to_money(F.col(c)) for c in MONEY_COLUMNS})
    elif mode == "null":
        kept = df
        typed = {c: F.when(F.col(c).rlike(UNSIGNED_INT), F.col(c).cast("bigint")) for c in INT_COLUMNS}
        typed.update({c: F.when(strip_dollar(F.col(c)).rlike(SIGNED_MONEY), _to_money(F.col(c)))
                      for c in MONEY_COLUMNS})
    else:
        raise ValueError(mode)
    return kept.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in COLUMNS])
