"""The whole listing build as one Spark job graph (the source project's
"run, then test" cycle, without a scheduler):

  staging      temp view over bronze (lazy, like a view model)
  intermediate silver and transformation written as parquet tables
  contracts    run on silver *before* the marts are published; optionally
               raising, so bad rows do not reach the marts
  mart         dim_geo, dim_feature, dim_date, fact_listing, gold_depth

Every table is written once under ``root`` (a shared folder) and the next
model reads it back, so each model is computed once and a lost executor only
recomputes from the last written table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from . import star
from .listings import NON_RESIDENTIAL_TYPES, silver, transformation

CONTRACTS = dict(unique=["property_id"], not_null=["property_id", "rent_value"],
                 non_negative=["rent_value", "rooms", "bathrooms", "garages", "total_area",
                               "administration_value"])


def write_table(df: DataFrame, root: str, schema: str, name: str) -> DataFrame:
    """CTAS into ``root/schema/name`` (overwrite) and read it back."""
    path = os.path.join(root, schema, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_as_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """CTAS into the session catalog (optionally at an explicit location)."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def build(spark: SparkSession, staging_df: DataFrame, seed: DataFrame, root: str, as_of=None,
          non_residential=NON_RESIDENTIAL_TYPES, enforce_contracts: bool = False) -> dict[str, DataFrame]:
    staging_df.createOrReplaceTempView("staging_listings")
    out: dict[str, DataFrame] = {"staging": spark.table("staging_listings")}
    out["silver"] = write_table(silver(out["staging"], as_of=as_of, non_residential=non_residential),
                                root, "intermediate", "silver")
    out["contracts"] = write_table(quality.contract_report(out["silver"], **CONTRACTS), root, "intermediate",
                                   "contracts")
    if enforce_contracts:
        quality.assert_contracts(out["contracts"])
    tr = write_table(transformation(out["silver"], seed), root, "intermediate", "transformation")
    out["transformation"] = tr
    for name, fn in (("dim_geo", star.dim_geo), ("dim_feature", star.dim_feature), ("dim_date", star.dim_date),
                     ("fact_listing", star.fact_listing), ("gold_depth", star.gold_depth)):
        out[name] = write_table(fn(tr), root, "mart", name)
    return out
