"""Landing pages built by Spark from the driver tables: the listings of
``observations_from_tables`` grouped into pages of up to 50 consecutive
sightings per city, as the portal would serve them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import growing, table

PAGE_SIZE = 50  # fixed value: listings per portal page


def pages_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "user_id", "value")
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    j = (e.join(growing(p), e.user_id == p.p_partkey).join(growing(c), e.user_id == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey))
    size = F.col("p_size")
    listing = F.struct(
        F.col("user_id").cast("string").alias("midinmueble"),
        F.col("c_nationkey").cast("string").alias("midempresa"),
        F.col("c_name").alias("title"),
        F.concat(F.lit("/listing/"), F.col("event_id").cast("string")).alias("link"),
        F.col("p_name").alias("mbarrio"),
        F.expr("substring(p_name, 2)").alias("mnombrecomunbarrio"),
        F.struct(F.col("n_name").alias("nombre")).alias("mciudad"),
        F.struct(F.when(size % 7 == 0, F.lit("")).when(size % 7 == 1, F.lit("-"))
                  .otherwise(F.col("p_brand")).alias("nombre")).alias("mzona"),
        F.col("p_retailprice").alias("marea"),
        (F.col("p_retailprice") * 0.9).alias("areaprivada"),
        F.concat((size % 6).cast("string"), F.lit("+")).alias("mnrocuartos"),
        F.when(size % 5 == 0, F.lit(None).cast("string")).otherwise((size % 4).cast("string")).alias("mnrobanos"),
        F.when(size % 3 == 0, F.lit(None).cast("string")).otherwise((size % 3).cast("string")).alias("mnrogarajes"),
        (size % 6 + 1).cast("string").alias("estrato"),
        F.col("value").alias("mvalorarriendo"),
        F.struct(F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("double"))
                  .otherwise(F.col("c_acctbal") / 100).alias("mvaloradministracion")).alias("data"),
        F.struct((F.lit(-75.5) + (F.col("c_custkey") % 100) / 1000.0).alias("lon"),
                 (F.lit(6.2) + (F.col("p_partkey") % 100) / 1000.0).alias("lat")).alias("localizacion"),
        F.struct(F.col("p_type").alias("nombre")).alias("mtipoinmueble"),
    )
    rows = j.select(F.col("n_name").alias("city"), F.expr(f"event_id div {PAGE_SIZE}").alias("page"),
                    listing.alias("l"))
    pages = rows.groupBy("city", "page").agg(F.collect_list("l").alias("results"))
    totals = rows.groupBy("city").agg(F.count(F.lit(1)).alias("totalEntries"))
    return pages.join(totals, "city").select("city", "page", "totalEntries", "results")


def write_landing(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, one folder per city."""
    (pages.select("city", F.to_json(F.struct("totalEntries", "results")).alias("value"))
          .write.mode(mode).partitionBy("city").text(path))
