"""Star schema over the standardized listings: three dimensions with md5
surrogate keys, one fact, the depth gold table and the BI star join.

Dimensions are made unique per key (a grouped pick), so joining the fact to
them can never fan out; key text is portable across engines (key_text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import concat_skip_nulls, key_text, surrogate_key

LINK_BASE = "https://www.example.com"  # site prefix for relative listing links (parameter)


def geo_key(df: DataFrame):
    return surrogate_key(F.col("city_name"), F.col("neighborhood_final"))


def feature_key(df: DataFrame):
    parts = [key_text(F.col(c), df.schema[c].dataType)
             for c in ("socioeconomic_stratum", "rooms", "bathrooms", "garages", "total_area")]
    parts = [F.coalesce(p, F.lit("0")) for p in parts] + [F.col("property_type")]
    return surrogate_key(*parts)


def date_key(df: DataFrame):
    return F.md5(F.col("extracted_at").cast("string"))


def _one_row(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """One existing row per key: the largest as a whole, never a mix of rows."""
    return df.groupBy(key).agg(F.max(F.struct(*attrs)).alias("r")).select(key, "r.*")


def dim_geo(tr: DataFrame) -> DataFrame:
    k = tr.select(geo_key(tr).alias("geo_key"), "city_name", "neighborhood_final")
    return _one_row(k, "geo_key", ["city_name", "neighborhood_final"])


def dim_feature(tr: DataFrame) -> DataFrame:
    attrs = ["socioeconomic_stratum", "rooms", "bathrooms", "garages", "total_area", "property_type"]
    k = tr.select(feature_key(tr).alias("feature_key"), *attrs)
    return _one_row(k, "feature_key", attrs)


def dim_date(tr: DataFrame) -> DataFrame:
    return (tr.select("extracted_at").distinct()
              .select(date_key(tr).alias("date_key"), "extracted_at",
                      F.year("extracted_at").alias("year"), F.month("extracted_at").alias("month")))


def fact_listing(tr: DataFrame, link_base: str = LINK_BASE) -> DataFrame:
    return tr.select(
        "property_id", "property_status",
        date_key(tr).alias("fk_date"),
        geo_key(tr).alias("geo_fk"),
        feature_key(tr).alias("feature_fk"),
        F.col("rent_value").alias("reting_price"),  # fixed value: the mart's published column name (sic)
        F.coalesce(F.col("administration_value"), F.lit(0.0).cast("float")).alias("administration_value"),
        "days_on_market", "days_off_market", "longitude", "latitude",
        concat_skip_nulls(F.lit(link_base), F.col("property_link")).alias("link"),
    )


def gold_depth(tr: DataFrame) -> DataFrame:
    """Listings per (neighborhood, city) with more than one listing; NULL
    neighborhoods count 0 and drop out."""
    g = tr.groupBy("neighborhood_final", "city_name").agg(
        F.count("neighborhood_final").alias("neighborhood_per_city"))
    return g.filter(F.col("neighborhood_per_city") > 1).orderBy(F.col("neighborhood_per_city").desc())


def star_join(fact: DataFrame, geo: DataFrame, feat: DataFrame, date: DataFrame) -> DataFrame:
    """Fact widened with its dimensions.  Dimension sizes grow with distinct
    attributes, not rows, so no broadcast is forced: AQE broadcasts them when
    measured small and keeps sort-merge joins otherwise."""
    j = (fact.join(geo, fact.geo_fk == geo.geo_key, "left")
             .join(feat, fact.feature_fk == feat.feature_key, "left")
             .join(date, fact.fk_date == date.date_key, "left"))
    return j.select("property_id", "property_status", "city_name", "neighborhood_final",
                    "property_type", "socioeconomic_stratum", "rooms", "year", "month",
                    "reting_price", "days_on_market")
