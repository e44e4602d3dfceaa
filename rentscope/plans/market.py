"""Market measures over the standardized listings (the BI report's numbers)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ordered
from ..operators.quantiles import median_by

LOCATION = ["city_name", "neighborhood_final"]


def price_per_m2(tr: DataFrame):
    return F.try_divide(F.col("rent_value").cast("double"), F.col("total_area").cast("double"))


def liquidity(tr: DataFrame) -> DataFrame:
    """Median days on market vs median rent, per city."""
    return median_by(tr, "city_name",
                     {"median_days_on_market": F.col("days_on_market"),
                      "median_rent": F.col("rent_value")},
                     extra=[F.count(F.lit(1)).alias("n_listings")])


def rent_per_m2(tr: DataFrame) -> DataFrame:
    return median_by(tr, LOCATION, {"median_rent_per_m2": price_per_m2(tr)},
                     extra=[F.count(F.lit(1)).alias("n_listings")])


def layout_profile(tr: DataFrame, min_listings: int = 2) -> DataFrame:
    """Median layout of locations deep enough to be in the gold table."""
    m = median_by(tr, LOCATION, {"median_area": F.col("total_area"), "median_rooms": F.col("rooms"),
                                 "median_bathrooms": F.col("bathrooms"),
                                 "median_garages": F.col("garages")},
                  extra=[F.count(F.lit(1)).alias("n_listings")])
    return m.filter(F.col("n_listings") >= min_listings)


def stratum_supply(tr: DataFrame) -> DataFrame:
    return median_by(tr, "socioeconomic_stratum", {"median_rent": F.col("rent_value")},
                     extra=[F.count(F.lit(1)).alias("n_listings"),
                            F.count_if(F.col("property_status") == "ACTIVE").cast("bigint").alias("n_active")])


def affordability_rank(tr: DataFrame, n: int = 3, rows_per_slot: int | None = None) -> DataFrame:
    """Cheapest and priciest neighborhoods per city by median rent.

    Two skew-safe ordered scans over one row per neighborhood (a city with a
    third of all neighborhoods is still ranked by many tasks).  Ties on the
    median are broken by the neighborhood name in both directions; NULL medians
    sort last in both."""
    rows = tr.count()
    m = median_by(tr, LOCATION, {"median_rent": F.col("rent_value")}, rows=rows, rows_per_slot=rows_per_slot)
    # NULL names last: a flag before the name
    m = m.withColumn("_unnamed", F.col("neighborhood_final").isNull())
    ties = ["_unnamed", "neighborhood_final"]
    for descending, out in ((False, "rank_cheapest"), (True, "rank_priciest")):
        m = ordered.ordered_scan(m, ["city_name"], "median_rent", ties, None, descending, True, rows=rows,
                                 rows_per_slot=rows_per_slot) \
            .withColumnRenamed(ordered.RANK, out).drop(ordered.CUM, ordered.COUNT, ordered.TOTAL)
    return m.drop("_unnamed").filter((F.col("rank_cheapest") <= n) | (F.col("rank_priciest") <= n))


def top_depth(tr: DataFrame, n: int = 20) -> DataFrame:
    g = tr.groupBy(*LOCATION).agg(F.count(F.lit(1)).alias("n_listings"))
    return g.orderBy(F.col("n_listings").desc(), *[F.col(c).asc() for c in LOCATION]).limit(n)
