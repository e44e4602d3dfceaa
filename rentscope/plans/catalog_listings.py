"""Registered listing jobs (staging, silver, fuzzy, star schema, contracts,
market measures) over listing observations derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..session import scratch_path
from ..sources import landing
from . import market, star, warehouse
from .catalog import register
from .listings import (DRIVER_AS_OF, DRIVER_NON_RESIDENTIAL, build_model, driver_seed, driver_silver, driver_staging,
                       driver_transformation)

# ---------------------------------------------------------------------------
# Oracle: the same derivation written independently in DuckDB SQL.
# ---------------------------------------------------------------------------

_STG = r"""
stg AS (
  SELECT CAST(e.user_id AS VARCHAR) AS property_id,
         CAST(c.c_nationkey AS VARCHAR) AS company_id,
         c.c_name AS property_title,
         '/listing/' || CAST(e.event_id AS VARCHAR) AS property_link,
         p.p_name AS neighborhood,
         substr(p.p_name, 2) AS common_neighborhood_name,
         p.p_type AS property_type,
         n.n_name AS city_name,
         CASE p.p_size % 7 WHEN 0 THEN '' WHEN 1 THEN '-' ELSE p.p_brand END AS zone_name,
         CAST(p.p_retailprice AS FLOAT) AS total_area,
         TRY_CAST(regexp_replace(CAST(p.p_size % 6 AS VARCHAR) || '+', '[^0-9]+', '', 'g') AS INTEGER) AS rooms_count,
         CASE WHEN p.p_size % 5 = 0 THEN NULL
              ELSE TRY_CAST(regexp_replace(CAST(p.p_size % 4 AS VARCHAR), '[^0-9]+', '', 'g') AS INTEGER) END AS bathrooms_count,
         CASE WHEN p.p_size % 3 = 0 THEN NULL ELSE CAST(p.p_size % 3 AS INTEGER) END AS garages_count,
         TRY_CAST(CAST(p.p_size % 6 + 1 AS VARCHAR) AS INTEGER) AS socioeconomic_stratum,
         CAST(e.value AS FLOAT) AS rent_value,
         CAST(CASE WHEN e.event_id % 4 = 0 THEN NULL ELSE c.c_acctbal / 100.0 END AS FLOAT) AS administration_value,
         CAST(CAST(-75.5 AS DOUBLE) + CAST(c.c_custkey % 100 AS DOUBLE) / CAST(1000 AS DOUBLE) AS FLOAT) AS longitude,
         CAST(CAST(6.2 AS DOUBLE) + CAST(p.p_partkey % 100 AS DOUBLE) / CAST(1000 AS DOUBLE) AS FLOAT) AS latitude,
         e.ts AS extracted_at,
         CASE WHEN day(e.ts) = 1 THEN 'FULL' ELSE 'INCREMENTAL' END AS load_type
  FROM events e
  JOIN part p ON p.p_partkey = e.user_id
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey)"""

_SILVER = r"""
latest AS (
  SELECT * FROM (
    SELECT *,
           row_number() OVER (PARTITION BY property_id
                              ORDER BY extracted_at DESC, property_link DESC, property_title DESC) AS rn,
           min(extracted_at) OVER (PARTITION BY property_id) AS first_seen,
           max(extracted_at) OVER (PARTITION BY property_id) AS last_seen
    FROM stg) t
  WHERE rn = 1),
aged AS (
  SELECT *, date_diff('day', CAST(extracted_at AS DATE), DATE '2024-02-06') AS ref_days,
         lower(property_type) IN ('economy', 'promo') AS nonres
  FROM latest),
silver AS (
  SELECT property_id, company_id, property_title, property_link, neighborhood,
         upper(common_neighborhood_name) AS common_neighborhood_name, property_type, city_name,
         CASE WHEN zone_name IN ('', '-') THEN NULL ELSE zone_name END AS zone_name,
         total_area, socioeconomic_stratum, rent_value, longitude, latitude, extracted_at, load_type,
         CASE WHEN ref_days > 7 THEN 'INACTIVE' ELSE 'ACTIVE' END AS property_status,
         ref_days AS reference_days,
         date_diff('day', CAST(first_seen AS DATE), CAST(last_seen AS DATE)) AS days_on_market,
         CASE WHEN ref_days > 7 THEN ref_days ELSE CAST(0 AS BIGINT) END AS days_off_market,
         CASE WHEN nonres THEN 0 ELSE rooms_count END AS rooms,
         CASE WHEN nonres AND bathrooms_count IS NULL THEN 0 ELSE bathrooms_count END AS bathrooms,
         CASE WHEN nonres AND garages_count IS NULL THEN 0 ELSE garages_count END AS garages,
         CASE WHEN nonres AND administration_value IS NULL THEN CAST(0 AS FLOAT)
              ELSE administration_value END AS administration_value
  FROM aged)"""

_FUZZY = r"""
seed AS (
  SELECT DISTINCT n.n_name AS city_name, upper(p.p_name) AS official
  FROM (SELECT DISTINCT user_id FROM events) u
  JOIN part p ON p.p_partkey = u.user_id
  JOIN customer c ON c.c_custkey = u.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey),
qn AS (
  SELECT DISTINCT city_name, common_neighborhood_name AS nm FROM silver
  WHERE common_neighborhood_name IS NOT NULL AND city_name <> ''),
qs AS (
  SELECT city_name, nm,
         array_to_string(list_sort(list_filter(regexp_split_to_array(trim(nm), '\s+'), lambda x: length(x) > 0)), ' ') AS a
  FROM qn),
ss AS (
  SELECT city_name, official,
         array_to_string(list_sort(list_filter(regexp_split_to_array(trim(official), '\s+'), lambda x: length(x) > 0)), ' ') AS b
  FROM seed),
pairs AS (
  SELECT q.city_name, q.nm, s.official, q.a, s.b FROM qs q JOIN ss s ON q.city_name = s.city_name),
scored AS (
  SELECT city_name, nm, official,
         CASE WHEN length(a) + length(b) = 0 THEN 100.0
              ELSE 200.0 * (CASE WHEN length(a) = 0 OR length(b) = 0 THEN 0 ELSE
                list_reduce(range(1, length(a) + 1),
                  lambda prev, i: list_reduce(range(1, length(b) + 1),
                    lambda cur, j: list_append(cur,
                      CASE WHEN substr(a, i, 1) = substr(b, j, 1) THEN prev[j] + 1
                           ELSE greatest(prev[j + 1], cur[j]) END),
                    [0]),
                  list_resize([0], length(b) + 1, 0))[-1] END) / (length(a) + length(b)) END AS score
  FROM pairs),
best AS (
  SELECT city_name, nm, official FROM (
    SELECT *, row_number() OVER (PARTITION BY city_name, nm ORDER BY score DESC, official ASC) AS r
    FROM scored WHERE score >= 65) t WHERE r = 1),
tr AS (
  SELECT s.*, coalesce(b.official, s.common_neighborhood_name) AS neighborhood_final
  FROM silver s LEFT JOIN best b
    ON b.city_name = s.city_name AND b.nm = s.common_neighborhood_name)"""

_STAR = r"""
keyed AS (
  SELECT *,
         md5(CAST(extracted_at AS VARCHAR)) AS date_key,
         md5(concat(city_name, '-', neighborhood_final)) AS geo_key,
         md5(concat(coalesce(CAST(socioeconomic_stratum AS VARCHAR), '0'), '-',
                    coalesce(CAST(rooms AS VARCHAR), '0'), '-',
                    coalesce(CAST(bathrooms AS VARCHAR), '0'), '-',
                    coalesce(CAST(garages AS VARCHAR), '0'), '-',
                    coalesce(CAST(CAST(total_area AS DECIMAL(38,10)) AS VARCHAR), '0'), '-',
                    property_type)) AS feature_key
  FROM tr),
d_geo AS (
  SELECT geo_key, city_name, neighborhood_final FROM (
    SELECT DISTINCT ON (geo_key) geo_key, city_name, neighborhood_final FROM keyed
    ORDER BY geo_key, city_name DESC NULLS LAST, neighborhood_final DESC NULLS LAST) t),
d_feature AS (
  SELECT feature_key, socioeconomic_stratum, rooms, bathrooms, garages, total_area, property_type FROM (
    SELECT DISTINCT ON (feature_key) feature_key, socioeconomic_stratum, rooms, bathrooms, garages, total_area,
           property_type
    FROM keyed
    ORDER BY feature_key, socioeconomic_stratum DESC NULLS LAST, rooms DESC NULLS LAST, bathrooms DESC NULLS LAST,
             garages DESC NULLS LAST, total_area DESC NULLS LAST, property_type DESC NULLS LAST) t),
d_date AS (
  SELECT DISTINCT date_key, extracted_at, CAST(year(extracted_at) AS INTEGER) AS year,
         CAST(month(extracted_at) AS INTEGER) AS month
  FROM keyed),
fact AS (
  SELECT property_id, property_status, date_key AS fk_date, geo_key AS geo_fk, feature_key AS feature_fk,
         rent_value AS reting_price, coalesce(administration_value, CAST(0 AS FLOAT)) AS administration_value,
         days_on_market, days_off_market, longitude, latitude,
         concat('https://www.example.com', property_link) AS link
  FROM keyed)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


L_STG = _with(_STG)
L_SILVER = _with(_STG, _SILVER)
L_TR = _with(_STG, _SILVER, _FUZZY)
L_STAR = _with(_STG, _SILVER, _FUZZY, _STAR)


def r4(c):
    return F.round(F.col(c), 4).alias(c)


# ---------------------------------------------------------------------------
# Staging / silver / lifecycle
# ---------------------------------------------------------------------------

@register("staging_listings", L_STG + "SELECT * FROM stg")
def staging_listings(spark, sf_dir):
    return driver_staging(spark, sf_dir)


@register("build_silver", L_SILVER + "SELECT * FROM silver")
def build_silver(spark, sf_dir):
    """Writes the silver table anew; the marts after it read what it wrote."""
    return build_model(spark, sf_dir, "silver")


@register("build_transformation", L_TR + "SELECT * FROM tr")
def build_transformation(spark, sf_dir):
    return build_model(spark, sf_dir, "transformation")


@register("silver_listings", L_SILVER + "SELECT * FROM silver")
def silver_listings(spark, sf_dir):
    return driver_silver(spark, sf_dir)


@register("latest_snapshot", L_SILVER + """
SELECT property_id, extracted_at, rent_value, days_on_market, reference_days, property_status
FROM silver""")
def latest_snapshot(spark, sf_dir):
    return driver_silver(spark, sf_dir).select(
        "property_id", "extracted_at", "rent_value", "days_on_market", "reference_days", "property_status")


@register("days_on_market", L_STG + """
SELECT property_id, min(extracted_at) AS first_seen, max(extracted_at) AS last_seen,
       count(*) AS n_sightings,
       date_diff('day', CAST(min(extracted_at) AS DATE), CAST(max(extracted_at) AS DATE)) AS days_on_market
FROM stg GROUP BY property_id""")
def days_on_market(spark, sf_dir):
    stg = driver_staging(spark, sf_dir)
    g = stg.groupBy("property_id").agg(F.min("extracted_at").alias("first_seen"),
                                       F.max("extracted_at").alias("last_seen"),
                                       F.count(F.lit(1)).alias("n_sightings"))
    return g.withColumn("days_on_market",
                        F.datediff(F.to_date("last_seen"), F.to_date("first_seen")).cast("bigint"))


# ---------------------------------------------------------------------------
# Fuzzy standardization and star schema
# ---------------------------------------------------------------------------

@register("fuzzy_map", L_TR + """
SELECT property_id, city_name, common_neighborhood_name, neighborhood_final FROM tr""")
def fuzzy_map(spark, sf_dir):
    return driver_transformation(spark, sf_dir).select(
        "property_id", "city_name", "common_neighborhood_name", "neighborhood_final")


@register("dim_geo", L_STAR + "SELECT * FROM d_geo")
def dim_geo(spark, sf_dir):
    return star.dim_geo(driver_transformation(spark, sf_dir))


@register("dim_feature", L_STAR + "SELECT * FROM d_feature")
def dim_feature(spark, sf_dir):
    return star.dim_feature(driver_transformation(spark, sf_dir))


@register("dim_date", L_STAR + "SELECT * FROM d_date")
def dim_date(spark, sf_dir):
    return star.dim_date(driver_transformation(spark, sf_dir))


@register("fact_listing", L_STAR + "SELECT * FROM fact")
def fact_listing(spark, sf_dir):
    return star.fact_listing(driver_transformation(spark, sf_dir))


@register("gold_depth", L_TR + """
SELECT neighborhood_final, city_name, count(neighborhood_final) AS neighborhood_per_city
FROM tr GROUP BY neighborhood_final, city_name
HAVING count(neighborhood_final) > 1""")
def gold_depth(spark, sf_dir):
    return star.gold_depth(driver_transformation(spark, sf_dir))


@register("star_join", L_STAR + """
SELECT f.property_id, f.property_status, g.city_name, g.neighborhood_final, d.property_type,
       d.socioeconomic_stratum, d.rooms, t.year, t.month, f.reting_price, f.days_on_market
FROM fact f
LEFT JOIN d_geo g ON f.geo_fk = g.geo_key
LEFT JOIN d_feature d ON f.feature_fk = d.feature_key
LEFT JOIN d_date t ON f.fk_date = t.date_key""")
def star_join(spark, sf_dir):
    # four consumers read the one materialized transformation table
    tr = driver_transformation(spark, sf_dir)
    return star.star_join(star.fact_listing(tr), star.dim_geo(tr), star.dim_feature(tr), star.dim_date(tr))


# ---------------------------------------------------------------------------
# Data-quality contracts
# ---------------------------------------------------------------------------

NON_NEGATIVE = ["rent_value", "rooms", "bathrooms", "garages", "total_area", "administration_value"]


@register("dq_unique", L_STG + """
SELECT property_id, count(*) AS n_rows FROM stg
WHERE property_id IS NOT NULL GROUP BY property_id HAVING count(*) > 1""")
def dq_unique(spark, sf_dir):
    # The unique contract applied to the sightings table (one row per load),
    # where repeated property_ids are expected and must be reported.
    return quality.unique_violations(driver_staging(spark, sf_dir), "property_id")


@register("dq_not_null", L_SILVER + """
SELECT 'property_id' AS column_name, property_id FROM silver WHERE property_id IS NULL
UNION ALL SELECT 'rent_value', property_id FROM silver WHERE rent_value IS NULL
UNION ALL SELECT 'zone_name', property_id FROM silver WHERE zone_name IS NULL
UNION ALL SELECT 'bathrooms', property_id FROM silver WHERE bathrooms IS NULL""")
def dq_not_null(spark, sf_dir):
    return quality.violations_long(driver_silver(spark, sf_dir), ["property_id", "rent_value", "zone_name", "bathrooms"],
                                   "not_null", keep=["property_id"])


@register("dq_non_negative", L_SILVER + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, property_id, CAST({c} AS DOUBLE) AS value FROM silver WHERE {c} < 0"
    for c in NON_NEGATIVE))
def dq_non_negative(spark, sf_dir):
    return quality.violations_long(driver_silver(spark, sf_dir), NON_NEGATIVE, "non_negative",
                                   keep=["property_id"])


@register("dq_report", L_SILVER + """
SELECT contract, column_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (
  SELECT 'not_null' AS contract, 'property_id' AS column_name, count_if(property_id IS NULL) AS failures FROM silver
  UNION ALL SELECT 'not_null', 'rent_value', count_if(rent_value IS NULL) FROM silver
""" + "".join(f"  UNION ALL SELECT 'non_negative', '{c}', count_if({c} < 0) FROM silver\n" for c in NON_NEGATIVE) + """
  UNION ALL SELECT 'unique', 'property_id', count(*) FROM (
     SELECT property_id FROM silver WHERE property_id IS NOT NULL GROUP BY property_id HAVING count(*) > 1) u
) r""")
def dq_report(spark, sf_dir):
    return quality.contract_report(driver_silver(spark, sf_dir), unique=["property_id"],
                                   not_null=["property_id", "rent_value"], non_negative=NON_NEGATIVE)


# ---------------------------------------------------------------------------
# Market measures
# ---------------------------------------------------------------------------

def _median_sql(expr: str, name: str) -> str:
    return f"round(median(CAST({expr} AS DOUBLE)), 4) AS {name}"


@register("liquidity", L_TR + f"""
SELECT city_name, count(*) AS n_listings, {_median_sql('days_on_market', 'median_days_on_market')},
       {_median_sql('rent_value', 'median_rent')}
FROM tr GROUP BY city_name""")
def liquidity(spark, sf_dir):
    return market.liquidity(driver_transformation(spark, sf_dir)).select(
        "city_name", "n_listings", r4("median_days_on_market"), r4("median_rent"))


@register("rent_per_m2", L_TR + f"""
SELECT city_name, neighborhood_final, count(*) AS n_listings,
       round(median(CAST(rent_value AS DOUBLE) / NULLIF(CAST(total_area AS DOUBLE), 0)), 4) AS median_rent_per_m2
FROM tr GROUP BY city_name, neighborhood_final""")
def rent_per_m2(spark, sf_dir):
    return market.rent_per_m2(driver_transformation(spark, sf_dir)).select(
        "city_name", "neighborhood_final", "n_listings", r4("median_rent_per_m2"))


@register("layout_profile", L_TR + f"""
SELECT city_name, neighborhood_final, count(*) AS n_listings,
       {_median_sql('total_area', 'median_area')}, {_median_sql('rooms', 'median_rooms')},
       {_median_sql('bathrooms', 'median_bathrooms')}, {_median_sql('garages', 'median_garages')}
FROM tr GROUP BY city_name, neighborhood_final HAVING count(*) >= 2""")
def layout_profile(spark, sf_dir):
    return market.layout_profile(driver_transformation(spark, sf_dir)).select(
        "city_name", "neighborhood_final", "n_listings", r4("median_area"), r4("median_rooms"),
        r4("median_bathrooms"), r4("median_garages"))


@register("stratum_supply", L_TR + f"""
SELECT socioeconomic_stratum, count(*) AS n_listings,
       CAST(count_if(property_status = 'ACTIVE') AS BIGINT) AS n_active, {_median_sql('rent_value', 'median_rent')}
FROM tr GROUP BY socioeconomic_stratum""")
def stratum_supply(spark, sf_dir):
    return market.stratum_supply(driver_transformation(spark, sf_dir)).select(
        "socioeconomic_stratum", "n_listings", "n_active", r4("median_rent"))


@register("affordability_rank", L_TR + """
SELECT city_name, neighborhood_final, round(median_rent, 4) AS median_rent, rank_cheapest, rank_priciest FROM (
  SELECT *, row_number() OVER (PARTITION BY city_name ORDER BY median_rent ASC NULLS LAST, neighborhood_final ASC NULLS LAST) AS rank_cheapest,
            row_number() OVER (PARTITION BY city_name ORDER BY median_rent DESC NULLS LAST, neighborhood_final ASC NULLS LAST) AS rank_priciest
  FROM (SELECT city_name, neighborhood_final, median(CAST(rent_value AS DOUBLE)) AS median_rent
        FROM tr GROUP BY city_name, neighborhood_final) m) r
WHERE rank_cheapest <= 3 OR rank_priciest <= 3""")
def affordability_rank(spark, sf_dir):
    return market.affordability_rank(driver_transformation(spark, sf_dir)).select(
        "city_name", "neighborhood_final", r4("median_rent"), F.col("rank_cheapest").cast("bigint").alias("rank_cheapest"),
        F.col("rank_priciest").cast("bigint").alias("rank_priciest"))


@register("top20_depth", L_TR + """
SELECT city_name, neighborhood_final, count(*) AS n_listings FROM tr
GROUP BY city_name, neighborhood_final
ORDER BY n_listings DESC, city_name ASC, neighborhood_final ASC LIMIT 20""")
def top20_depth(spark, sf_dir):
    return market.top_depth(driver_transformation(spark, sf_dir), 20)


@register("warehouse_fact", L_STAR + "SELECT * FROM fact")
def warehouse_fact(spark, sf_dir):
    """A13-A15: the whole listing build into a warehouse folder, with the official
    names read from a CSV seed; returns the published fact table."""
    root = scratch_path(spark, "warehouse")
    driver_seed(spark, sf_dir).write.option("header", True).csv(f"{root}/seed")
    built = warehouse.build(spark, driver_staging(spark, sf_dir), landing.read_seed(spark, f"{root}/seed"), root,
                            as_of=DRIVER_AS_OF, non_residential=DRIVER_NON_RESIDENTIAL)
    return built["fact_listing"]


@register("published_depth", L_TR + """
SELECT neighborhood_final, city_name, count(neighborhood_final) AS neighborhood_per_city FROM tr
GROUP BY neighborhood_final, city_name HAVING count(neighborhood_final) > 1
ORDER BY neighborhood_per_city DESC, city_name, neighborhood_final""")
def published_depth(spark, sf_dir):
    """the depth table written in order and read back in that order."""
    path = scratch_path(spark, "depth")
    order = [F.col("neighborhood_per_city").desc(), "city_name", "neighborhood_final"]
    star.gold_depth(driver_transformation(spark, sf_dir)).orderBy(*order).write.parquet(path)
    return spark.read.parquet(path).orderBy(*order)
