"""Registered jobs along time, on ranks, and over several groupings at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import cubes, ordered, temporal
from ..session import scratch_path
from ..sources.tables import table
from . import star, warehouse
from .catalog import register
from .catalog_listings import L_STG, L_TR
from .listings import driver_staging, driver_transformation

# rows of a slot: small, so that the ranges are in use at every scale
SLOT = 20_000


# ---- along time ---------------------------------------------------------------

def _events(spark, sf_dir, kinds=None):
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return e.where(F.col("event_type").isin(*kinds)) if kinds else e


@register("price_as_of", """
SELECT l.event_id, l.user_id, l.ts, r.ts AS ts_as_of, r.value AS price
FROM (SELECT * FROM events WHERE event_type <> 'purchase') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def price_as_of(spark, sf_dir):
    """The price valid at each sighting: the property's last purchase at or before it."""
    e = _events(spark, sf_dir)
    right = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("price"))
    left = e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    return temporal.as_of_join(left, right, ["user_id"], "ts", ["price"], rows_per_slot=SLOT)


@register("price_as_of_day", """
SELECT l.event_id, CASE WHEN l.ts - r.ts <= INTERVAL 24 HOUR THEN r.value END AS price
FROM (SELECT * FROM events WHERE event_type <> 'purchase') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def price_as_of_day(spark, sf_dir):
    """The same, unless the price is older than a day."""
    e = _events(spark, sf_dir)
    right = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("price"))
    left = e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    found = temporal.as_of_join(left, right, ["user_id"], "ts", ["price"], max_age_seconds=86_400, rows_per_slot=SLOT)
    return found.select("event_id", "price")


@register("offers_open", """
SELECT p.event_id, count(i.event_id) AS n_open, coalesce(sum(i.event_id), 0)::BIGINT AS ids
FROM (SELECT * FROM events WHERE event_type = 'click') p
LEFT JOIN (SELECT event_id, user_id, ts, ts + to_minutes(CAST(floor(value * 10) AS BIGINT)) AS until FROM events
           WHERE event_type = 'purchase') i
  ON p.user_id = i.user_id AND p.ts >= i.ts AND p.ts < i.until
GROUP BY p.event_id""")
def offers_open(spark, sf_dir):
    """Offers open at each click: a purchase opens an offer of ten minutes per unit of value."""
    e = _events(spark, sf_dir)
    offers = e.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("opened"), F.col("event_id").alias("offer"),
        (F.col("ts") + F.make_dt_interval(mins=F.floor(F.col("value") * 10).cast("int"))).alias("until"))
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    hits = temporal.interval_join(clicks, offers, ["user_id"], "ts", "opened", "until", ["offer"], how="left")
    return hits.groupBy("event_id").agg(F.count("offer").alias("n_open"), F.coalesce(F.sum("offer"), F.lit(0)).alias("ids"))


@register("rent_changes", L_STG + """
, seen AS (SELECT property_id, extracted_at, rooms_count, CAST(rent_value / 50 AS INTEGER) AS band FROM stg),
old AS (SELECT *, lag(band) OVER w AS previous, row_number() OVER w AS r FROM seen
        WINDOW w AS (PARTITION BY property_id ORDER BY extracted_at)),
opened AS (SELECT * FROM old WHERE r = 1 OR band IS DISTINCT FROM previous)
SELECT property_id, band, extracted_at AS valid_from, lead(extracted_at) OVER (PARTITION BY property_id ORDER BY extracted_at) AS valid_to,
       previous FROM opened""")
def rent_changes(spark, sf_dir):
    """History of each property's rent band as periods of validity."""
    seen = driver_staging(spark, sf_dir).select(
        "property_id", "extracted_at", F.bround(F.col("rent_value") / F.lit(50).cast("float")).cast("int").alias("band"))
    return temporal.changes(seen, "property_id", "extracted_at", "band", rows_per_slot=SLOT)


# ---- ranks --------------------------------------------------------------------

@register("price_position", """
SELECT l_returnflag, l_extendedprice, count(*) AS n_rows, round(max(p), 9) AS percent_rank, round(max(c), 9) AS cume_dist FROM (
  SELECT l_returnflag, l_extendedprice, percent_rank() OVER w AS p, cume_dist() OVER w AS c FROM lineitem
  WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice)) t
GROUP BY l_returnflag, l_extendedprice""")
def price_position(spark, sf_dir):
    """Where a price stands among those of its flag."""
    li = table(spark, sf_dir, "lineitem", "l_returnflag", "l_extendedprice", "l_orderkey")
    r = ordered.relative_ranks(li, "l_returnflag", "l_extendedprice", ties=["l_orderkey"], rows_per_slot=SLOT)
    return r.groupBy("l_returnflag", "l_extendedprice").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.max("percent_rank"), 9).alias("percent_rank"),
        F.round(F.max("cume_dist"), 9).alias("cume_dist"))


@register("quantity_running", """
SELECT l_returnflag, l_quantity, count(*) AS n_rows, max(d) AS dense, CAST(max(s) AS DOUBLE) AS running, max(t) AS last_tile FROM (
  SELECT l_returnflag, l_quantity, dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS d,
         sum(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS s,
         ntile(7) OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC, l_orderkey, l_partkey, l_linenumber, l_suppkey) AS t
  FROM lineitem) q GROUP BY l_returnflag, l_quantity""")
def quantity_running(spark, sf_dir):
    """E5, E6, E9 where few values hold all rows: each is cut by its tie-breaks."""
    li = table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity", "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    ties = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]
    s = ordered.ordered_scan(li, ["l_returnflag"], "l_quantity", ties, "l_quantity", descending=True, dense=True, rows_per_slot=SLOT) \
        .withColumnsRenamed({ordered.CUM: "s", ordered.DENSE: "d"})
    # the tiles follow the order of the running sums: one scan numbers the rows for both
    s = ordered.ntile(s, "l_returnflag", "l_quantity", ties, 7, rows_per_slot=SLOT, scanned=True)
    return s.groupBy("l_returnflag", "l_quantity").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("d").alias("dense"), F.max("s").cast("double").alias("running"),
        F.max("tile").cast("bigint").alias("last_tile"))


# ---- several groupings at once --------------------------------------------------

_MEASURES = """count(rent_value) AS n, round(avg(CAST(rent_value AS DOUBLE)), 4) AS mean, CAST(min(rent_value) AS DOUBLE) AS lowest,
       CAST(max(rent_value) AS DOUBLE) AS highest, CAST(quantile_disc(rent_value, 0.5) AS DOUBLE) AS median,
       count(DISTINCT property_id) AS n_members"""


def _measured(grouped):
    m = cubes.measures(grouped)
    return m.withColumn("mean", F.round("mean", 4))


def _fine(spark, sf_dir, by):
    return cubes.states(driver_transformation(spark, sf_dir), by, F.col("rent_value"), F.col("property_id"))


@register("market_cube", L_TR + f"""
SELECT city_name, socioeconomic_stratum, concat_ws(',', CASE WHEN grouping(city_name) = 0 THEN 'city_name' END,
       CASE WHEN grouping(socioeconomic_stratum) = 0 THEN 'socioeconomic_stratum' END) AS level, {_MEASURES}
FROM tr GROUP BY CUBE (city_name, socioeconomic_stratum)""")
def market_cube(spark, sf_dir):
    by = ["city_name", "socioeconomic_stratum"]
    return _measured(cubes.cube(_fine(spark, sf_dir, by), by))


@register("market_rollup", L_TR + f"""
SELECT city_name, neighborhood_final, concat_ws(',', CASE WHEN grouping(city_name) = 0 THEN 'city_name' END,
       CASE WHEN grouping(neighborhood_final) = 0 THEN 'neighborhood_final' END) AS level, {_MEASURES}
FROM tr GROUP BY ROLLUP (city_name, neighborhood_final)""")
def market_rollup(spark, sf_dir):
    by = ["city_name", "neighborhood_final"]
    return _measured(cubes.rollup(_fine(spark, sf_dir, by), by))


@register("market_sets", L_TR + f"""
SELECT city_name, socioeconomic_stratum, property_type,
       concat_ws(',', CASE WHEN grouping(city_name) = 0 THEN 'city_name' END,
       CASE WHEN grouping(socioeconomic_stratum) = 0 THEN 'socioeconomic_stratum' END,
       CASE WHEN grouping(property_type) = 0 THEN 'property_type' END) AS level, {_MEASURES}
FROM tr GROUP BY GROUPING SETS ((city_name, property_type), (socioeconomic_stratum), ())""")
def market_sets(spark, sf_dir):
    by = ["city_name", "socioeconomic_stratum", "property_type"]
    return _measured(cubes.grouping_sets(_fine(spark, sf_dir, by), by, [["city_name", "property_type"], ["socioeconomic_stratum"], []]))


# ---- forms of listed operators that had no entry ---------------------------------

@register("has_all_rows", """
SELECT user_day, count(event_type) AS n_matched
FROM (SELECT user_id || ' ' || CAST(CAST(ts AS DATE) AS VARCHAR) AS user_day, event_type FROM events) e
WHERE event_type IN ('click', 'view', 'purchase') GROUP BY user_day HAVING count(event_type) = 3""")
def has_all_rows(spark, sf_dir):
    """D6 as the source counts it: rows, not values."""
    day = F.concat_ws(" ", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    return agg.has_all(_events(spark, sf_dir).select(day.alias("user_day"), "event_type"), "user_day", "event_type",
                       ["click", "view", "purchase"], distinct=False)


@register("gold_table", L_TR + """
SELECT neighborhood_final, city_name, count(neighborhood_final) AS neighborhood_per_city
FROM tr GROUP BY neighborhood_final, city_name HAVING count(neighborhood_final) > 1""")
def gold_table(spark, sf_dir):
    """A14: the depth table created in the catalog from its query, read by name."""
    path = scratch_path(spark, "gold_table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    warehouse.save_as_table(star.gold_depth(driver_transformation(spark, sf_dir)), name, path)
    return spark.table(name)
