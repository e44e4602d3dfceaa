"""Registered source jobs: landing JSON written from the driver tables, read
back through the bronze ingest (explicit schema, flatten, name contract,
audit columns)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from ..sources import bronze, landing
from ..streaming.ingest import incremental_ingest
from ..streaming.refresh import read_silver, read_sketches, refresh_from_stream
from .catalog import register
from .catalog_listings import _SILVER, _STG, _with
from .landing_pages import pages_from_tables, write_landing
from .listings import BRONZE_COLUMNS, DRIVER_AS_OF, DRIVER_NON_RESIDENTIAL, source_stamp

LOADED_AT = _dt.datetime(2024, 2, 1)  # the load instant stamped on a full load
STREAMED_AT = _dt.datetime(2024, 2, 4)  # ... and on the incremental batches

# Bronze holds text; these are compared as numbers.
NUMBERS = ["MAREA", "AREAPRIVADA", "MVALORARRIENDO", "DATA.MVALORADMINISTRACION", "LOCALIZACION.LON",
           "LOCALIZACION.LAT"]

_LANDED: dict[tuple, dict[str, str]] = {}


def _landed(spark, sf_dir) -> dict[str, str]:
    """Landing folders as the portal would have delivered them: all pages, and
    the even and odd pages apart.  They stand in for files that already exist
    upstream, so they are written once per session and set of inputs."""
    key = (spark.sparkContext.applicationId, source_stamp(spark, sf_dir))
    if key not in _LANDED:
        root = scratch_path(spark, "landing")
        pages = materialize(pages_from_tables(spark, sf_dir), "pages")     # three writes of one job's pages
        write_landing(pages, f"{root}/all")
        for k, name in enumerate(("even", "odd")):
            write_landing(pages.where(F.col("page") % 2 == k), f"{root}/{name}")
        _LANDED[key] = {n: f"{root}/{n}" for n in ("all", "even", "odd")}
    return _LANDED[key]


def land_fixtures(spark, sf_dir) -> None:
    """Write the landing pages before anything is timed."""
    _landed(spark, sf_dir)


def _typed(df):
    return df.select(*[F.col(f"`{c}`").cast("double").alias(c) if c in NUMBERS else F.col(f"`{c}`")
                       for c in df.columns if c not in ("LOAD_ID", "LOAD_DATE")])


_OBS = """
WITH obs AS (
  SELECT n.n_name AS city, e.event_id, e.user_id, e.value, p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice,
         p.p_partkey, c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal
  FROM events e JOIN part p ON p.p_partkey = e.user_id JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey)
"""


def _bronze_sql(loaded: str, load_type: str) -> str:
    return f"""
SELECT CAST(user_id AS VARCHAR) AS "MIDINMUEBLE", CAST(c_nationkey AS VARCHAR) AS "MIDEMPRESA", c_name AS "TITLE",
       '/listing/' || CAST(event_id AS VARCHAR) AS "LINK", p_name AS "MBARRIO", substr(p_name, 2) AS "MNOMBRECOMUNBARRIO",
       city AS "MCIUDAD.NOMBRE",
       CASE p_size % 7 WHEN 0 THEN '' WHEN 1 THEN '-' ELSE p_brand END AS "MZONA.NOMBRE",
       p_retailprice AS "MAREA", p_retailprice * 0.9 AS "AREAPRIVADA",
       CAST(p_size % 6 AS VARCHAR) || '+' AS "MNROCUARTOS",
       CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size % 4 AS VARCHAR) END AS "MNROBANOS",
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size % 3 AS VARCHAR) END AS "MNROGARAJES",
       CAST(p_size % 6 + 1 AS VARCHAR) AS "ESTRATO", value AS "MVALORARRIENDO",
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE c_acctbal / 100 END AS "DATA.MVALORADMINISTRACION",
       CAST(-75.5 AS DOUBLE) + CAST(c_custkey % 100 AS DOUBLE) / CAST(1000 AS DOUBLE) AS "LOCALIZACION.LON",
       CAST(6.2 AS DOUBLE) + CAST(p_partkey % 100 AS DOUBLE) / CAST(1000 AS DOUBLE) AS "LOCALIZACION.LAT",
       p_type AS "MTIPOINMUEBLE.NOMBRE", {loaded} AS "UPLOADED_DATE", {load_type} AS "LOAD_TYPE"
FROM obs"""


_FULL_AT, _STREAM_AT = "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-02-04 00:00:00'"
# even pages come with the full load, odd pages with the stream
_EVEN = "(event_id // 50) % 2 = 0"
_TWO_LOADS = (f"CASE WHEN {_EVEN} THEN {_FULL_AT} ELSE {_STREAM_AT} END",
              f"CASE WHEN {_EVEN} THEN 'FULL' ELSE 'INCREMENTAL' END")


@register("landing_bronze", _OBS + _bronze_sql(_FULL_AT, "'FULL'"))
def landing_bronze(spark, sf_dir):
    pages = landing.read_pages(spark, _landed(spark, sf_dir)["all"])
    return _typed(landing.to_bronze(pages, LOADED_AT, "FULL"))


@register("catalog_summary", _OBS + """
SELECT city, count(*) AS total_entries, count(*) AS listings_seen, count(DISTINCT event_id // 50) AS pages
FROM obs GROUP BY city""")
def catalog_summary(spark, sf_dir):
    return landing.require_catalog(landing.catalog_summary(landing.read_pages(spark, _landed(spark, sf_dir)["all"])))


def _full_and_stream(spark, sf_dir) -> str:
    """Bronze of a full load of the even pages and two stream runs over the odd
    ones (the second run finds nothing new)."""
    land, root = _landed(spark, sf_dir), scratch_path(spark, "bronze-two-loads")
    landing.full_load(spark, land["even"], f"{root}/bronze", loaded_at=LOADED_AT)
    for _ in range(2):
        incremental_ingest(spark, land["odd"], f"{root}/bronze", f"{root}/checkpoint", max_files_per_trigger=40,
                           loaded_at=STREAMED_AT).awaitTermination()
    return root


@register("stream_bronze", _OBS + _bronze_sql(*_TWO_LOADS))
def stream_bronze(spark, sf_dir):
    """A9-A12, S1: FULL and INCREMENTAL loads in one bronze layer, read back."""
    return _typed(bronze.read_loads(spark, f"{_full_and_stream(spark, sf_dir)}/bronze"))


@register("refresh_silver", _with(_STG.replace("e.ts AS extracted_at", f"{_TWO_LOADS[0]} AS extracted_at").replace(
    "CASE WHEN day(e.ts) = 1 THEN 'FULL' ELSE 'INCREMENTAL' END", _TWO_LOADS[1]), _SILVER) + "SELECT * FROM silver")
def refresh_silver(spark, sf_dir):
    """S2: the snapshot state fed by the stream of bronze loads, read as silver."""
    root = _full_and_stream(spark, sf_dir)
    refresh_from_stream(spark, f"{root}/bronze", f"{root}/state", f"{root}/refresh-checkpoint").awaitTermination()
    return read_silver(spark, f"{root}/state", as_of=DRIVER_AS_OF, non_residential=DRIVER_NON_RESIDENTIAL)


def _drifted(rows):
    """Loaded rows as another source would write them: numbers instead of text."""
    return _typed(rows).drop("LOAD_TYPE").withColumn("LOAD_DATE", F.to_date("UPLOADED_DATE"))


@register("refresh_silver_drift", _with(_STG.replace("e.ts AS extracted_at", f"{_TWO_LOADS[0]} AS extracted_at").replace(
    "CASE WHEN day(e.ts) = 1 THEN 'FULL' ELSE 'INCREMENTAL' END", _TWO_LOADS[1]), _SILVER) + "SELECT * FROM silver")
def refresh_silver_drift(spark, sf_dir):
    """S2 over loads whose types drift: text, then numbers, one load a batch."""
    land, root = _landed(spark, sf_dir), scratch_path(spark, "refresh-drift")
    landing.full_load(spark, land["even"], f"{root}/bronze", loaded_at=LOADED_AT)
    odd = landing.to_bronze(landing.read_pages(spark, land["odd"]), STREAMED_AT, "INCREMENTAL")
    bronze.write_load(_drifted(odd), f"{root}/bronze", "INCREMENTAL", "drifted")
    refresh_from_stream(spark, f"{root}/bronze", f"{root}/state", f"{root}/checkpoint", loads_per_trigger=1).awaitTermination()
    return read_silver(spark, f"{root}/state", as_of=DRIVER_AS_OF, non_residential=DRIVER_NON_RESIDENTIAL)


@register("market_sketches", _with(_STG.replace("e.ts AS extracted_at", f"{_TWO_LOADS[0]} AS extracted_at").replace(
    "CASE WHEN day(e.ts) = 1 THEN 'FULL' ELSE 'INCREMENTAL' END", _TWO_LOADS[1])) + """
SELECT city_name, '2024-02' AS month, count(*) AS n_sightings, count(DISTINCT property_id) AS n_properties,
       CAST(min(rent_value) AS DOUBLE) AS lowest, CAST(max(rent_value) AS DOUBLE) AS highest,
       CAST(quantile_disc(rent_value, 0.5) AS DOUBLE) AS median_rent
FROM stg GROUP BY city_name""")
def market_sketches(spark, sf_dir):
    """Distinct properties and median rent of all sightings, from the sketches
    that the refresh keeps beside its state, merged over two batches."""
    land, root = _landed(spark, sf_dir), scratch_path(spark, "sketches")
    landing.full_load(spark, land["even"], f"{root}/bronze", loaded_at=LOADED_AT)
    landing.load(spark, landing.read_pages(spark, land["odd"]), f"{root}/bronze", "odd", "INCREMENTAL", STREAMED_AT)
    refresh_from_stream(spark, f"{root}/bronze", f"{root}/state", f"{root}/checkpoint", loads_per_trigger=1).awaitTermination()
    m = read_sketches(spark, f"{root}/state")
    return m.select("city_name", "month", F.col("n").alias("n_sightings"), F.col("n_members").alias("n_properties"), "lowest", "highest",
                    F.col("median").alias("median_rent"))


@register("load_contract", _OBS + f"""
SELECT city, count(*) AS n_listings, 'MVALORARRIENDO' AS missing, 1 AS n_loads FROM obs WHERE {_EVEN} GROUP BY city""")
def load_contract(spark, sf_dir):
    """A7, A9: a load is written again from pages without the rent.  The
    contract fails it before anything is published: the load reads as before."""
    land, path = _landed(spark, sf_dir), scratch_path(spark, "load-contract")
    landing.full_load(spark, land["even"], path, loaded_at=LOADED_AT, load_id="monthly")
    pages = landing.read_pages(spark, land["odd"])
    without = F.transform("results", lambda x: F.map_filter(x, lambda k, _: k != "mvalorarriendo"))
    try:
        landing.load(spark, pages.withColumn("results", without), path, "monthly", "FULL", LOADED_AT)
        missing = ""
    except ValueError as failed:
        missing = ",".join(c for c in BRONZE_COLUMNS if f"'{c}'" in str(failed))
    rows = bronze.read_loads(spark, path)
    return rows.groupBy(F.col("`MCIUDAD.NOMBRE`").alias("city")).agg(
        F.count(F.lit(1)).alias("n_listings"), F.lit(missing).alias("missing"), F.count_distinct("LOAD_ID").cast("int").alias("n_loads"))


# a leaf that is NULL is not in the page
_LEAVES = {"MNROBANOS": "p_size % 5 <> 0", "MNROGARAJES": "p_size % 3 <> 0", "DATA.MVALORADMINISTRACION": "event_id % 4 <> 0"}


@register("landing_leaves", _OBS + "\nUNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) AS n_values, count(DISTINCT city) AS n_cities FROM obs WHERE {_LEAVES.get(c, 'true')}"
    for c in BRONZE_COLUMNS))
def landing_leaves(spark, sf_dir):
    """A3, A4: all leaves of all listings, whatever their depth, by dotted name."""
    listed = landing.listings(landing.read_pages(spark, _landed(spark, sf_dir)["all"]))
    return landing.leaves(listed, ["city"], underscore_to_dot=True).groupBy("name").agg(
        F.count("value").alias("n_values"), F.count_distinct("city").alias("n_cities"))


@register("bronze_union", _OBS + _bronze_sql(*_TWO_LOADS))
def bronze_union(spark, sf_dir):
    """A12: two loads whose types drifted (text against numbers), unioned by name."""
    land, path = _landed(spark, sf_dir), scratch_path(spark, "bronze-drift")
    landing.full_load(spark, land["even"], path, loaded_at=LOADED_AT)
    odd = landing.to_bronze(landing.read_pages(spark, land["odd"]), STREAMED_AT, "INCREMENTAL")
    bronze.write_load(_drifted(odd), path, "INCREMENTAL", "drifted")
    return _typed(bronze.read_loads(spark, path))


@register("landing_fallback", _OBS + _bronze_sql(_FULL_AT, "'FULL'"))
def landing_fallback(spark, sf_dir):
    """A5, A6: pages whose odd listings spell the city without nesting, and all
    of which repeat the link under an upper-case name."""
    text = spark.read.schema("value string, city string").text(_landed(spark, sf_dir)["all"])
    flat = F.regexp_replace("value", '("link":"/listing/[0-9]*[13579]"[^{}]*"mciudad":)\\{"nombre":("[^"]*")\\}', "$1$2")
    twice = F.regexp_replace(flat, '("link":"[^"]*")', '$1,"LINK":"later"')
    pages = text.select(F.from_json(twice, landing.PAGE_SCHEMA).alias("page")).select("page.*")
    return _typed(landing.to_bronze(pages, LOADED_AT, "FULL"))
