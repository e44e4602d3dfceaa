"""The README's end-to-end flow, run on pages derived from the driver tables."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rentscope.plans import warehouse
from rentscope.plans.landing_pages import pages_from_tables, write_landing
from rentscope.plans.listings import driver_seed, staging
from rentscope.sources import bronze, landing
from rentscope.streaming.ingest import incremental_ingest
from rentscope.streaming.refresh import read_silver, refresh_from_stream


def test_readme_flow(spark):
    root = tempfile.mkdtemp(prefix="rentscope-usage-")
    p = {k: os.path.join(root, k) for k in ("landing", "later", "bronze", "seed", "wh", "state", "ck1", "ck2")}
    pages = pages_from_tables(spark, SF_SMALL)
    write_landing(pages.where(F.col("page") % 2 == 0), p["landing"])
    write_landing(pages.where(F.col("page") % 2 == 1), p["later"])
    driver_seed(spark, SF_SMALL).write.option("header", True).csv(p["seed"])

    landing.full_load(spark, p["landing"], p["bronze"])
    rows = bronze.read_loads(spark, p["bronze"], load_types=["FULL"])
    marts = warehouse.build(spark, staging(rows),
                            landing.read_seed(spark, p["seed"]), p["wh"])
    n_props = rows.select("MIDINMUEBLE").distinct().count()
    assert marts["silver"].count() == n_props == marts["fact_listing"].count()
    assert marts["transformation"].where(F.col("neighborhood_final").isNull()).count() == 0

    incremental_ingest(spark, p["later"], p["bronze"], p["ck1"]).awaitTermination()
    refresh_from_stream(spark, p["bronze"], p["state"], p["ck2"]).awaitTermination()
    now = read_silver(spark, p["state"])
    everything = bronze.read_loads(spark, p["bronze"])
    assert everything.count() == pages.select(F.sum(F.size("results"))).first()[0]
    assert now.count() == everything.select("MIDINMUEBLE").distinct().count() >= n_props
