import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rentscope.plans import warehouse
from rentscope.plans.listings import DRIVER_AS_OF, DRIVER_NON_RESIDENTIAL, driver_seed, driver_staging


def test_build_and_star_invariants(spark):
    root = tempfile.mkdtemp(prefix="rentscope-wh-")
    out = warehouse.build(spark, driver_staging(spark, SF_SMALL), driver_seed(spark, SF_SMALL), root,
                          as_of=DRIVER_AS_OF, non_residential=DRIVER_NON_RESIDENTIAL)
    for m in ("silver", "transformation", "dim_geo", "fact_listing"):
        assert os.path.isdir(os.path.join(root, "mart" if m in ("dim_geo", "fact_listing") else "intermediate", m))
    s = out["silver"]
    assert s.count() == s.select("property_id").distinct().count()  # one row per property
    fact = out["fact_listing"]
    for fk, dim, key in (("geo_fk", "dim_geo", "geo_key"), ("feature_fk", "dim_feature", "feature_key"),
                         ("fk_date", "dim_date", "date_key")):
        d = out[dim].groupBy(key).count()
        j = fact.join(d, fact[fk] == d[key], "left")
        assert j.where(F.col("count").isNull() | (F.col("count") != 1)).count() == 0, dim
    rep = {(r.contract, r.column_name): r.failures for r in out["contracts"].collect()}
    assert rep[("unique", "property_id")] == 0 and rep[("not_null", "property_id")] == 0
    assert rep[("non_negative", "administration_value")] > 0  # negative fees exist in the mapping
    with pytest.raises(ValueError):
        warehouse.build(spark, driver_staging(spark, SF_SMALL), driver_seed(spark, SF_SMALL),
                        tempfile.mkdtemp(prefix="rentscope-wh-"), as_of=DRIVER_AS_OF,
                        non_residential=DRIVER_NON_RESIDENTIAL, enforce_contracts=True)


def test_save_as_table(spark):
    loc = os.path.join(tempfile.mkdtemp(prefix="rentscope-ctas-"), "t")
    warehouse.save_as_table(spark.range(5), "ctas_probe", path=loc)
    assert spark.table("ctas_probe").count() == 5
