import datetime as dt

from pyspark.sql import functions as F

from rentscope.operators import quality
from rentscope.plans import star


def _tr(spark, rows):
    schema = ("property_id string, property_status string, extracted_at timestamp_ntz, city_name string, "
              "neighborhood_final string, socioeconomic_stratum int, rooms int, bathrooms int, garages int, "
              "total_area float, property_type string, rent_value float, administration_value float, "
              "days_on_market bigint, days_off_market bigint, longitude float, latitude float, property_link string")
    return spark.createDataFrame(rows, schema)


def test_geo_key_fixture(spark):
    df = spark.createDataFrame([("a", None)], "city_name string, neighborhood_final string")
    assert df.select(star.geo_key(df).alias("k")).first().k == "d538f78051e4b51f0eb2736f4f40addb"


def test_dims_unique_and_fact_keys_resolve(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [
        ("1", "ACTIVE", t, "a", None, 1, None, 0, 1, 50.0, "casa", 10.0, None, 0, 0, 1.0, 2.0, "/x"),
        ("2", "ACTIVE", t, "a", "", 1, 0, 0, 1, 50.0, "casa", 11.0, 5.0, 0, 0, 1.0, 2.0, None),
        ("3", "INACTIVE", t, "b", "n", 2, 1, 1, 1, 1.0e7, "casa", 12.0, 1.0, 3, 9, 1.0, 2.0, "/z"),
    ]
    tr = _tr(spark, rows)
    geo, feat, date = star.dim_geo(tr), star.dim_feature(tr), star.dim_date(tr)
    for d, k in ((geo, "geo_key"), (feat, "feature_key"), (date, "date_key")):
        assert d.count() == d.select(k).distinct().count()
    fact = star.fact_listing(tr, link_base="https://h")
    assert fact.count() == 3
    wide = star.star_join(fact, geo, feat, date)
    assert wide.count() == 3 and wide.where(F.col("year").isNull()).count() == 0
    links = {r.property_id: r.link for r in fact.collect()}
    assert links == {"1": "https://h/x", "2": "https://h", "3": "https://h/z"}  # NULL parts skipped
    adm = {r.property_id: r.administration_value for r in fact.collect()}
    assert adm["1"] == 0.0


def test_gold_depth_drops_singletons_and_nulls(spark):
    df = spark.createDataFrame([("x", "c"), ("x", "c"), ("y", "c"), (None, "c"), (None, "c")],
                               "neighborhood_final string, city_name string")
    got = {(r.neighborhood_final, r.neighborhood_per_city) for r in star.gold_depth(df).collect()}
    assert got == {("x", 2)}


def test_contracts_report_exactly_their_rows(spark):
    cols = ["property_id", "rent_value", "rooms", "bathrooms", "garages", "total_area", "administration_value"]
    rows = [
        ("A", 1.0, 1, 1, 1, 1.0, 1.0),
        ("A", 1.0, 1, 1, 1, 1.0, 1.0),          # duplicate id
        (None, 1.0, 1, 1, 1, 1.0, 1.0),         # NULL id
        ("B", None, 1, 1, 1, 1.0, 1.0),         # NULL rent
        ("C", -1.0, 1, 1, 1, 1.0, 1.0),
        ("D", 1.0, -1, 1, 1, 1.0, 1.0),
        ("E", 1.0, 1, -1, 1, 1.0, 1.0),
        ("F", 1.0, 1, 1, -1, 1.0, 1.0),
        ("G", 1.0, 1, 1, 1, -1.0, 1.0),
        ("H", 1.0, 1, 1, 1, 1.0, -1.0),
        ("I", 1.0, None, None, None, None, None),  # NULL never violates non-negative
    ]
    df = spark.createDataFrame(rows, "property_id string, rent_value double, rooms int, bathrooms int, "
                                     "garages int, total_area double, administration_value double")
    assert [r.property_id for r in quality.unique_violations(df, "property_id").collect()] == ["A"]
    assert quality.not_null_violations(df, "property_id").count() == 1
    assert [r.property_id for r in quality.not_null_violations(df, "rent_value", ["property_id"]).collect()] == ["B"]
    expect = {"rent_value": "C", "rooms": "D", "bathrooms": "E", "garages": "F", "total_area": "G",
              "administration_value": "H"}
    for c, pid in expect.items():
        assert [r.property_id for r in quality.non_negative_violations(df, c, ["property_id"]).collect()] == [pid]
    rep = {(r.contract, r.column_name): (r.failures, r.passed) for r in quality.contract_report(
        df, unique=["property_id"], not_null=["property_id", "rent_value"], non_negative=cols[1:]).collect()}
    assert rep[("unique", "property_id")] == (1, False)
    assert rep[("not_null", "rent_value")] == (1, False)
    assert all(v == (1, False) for k, v in rep.items() if k[0] == "non_negative")
    import pytest
    with pytest.raises(ValueError):
        quality.assert_contracts(quality.contract_report(df, not_null=["rent_value"]))


def test_key_text_is_portable_for_large_and_small_floats(spark):
    from pyspark.sql import types as T

    from rentscope.functions.keys import concat_skip_nulls, key_text
    df = spark.createDataFrame([(1.0e7, 0.0005, None)], "a float, b double, c string")
    r = df.select(key_text(F.col("a"), T.FloatType()).alias("a"), key_text(F.col("b"), T.DoubleType()).alias("b"),
                  concat_skip_nulls(F.lit("x"), F.col("c"), F.lit("-")).alias("c")).first()
    assert (r.a, r.b, r.c) == ("10000000.0000000000", "0.0005000000", "x-")  # never '1.0E7'; NULL parts skipped


def test_dimension_rows_exist_when_keys_collide(spark):
    from rentscope.plans import star
    tr = spark.createDataFrame([("A", "Z-B"), ("A-Z", "B")], "city_name string, neighborhood_final string")
    rows = star.dim_geo(tr).collect()
    assert len(rows) == 1 and (rows[0].city_name, rows[0].neighborhood_final) in {("A", "Z-B"), ("A-Z", "B")}


def test_feature_keys_keep_close_areas_apart(spark):
    from rentscope.plans import star
    tr = spark.createDataFrame([(1, 1, 1, 1, 50.001, "house"), (1, 1, 1, 1, 50.002, "house")],
                               "socioeconomic_stratum int, rooms int, bathrooms int, garages int, total_area float, property_type string")
    assert star.dim_feature(tr).count() == 2

