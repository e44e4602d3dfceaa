import datetime as dt

from pyspark.sql import Row

from rentscope.plans.listings import SILVER_COLUMNS, STAGING_COLUMNS, silver


def _stg(spark, rows):
    base = {c: None for c in STAGING_COLUMNS}
    full = []
    for r in rows:
        d = dict(base)
        d.update(r)
        full.append(Row(**{c: d[c] for c in STAGING_COLUMNS}))
    schema = ("property_id string, company_id string, property_title string, property_link string, "
              "neighborhood string, common_neighborhood_name string, property_type string, city_name string, "
              "zone_name string, total_area float, rooms_count int, bathrooms_count int, garages_count int, "
              "socioeconomic_stratum int, rent_value float, administration_value float, longitude float, "
              "latitude float, extracted_at timestamp_ntz, load_type string")
    return spark.createDataFrame(full, schema)


def test_worked_case(spark):
    ts = dt.datetime
    df = _stg(spark, [
        dict(property_id="P1", property_type="apartamento", extracted_at=ts(2026, 1, 1, 23, 59), rooms_count=3,
             bathrooms_count=2, garages_count=1, administration_value=100.0, zone_name="", property_link="a"),
        dict(property_id="P1", property_type="apartamento", extracted_at=ts(2026, 1, 12, 0, 1), rooms_count=3,
             bathrooms_count=2, garages_count=1, administration_value=100.0, zone_name="-", property_link="b"),
        dict(property_id="P2", property_type="bodega", extracted_at=ts(2026, 1, 13), rooms_count=2,
             bathrooms_count=None, garages_count=1, administration_value=None, zone_name="NORTE"),
    ])
    out = {r.property_id: r for r in silver(df, as_of=dt.date(2026, 1, 20)).collect()}
    p1, p2 = out["P1"], out["P2"]
    assert (p1.days_on_market, p1.reference_days, p1.property_status, p1.days_off_market) == (11, 8, "INACTIVE", 8)
    assert (p1.rooms, p1.bathrooms, p1.garages, p1.administration_value) == (3, 2, 1, 100.0)
    assert p1.zone_name is None and p1.property_link == "b"
    assert (p2.days_on_market, p2.reference_days, p2.property_status, p2.days_off_market) == (0, 7, "ACTIVE", 0)
    assert (p2.rooms, p2.bathrooms, p2.garages, p2.administration_value) == (0, 0, 1, 0.0)
    assert p2.zone_name == "NORTE"


def test_schema_and_one_row_per_property(spark):
    ts = dt.datetime(2026, 1, 5)
    df = _stg(spark, [
        dict(property_id="P", extracted_at=ts, property_link="x", rent_value=1.0),
        dict(property_id="P", extracted_at=ts, property_link="y", rent_value=2.0),   # tie on time
        dict(property_id=None, extracted_at=ts, property_link="n1"),
        dict(property_id=None, extracted_at=ts, property_link="n2"),
    ])
    out = silver(df, as_of=dt.date(2026, 1, 6))
    assert out.columns == SILVER_COLUMNS
    rows = out.collect()
    assert len(rows) == 2  # one survivor for the NULL key too
    p = [r for r in rows if r.property_id == "P"][0]
    assert p.property_link == "y" and p.rent_value == 2.0  # deterministic tie-break


def test_observations_and_seed_broadcast_no_table_that_grows(spark):
    """Part and customer are merged however small their files look."""
    from conftest import SF_SMALL
    from rentscope.plans.listings import driver_seed, observations_from_tables
    for df in (observations_from_tables(spark, SF_SMALL), driver_seed(spark, SF_SMALL)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        joins = [line for line in plan.splitlines() if "Join [" in line]
        assert any("user_id" in line for line in joins)
        assert not [line for line in joins if "Broadcast" in line and "user_id" in line], plan


def test_names_and_seed_are_not_broadcast_by_the_size_of_their_files(spark):
    from rentscope.operators.standardize import best_matches
    rows = spark.sql("SELECT * FROM VALUES ('c', 'abc'), ('c', 'abd') AS t(city, name)")
    seed = spark.sql("SELECT * FROM VALUES ('c', 'ABC'), ('c', 'ABD') AS t(city, official)")
    plan = best_matches(rows, seed, "city", "name", "official")._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert not [line for line in joins if "Broadcast" in line and "_cb" in line], plan
    assert len([line for line in joins if "Merge" in line and "_cb" in line]) >= 2, plan
