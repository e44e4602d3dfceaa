import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rentscope.plans.landing_pages import pages_from_tables, write_landing
from rentscope.plans.listings import BRONZE_COLUMNS, silver, staging
from rentscope.sources import bronze as bronze_src
from rentscope.sources import landing
from rentscope.streaming.ingest import incremental_ingest
from rentscope.streaming.refresh import read_silver, refresh_from_stream


def _scratch():
    return tempfile.mkdtemp(prefix="rentscope-test-")


def _page(results, total=None):
    d = {"results": results}
    if total is not None:
        d["totalEntries"] = total
    return d


def _listing(i, city="bogota", **kw):
    d = {"midinmueble": str(i), "midempresa": "7", "title": "t", "link": f"/l/{i}", "mbarrio": "chico",
         "mnombrecomunbarrio": "chico", "mciudad": {"nombre": city}, "mzona": {"nombre": "norte"},
         "marea": 50.0, "areaprivada": 45.0, "mnrocuartos": "3", "mnrobanos": "2", "mnrogarajes": "1",
         "estrato": "4", "mvalorarriendo": 1000.0, "data": {"mvaloradministracion": 100.0},
         "localizacion": {"lon": -74.0, "lat": 4.6}, "mtipoinmueble": {"nombre": "Apartamento"}}
    d.update(kw)
    return d


def _write_pages(root, city, pages):
    os.makedirs(os.path.join(root, f"city={city}"), exist_ok=True)
    for k, p in enumerate(pages):
        with open(os.path.join(root, f"city={city}", f"page_{k}.json"), "w") as f:
            json.dump(p, f, indent=2)  # multi-line objects, one per file


def test_full_load_multiline(spark):
    root, out = _scratch(), os.path.join(_scratch(), "bronze")
    _write_pages(root, "bogota", [_page([_listing(1), _listing(2, extra_field="x")], total=2),
                                  _page([]), {"totalEntries": 5}])
    _write_pages(root, "cali", [_page([_listing(3, city="cali", mciudad=None)])])
    pages = landing.read_pages(spark, root, multi_line=True)
    summ = {r.city: (r.total_entries, r.listings_seen, r.pages) for r in landing.catalog_summary(pages).collect()}
    assert summ == {"bogota": (5, 2, 3), "cali": (0, 1, 1)}
    b = landing.full_load(spark, root, out, loaded_at=dt.datetime(2026, 1, 5, 10), multi_line=True)
    assert b.count() == 3
    assert [c for c in b.columns if c not in ("LOAD_TYPE", "LOAD_ID", "LOAD_DATE")] == BRONZE_COLUMNS + ["UPLOADED_DATE"]
    stg = staging(bronze_src.as_text(b))
    r = {x.property_id: x for x in stg.collect()}
    assert r["1"].rooms_count == 3 and r["3"].city_name is None and r["1"].total_area == 50.0


def test_empty_and_missing_columns_raise(spark):
    root = _scratch()
    _write_pages(root, "bogota", [_page([])])
    with pytest.raises(ValueError):
        landing.full_load(spark, root, os.path.join(_scratch(), "b"), multi_line=True)
    df = spark.createDataFrame([("1",)], "MIDINMUEBLE string")
    with pytest.raises(ValueError):
        landing.enforce_columns(df)


def test_flatten_and_duplicate_names(spark):
    df = spark.createDataFrame([(1, (2, (3,)))], "a int, b struct<c:int, d:struct<e:int>>")
    assert landing.flatten(df).columns == ["a", "b.c", "b.d.e"]
    dup = spark.createDataFrame([(1, 2)], "x int, X int")
    out = landing.first_of_duplicates(landing.normalize_names(dup))
    assert out.columns == ["X"] and out.first()[0] == 1


def test_union_by_name_with_type_drift(spark):
    a = spark.createDataFrame([(1, "3")], "MAREA bigint, MNROCUARTOS string")
    b = spark.createDataFrame([(2.5, 4)], "MAREA double, MNROCUARTOS bigint")
    c = spark.createDataFrame([("7",)], "MAREA string")
    u = bronze_src.union_by_name([a, b, c])
    assert sorted((r.MAREA, r.MNROCUARTOS) for r in u.collect()) == [("1", "3"), ("2.5", "4"), ("7", None)]


def test_stream_ingest_and_refresh_equal_batch(spark):
    root = _scratch()
    landing_dir, bronze_dir = os.path.join(root, "landing"), os.path.join(root, "bronze")
    silver_dir = os.path.join(root, "silver")
    pages = pages_from_tables(spark, SF_SMALL).cache()
    as_of = dt.date(2030, 1, 1)
    write_landing(pages.where(F.col("page") % 2 == 0), landing_dir, mode="append")
    incremental_ingest(spark, landing_dir, bronze_dir, os.path.join(root, "ck_ingest")).awaitTermination()
    refresh_from_stream(spark, bronze_dir, silver_dir, os.path.join(root, "ck_refresh")).awaitTermination()
    n1 = spark.read.parquet(bronze_dir).count()
    write_landing(pages.where(F.col("page") % 2 == 1), landing_dir, mode="append")
    incremental_ingest(spark, landing_dir, bronze_dir, os.path.join(root, "ck_ingest")).awaitTermination()
    refresh_from_stream(spark, bronze_dir, silver_dir, os.path.join(root, "ck_refresh")).awaitTermination()
    bronze_all = spark.read.parquet(bronze_dir)
    total = pages.select(F.sum(F.size("results"))).first()[0]
    assert bronze_all.count() == total and 0 < n1 < total  # each landing file ingested once
    batch = silver(staging(bronze_src.as_text(bronze_all.drop("LOAD_DATE"))), as_of=as_of)
    stream = read_silver(spark, silver_dir, as_of=as_of)
    cols = batch.columns
    assert sorted(map(tuple, batch.select(cols).collect()), key=repr) == \
        sorted(map(tuple, stream.select(cols).collect()), key=repr)


def test_nested_field_fallback(spark):
    df = spark.createDataFrame([("bogota", None), (None, "cali"), (None, None)],
                               "`MCIUDAD.NOMBRE` string, `mciudad.nombre` string")
    out = landing.coalesce_fields(df, "MCIUDAD.NOMBRE", "mciudad.nombre")
    assert out.columns == ["MCIUDAD.NOMBRE"]
    assert [r[0] for r in out.collect()] == ["bogota", "cali", None]


def test_scale_conf():
    from rentscope.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, executor_cores=4, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409601  # 100 TB / 256 MB + 1
    c = scale_conf(1024 ** 3, executor_cores=4, executors=10)
    assert int(c["spark.sql.shuffle.partitions"]) == 80  # at least 2 tasks per core


def test_stream_multiline_pages_once_each(spark):
    root = _scratch()
    land, out = os.path.join(root, "landing"), os.path.join(root, "bronze")
    _write_pages(land, "bogota", [_page([_listing(1), _listing(2)], total=2)])
    from rentscope.streaming.ingest import incremental_ingest as ingest
    ingest(spark, land, out, os.path.join(root, "ck"), multi_line=True, max_files_per_trigger=1).awaitTermination()
    _write_pages(land, "cali", [_page([_listing(3, city="cali")]), _page([_listing(4, city="cali")])])
    ingest(spark, land, out, os.path.join(root, "ck"), multi_line=True, max_files_per_trigger=1).awaitTermination()
    b = spark.read.parquet(out)
    assert sorted(r.MIDINMUEBLE for r in b.collect()) == ["1", "2", "3", "4"]
    assert b.select("UPLOADED_DATE").distinct().count() >= 2  # one load instant per micro-batch


def test_bronze_partition_pruning(spark):
    root = _scratch()
    land, out = os.path.join(root, "landing"), os.path.join(root, "bronze")
    _write_pages(land, "bogota", [_page([_listing(1), _listing(2)], total=2)])
    pages = landing.read_pages(spark, land, multi_line=True)
    for day in (1, 2, 3):
        landing.load(spark, pages, out, f"day{day}", "FULL", dt.datetime(2026, 1, day, 8))
    df = bronze_src.read_loads(spark, out, load_types=["FULL"], since=dt.date(2026, 1, 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "LOAD_DATE" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert df.count() == 4 and {r.LOAD_DATE.day for r in df.select("LOAD_DATE").distinct().collect()} == {2, 3}


def _ids(spark, path):
    return sorted(r.MIDINMUEBLE for r in bronze_src.read_loads(spark, path).collect())


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_full_and_incremental_loads_live_together(spark, scheme):
    root = _scratch()
    lands = {k: os.path.join(root, k) for k in ("a", "b", "c")}
    _write_pages(lands["a"], "bogota", [_page([_listing(1), _listing(2)], total=2)])
    _write_pages(lands["b"], "cali", [_page([_listing(3, city="cali")])])
    _write_pages(lands["c"], "cali", [_page([_listing(7, city="cali")])])
    out, state = f"{scheme}{root}/bronze", f"{scheme}{root}/state"
    landing.full_load(spark, lands["a"], out, dt.datetime(2026, 1, 1), multi_line=True)
    incremental_ingest(spark, lands["b"], out, f"{root}/ck", multi_line=True).awaitTermination()
    refresh_from_stream(spark, out, state, f"{root}/ck2").awaitTermination()
    landing.full_load(spark, lands["c"], out, dt.datetime(2026, 1, 2), multi_line=True)
    refresh_from_stream(spark, out, state, f"{root}/ck2").awaitTermination()
    assert _ids(spark, out) == ["1", "2", "3", "7"]
    assert sorted(r.property_id for r in read_silver(spark, state).collect()) == ["1", "2", "3", "7"]


def test_load_replaces_itself_on_replay(spark):
    root = _scratch()
    _write_pages(f"{root}/l", "bogota", [_page([_listing(1), _listing(2)])])
    pages = landing.read_pages(spark, f"{root}/l", multi_line=True)
    for _ in range(2):
        assert landing.load(spark, pages, f"{root}/b", "batch-7", "INCREMENTAL", dt.datetime(2026, 1, 1)) == 2
    assert _ids(spark, f"{root}/b") == ["1", "2"]


def test_bad_cells_are_kept_as_text_and_fail_staging(spark):
    root = _scratch()
    _write_pages(f"{root}/l", "bogota", [_page([_listing(1, marea="45 m2", mvalorarriendo="1500000", mciudad="Bogota"), _listing(2)])])
    rows = landing.full_load(spark, f"{root}/l", f"{root}/b", multi_line=True)
    r = {x.MIDINMUEBLE: x for x in rows.collect()}["1"]
    assert (r.MAREA, r.MVALORARRIENDO, r["MCIUDAD.NOMBRE"]) == ("45 m2", "1500000", "Bogota")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging(rows).collect()


def test_absent_required_field_raises_and_leaves_no_load(spark):
    root = _scratch()
    bad = [_listing(k) for k in (1, 2)]
    for x in bad:
        del x["mvalorarriendo"]
    _write_pages(f"{root}/l", "bogota", [_page(bad)])
    with pytest.raises(ValueError, match="MVALORARRIENDO"):
        landing.full_load(spark, f"{root}/l", f"{root}/b", multi_line=True)
    assert bronze_src.load_folders(spark, f"{root}/b") == []
    with pytest.raises(Exception, match="MVALORARRIENDO"):
        incremental_ingest(spark, f"{root}/l", f"{root}/b", f"{root}/ck", multi_line=True).awaitTermination()


def test_drifted_loads_read_as_one(spark):
    root = _scratch()
    for k, kind in enumerate(("string", "double", "bigint")):
        spark.createDataFrame([(str(k), k + 1)], "MIDINMUEBLE string, MAREA int") \
            .select("MIDINMUEBLE", F.col("MAREA").cast(kind), F.lit(dt.date(2026, 1, 1)).alias("LOAD_DATE")) \
            .write.partitionBy("LOAD_DATE").parquet(f"{root}/b/LOAD_TYPE=FULL/LOAD_ID=l{k}")
    assert sorted((r.MIDINMUEBLE, r.MAREA) for r in bronze_src.read_loads(spark, f"{root}/b").collect()) == [
        ("0", "1"), ("1", "2.0"), ("2", "3")]


def test_broken_and_repeated_merges_give_the_same_state(spark, monkeypatch):
    from rentscope.streaming import refresh
    root = _scratch()
    _write_pages(f"{root}/l", "bogota", [_page([_listing(k) for k in range(1, 41)])])
    rows = landing.full_load(spark, f"{root}/l", f"{root}/b", dt.datetime(2026, 1, 1), multi_line=True)
    newer = rows.where("MIDINMUEBLE in ('3', '4')").withColumn("UPLOADED_DATE", F.lit(dt.datetime(2026, 1, 9)).cast("timestamp_ntz"))
    state = f"{root}/state"
    refresh.merge_batch(spark, rows, state, "one", rows_per_bucket=10)
    assert refresh.manifest(spark, state)["n_buckets"] == 4
    with monkeypatch.context() as m:  # breaks after the data, before the manifest
        m.setattr(refresh, "publish_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            refresh.merge_batch(spark, newer, state, "two", rows_per_bucket=10)
    before = refresh.manifest(spark, state)
    assert before["batches"] == ["one"] and before["rows"] == 40
    for _ in range(2):
        refresh.merge_batch(spark, newer, state, "two", rows_per_bucket=10)
    after = refresh.manifest(spark, state)
    assert after["batches"] == ["one", "two"] and after["rows"] == 40
    got = {r.property_id: r.extracted_at.day for r in read_silver(spark, state).collect()}
    assert len(got) == 40 and got["3"] == got["4"] == 9 and got["5"] == 1
    # four times outgrown: more buckets, all rows kept
    refresh.merge_batch(spark, newer, state, "three", rows_per_bucket=2)
    refresh.merge_batch(spark, newer, state, "four", rows_per_bucket=2)
    assert refresh.manifest(spark, state)["n_buckets"] == 20
    assert read_silver(spark, state).count() == 40


def test_scratch_folder_must_be_named_off_local_masters(spark, monkeypatch):
    from rentscope import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        applicationId = "x"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())



def _bronze_row(spark, path):
    return {r.MIDINMUEBLE: r for r in bronze_src.read_loads(spark, path).collect()}


def test_text_that_looks_like_an_object_is_kept(spark):
    root = _scratch()
    _write_pages(f"{root}/l", "x", [_page([_listing(1, title="{Oferta} Apto", mciudad={"nombre": "{Y}"}), _listing(2, mciudad="{Z}")])])
    rows = landing.full_load(spark, f"{root}/l", f"{root}/b", multi_line=True)
    r = {x.MIDINMUEBLE: x for x in rows.collect()}
    assert (r["1"].TITLE, r["1"]["MCIUDAD.NOMBRE"], r["2"]["MCIUDAD.NOMBRE"]) == ("{Oferta} Apto", "{Y}", "{Z}")


def test_names_reach_to_any_depth(spark):
    root = _scratch()
    deep = {"a": {"b": {"c": {"d": {"e": "five", "f": None}}, "c_d": {"g": 1.50}}}, "A.B.X": "flat", "list": [{"k": 1}], "empty": {}}
    _write_pages(f"{root}/l", "x", [_page([deep, {"a": "text", "a_b_x": 2}])])
    listed = landing.listings(landing.read_pages(spark, f"{root}/l", multi_line=True))
    names = ["A.B.C.D.E", "A.B.C.D.G", "A.B.X", "A", "A.B"]
    got = landing.columns_of(listed, names, underscore_to_dot=True).orderBy("A").collect()
    assert [tuple(r)[:5] for r in got] == [("five", "1.5", "flat", None, None), (None, None, "2", "text", None)]
    assert [list(r._occurs) for r in got] == [[True, True, True, True, True], [False, False, True, True, False]]
    flat = sorted((r.name, r.value) for r in landing.leaves(listed, ["city"], underscore_to_dot=True).collect())
    assert flat == [("A", "text"), ("A.B.C.D.E", "five"), ("A.B.C.D.F", None), ("A.B.C.D.G", "1.5"), ("A.B.X", "2"), ("A.B.X", "flat"),
                    ("LIST", '[{"k":1}]')]


def test_first_spelling_in_page_order_wins(spark):
    root = _scratch()
    _write_pages(f"{root}/l", "x", [_page([{"link": "first", "LINK": "second"}, {"LINK": "upper", "link": "lower"}])])
    listed = landing.listings(landing.read_pages(spark, f"{root}/l", multi_line=True))
    assert sorted(r.LINK for r in landing.columns_of(listed, ["LINK"]).collect()) == ["first", "upper"]


def test_a_failed_reload_leaves_the_load_and_streams_see_no_unchecked_one(spark, monkeypatch):
    root = _scratch()
    good, bad = [_listing(1), _listing(2)], [_listing(3)]
    del bad[0]["mvalorarriendo"]
    _write_pages(f"{root}/good", "x", [_page(good)])
    _write_pages(f"{root}/bad", "x", [_page(bad)])
    out, state, ck = f"{root}/b", f"{root}/state", f"{root}/ck"
    landing.full_load(spark, f"{root}/good", out, dt.datetime(2026, 1, 1), multi_line=True, load_id="x")
    with pytest.raises(ValueError, match="MVALORARRIENDO"):
        landing.full_load(spark, f"{root}/bad", out, dt.datetime(2026, 1, 2), multi_line=True, load_id="x")
    assert _ids(spark, out) == ["1", "2"] and spark.read.parquet(out).count() == 2
    # a load that stops between the move and the log entry is not there for readers
    with monkeypatch.context() as m:
        m.setattr(bronze_src, "publish_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            landing.full_load(spark, f"{root}/good", out, dt.datetime(2026, 1, 3), multi_line=True, load_id="y")
    assert _ids(spark, out) == ["1", "2"]
    refresh_from_stream(spark, out, state, ck).awaitTermination()
    assert sorted(r.property_id for r in read_silver(spark, state).collect()) == ["1", "2"]
    # a good reload replaces the load under its id
    landing.full_load(spark, f"{root}/good", out, dt.datetime(2026, 1, 4), multi_line=True, load_id="x")
    rows = bronze_src.read_loads(spark, out)
    assert rows.count() == 2 and {r.LOAD_ID for r in rows.collect()} == {"x"}
    assert {r.UPLOADED_DATE.day for r in rows.collect()} == {4}
    refresh_from_stream(spark, out, state, ck).awaitTermination()
    assert {r.extracted_at.day for r in read_silver(spark, state).collect()} == {4}


def test_drifted_loads_pass_through_the_stream(spark):
    root = _scratch()
    _write_pages(f"{root}/l", "x", [_page([_listing(k) for k in (1, 2)])])
    out = f"{root}/b"
    rows = landing.full_load(spark, f"{root}/l", out, dt.datetime(2026, 1, 1), multi_line=True)
    later = rows.withColumn("UPLOADED_DATE", F.lit(dt.datetime(2026, 1, 5)).cast("timestamp_ntz")).drop("LOAD_TYPE", "LOAD_ID")
    later = later.withColumn("LOAD_DATE", F.to_date("UPLOADED_DATE"))
    typed = later.withColumn("MAREA", F.col("MAREA").cast("double") + 1).withColumn("EXTRA", F.lit(1))
    bronze_src.write_load(typed, out, "INCREMENTAL", "typed")
    short = later.where("MIDINMUEBLE = '2'").withColumn("UPLOADED_DATE", F.lit(dt.datetime(2026, 1, 9)).cast("timestamp_ntz")).drop("ESTRATO")
    bronze_src.write_load(short, out, "INCREMENTAL", "short")
    refresh_from_stream(spark, out, f"{root}/s", f"{root}/ck", loads_per_trigger=1).awaitTermination()
    got = {r.property_id: (r.total_area, r.extracted_at.day, r.socioeconomic_stratum) for r in read_silver(spark, f"{root}/s").collect()}
    assert got == {"1": (51.0, 5, 4), "2": (50.0, 9, None)}


def test_a_thousand_loads_are_read_without_a_job_per_folder(spark):
    root = _scratch()
    row = spark.createDataFrame([("1", dt.date(2026, 1, 1))], "MIDINMUEBLE string, LOAD_DATE date").coalesce(1)
    bronze_src.write_load(row, f"{root}/b", "FULL", "l0")
    entry = bronze_src.log_entries(spark, f"{root}/b")[0]
    for k in range(1, 1000):   # the other folders are links to the first one
        os.symlink(f"{root}/b/{entry['folder']}", f"{root}/b/LOAD_TYPE=FULL/LOAD_ID=l{k}")
        with open(f"{root}/b/_log/{k + 1:012d}.json", "w") as f:
            json.dump(entry | {"number": k + 1, "load_id": f"l{k}", "folder": f"LOAD_TYPE=FULL/LOAD_ID=l{k}"}, f)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("read-thousand", "")
    rows = bronze_src.read_loads(spark, f"{root}/b")
    jobs = len(tracker.getJobIdsForGroup("read-thousand"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3 and rows.count() == 1000 and rows.select("LOAD_ID").distinct().count() == 1000


def test_a_reported_total_of_zero_raises(spark):
    root = _scratch()
    _write_pages(f"{root}/l", "x", [_page([_listing(1)], total=0)])
    pages = landing.read_pages(spark, f"{root}/l", multi_line=True)
    with pytest.raises(ValueError, match="report no listings"):
        landing.require_catalog(landing.catalog_summary(pages))
    with pytest.raises(ValueError, match="report no listings"):
        landing.full_load(spark, f"{root}/l", f"{root}/b", multi_line=True)
    with pytest.raises(ValueError, match="no loads"):
        bronze_src.read_loads(spark, f"{root}/b")


def test_landing_broadcasts_no_table_that_grows(spark):
    """Part and customer are merged however small their files look; only nations
    and the totals of a city are small whatever the input."""
    plan = pages_from_tables(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert any("user_id" in line for line in joins)
    assert not [line for line in joins if "Broadcast" in line and "user_id" in line], plan
