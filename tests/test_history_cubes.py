import datetime as dt
import random
import statistics
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from rentscope.operators import cubes, folds, temporal

T0 = dt.datetime(2026, 1, 1)


def _at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


@pytest.mark.parametrize("slot", [4, None])
def test_as_of_join_equals_brute_force(spark, slot):
    rng = random.Random(1)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None])
    left = [(k, key(), rng.choice([None, *range(60)])) for k in range(120)]
    right = [(key(), rng.choice([None, *range(60)]), rng.choice([None, k])) for k in range(70)]
    ldf = spark.createDataFrame([(k, g, _at(t)) for k, g, t in left], "id int, g string, ts timestamp_ntz").repartition(3)
    rdf = spark.createDataFrame([(g, _at(t), v) for g, t, v in right], "g string, ts timestamp_ntz, v int").repartition(3)
    for age in (None, 5 * 60):
        got = {r.id: (r.ts_as_of, r.v) for r in temporal.as_of_join(ldf, rdf, ["g"], "ts", ["v"], max_age_seconds=age, ties=["v"], rows_per_slot=slot).collect()}
        assert len(got) == len(left)
        for k, g, t in left:
            seen = [(s, -1 if v is None else v) for h, s, v in right if h == g and g is not None and None not in (s, t) and s <= t]
            want = max(seen, default=None)
            if want is None or (age and (t - want[0]) * 60 > age):
                assert got[k] == (None, None)
            else:
                assert got[k] == (_at(want[0]), None if want[1] == -1 else want[1])


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(2)
    points = [(k, rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(-50, 500)])) for k in range(150)]
    spans = [(k, rng.choice(["hot", "hot", "a", None]), s, rng.choice([None, s + rng.choice([-3, 0, 1, 2, 7, 64, 400])]))
             for k in range(80) for s in [rng.randint(-100, 480)]]
    pdf = spark.createDataFrame([(k, g, _at(t)) for k, g, t in points], "id int, g string, ts timestamp_ntz")
    sdf = spark.createDataFrame([(k, g, _at(a), _at(b)) for k, g, a, b in spans], "span int, g string, start timestamp_ntz, stop timestamp_ntz")
    want = sorted((k, s) for k, g, t in points for s, h, a, b in spans
                  if g is not None and g == h and None not in (t, b) and a <= t < b)
    got = temporal.interval_join(pdf, sdf, ["g"], "ts", "start", "stop", ["span"])
    assert sorted((r.id, r.span) for r in got.collect()) == want and want
    left = temporal.interval_join(pdf, sdf, ["g"], "ts", "start", "stop", ["span"], how="left")
    hit = {k for k, _ in want}
    assert sorted((r.id, -1 if r.span is None else r.span) for r in left.collect()) == sorted(want + [(k, -1) for k, *_ in points if k not in hit])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert temporal.interval_join(pdf, sdf.limit(0), ["g"], "ts", "start", "stop", ["span"], how="left").count() == len(points)


@pytest.mark.parametrize("slot", [5, None])
def test_changes_equal_brute_force(spark, slot):
    rng = random.Random(3)
    rows = sorted({(rng.choice(["hot", "hot", "x"]), t): rng.choice([1, 1, 2, None]) for t in range(150)}.items())
    df = spark.createDataFrame([(g, _at(t), v) for (g, t), v in rows], "g string, ts timestamp_ntz, v int").repartition(4)
    want = []
    for g, part in groupby(rows, key=lambda r: r[0][0]):
        opened = []
        for (_, t), v in part:
            if not opened or opened[-1][1] != v:
                opened.append((t, v))
        for k, (t, v) in enumerate(opened):
            want.append((g, v, _at(t), _at(opened[k + 1][0]) if k + 1 < len(opened) else None, opened[k - 1][1] if k else None))
    got = [tuple(r) for r in temporal.changes(df, "g", "ts", "v", rows_per_slot=slot).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_grouping_sets_equal_direct_aggregates(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice([None, *range(40)]), rng.randint(0, 9)) for _ in range(400)]
    df = spark.createDataFrame(rows, "c string, d string, v int, m int").repartition(5)
    fine = cubes.states(df, ["c", "d"], F.col("v"), F.col("m"))
    got = {(r.level, r.c, r.d): r for r in cubes.measures(cubes.cube(fine, ["c", "d"])).collect()}
    for level, keys in (("c,d", (0, 1)), ("c", (0,)), ("d", (1,)), ("", ())):
        for key in {tuple(r[i] if i in keys else None for i in (0, 1)) for r in rows}:
            part = [r for r in rows if all(r[i] == key[i] for i in keys)]
            v = sorted(r[2] for r in part if r[2] is not None)
            r = got.pop((level, *key))
            assert (r.n, r.lowest, r.highest, r.median, r.n_members) == (len(v), v[0], v[-1], statistics.median_low(v), len({r[3] for r in part}))
            assert abs(r["mean"] - sum(v) / len(v)) < 1e-9
    assert not got
    assert {r.level for r in cubes.rollup(fine, ["c", "d"]).collect()} == {"c,d", "c", ""}


def test_sketched_medians_of_many_rows_are_close(spark):
    df = spark.range(300_000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    fine = cubes.states(df, ["g"], F.col("v"), F.col("v").cast("bigint"))
    r = cubes.measures(cubes.grouping_sets(fine, ["g"], [[]])).first()
    assert r.n == 300_000 and abs(r.median - 150_000) < 1500 and abs(r.n_members - 300_000) < 15_000


def test_folds_are_bounded_and_whole(spark):
    long = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
                                    F.col("id").alias("item"), (F.col("id") * 2).alias("total"))
    m = folds.maps(long, ["k"], "item", "total", entries=100).withColumn("order", F.map_keys("totals")).collect()
    assert max(len(r.totals) for r in m) < 160 and sum(len(r.totals) for r in m) == 5000
    assert all(v == 2 * i for r in m for i, v in r.totals.items())
    assert {r.part for r in m if r.k == "hot"} == set(range(40)) and all(list(r.order) == sorted(r.order) for r in m)
    with pytest.raises(Exception, match="more entries"):
        folds.whole(folds.lists(long, ["k"], "item", entries=100)).collect()
    one = folds.whole(folds.lists(long.union(spark.createDataFrame([(None, 1, 1), ("z", None, 1)], "k string, item bigint, total bigint")), ["k"], "item")).collect()
    assert sorted((str(r.k), len(r["items"])) for r in one)[0] == ("None", 1) and len(one) == 9


def test_stored_sketches_follow_the_batches(spark):
    import tempfile

    from rentscope.streaming import refresh
    from test_sources_streaming import _listing, _page, _write_pages
    from rentscope.sources import landing
    root = tempfile.mkdtemp(prefix="rentscope-test-")
    for k, day in ((0, dt.datetime(2026, 1, 9)), (1, dt.datetime(2026, 1, 20)), (2, dt.datetime(2026, 2, 1))):
        _write_pages(f"{root}/l{k}", "x", [_page([_listing(i, mvalorarriendo=100 * i + k) for i in range(k, k + 4)])])
        landing.full_load(spark, f"{root}/l{k}", f"{root}/b", day, multi_line=True, load_id=f"l{k}")
        refresh.refresh_from_stream(spark, f"{root}/b", f"{root}/s", f"{root}/ck").awaitTermination()
    got = {r.month: (r.n, r.lowest, r.highest, r.median, r.n_members) for r in refresh.read_sketches(spark, f"{root}/s").collect()}
    assert got == {"2026-01": (8, 0.0, 401.0, 200.0, 5), "2026-02": (4, 202.0, 502.0, 302.0, 4)}
    whole = refresh.read_sketches(spark, f"{root}/s", by=["city_name"]).first()
    assert (whole.n, whole.n_members) == (12, 6)
    assert [r.month for r in refresh.read_sketches(spark, f"{root}/s", months=["2026-02"]).collect()] == ["2026-02"]
