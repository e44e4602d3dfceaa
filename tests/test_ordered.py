import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from rentscope.operators import ordered, windows
from rentscope.operators.slots import Slots


SMALL = 100   # rows of a slot here: every scan below is cut


def _skewed(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.4 else (None if rnd.random() < 0.05 else f"g{rnd.randint(0, 20)}")
        x = None if rnd.random() < 0.03 else float(rnd.randint(-20, 500))
        rows.append((i, g, x))
    return spark.createDataFrame(rows, "id int, g string, x double").repartition(7)


def test_running_total_equals_window(spark):
    df = _skewed(spark)
    order = [F.col("x").desc(), F.col("id")]
    a = ordered.running_total(df, "g", "x", ["id"], rows_per_slot=SMALL)
    b = windows.running_total(df, "g", order, "x")
    key = lambda r: r.id
    ra = sorted(a.select("id", "running").collect(), key=key)
    rb = sorted(b.select("id", "running").collect(), key=key)
    assert len(ra) == len(rb) == 3000
    for p, q in zip(ra, rb):
        assert (p.running is None and q.running is None) or abs(p.running - q.running) < 1e-6, (p, q)


def test_ntile_equals_window(spark):
    df = _skewed(spark)
    order = [F.col("x").desc(), F.col("id")]
    for n in (4, 7):
        a = ordered.ntile(df, "g", "x", ["id"], n, out="t", rows_per_slot=SMALL).select("id", "t")
        b = windows.ntile_per_group(df, "g", order, n, out="t").select("id", "t")
        assert sorted(a.collect()) == sorted(b.collect())


def test_pareto_and_dense_equal_window(spark):
    df = _skewed(spark).where(F.col("x") > 0)
    a = ordered.pareto(df, "g", "x", ["id"], rows_per_slot=SMALL)
    b = windows.pareto(df, "g", "x", [F.col("id")])
    cols = ["id", "ranking"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    pa = {r.id: r.cum_pct for r in a.collect()}
    pb = {r.id: r.cum_pct for r in b.collect()}
    assert pa.keys() == pb.keys() and all(abs(pa[k] - pb[k]) < 1e-9 for k in pa)


def test_median_equals_builtin(spark):
    df = _skewed(spark)
    a = {r.g: r.median for r in ordered.median(df, ["g"], "x", rows_per_slot=SMALL).collect()}
    b = {r.g: r.m for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_hot_group_spans_partitions(spark):
    df = _skewed(spark)
    s = ordered.ordered_scan(df, ["g"], "x", ["id"], "x", descending=True, rows_per_slot=SMALL)
    # ranks are a permutation 1..n per group, even for the group split across tasks
    chk = s.groupBy("g").agg(F.count("*").alias("c"), F.min("_rank").alias("lo"), F.max("_rank").alias("hi"),
                             F.countDistinct("_rank").alias("d"))
    for r in chk.collect():
        assert r.lo == 1 and r.hi == r.c == r.d


def test_dense_from_scan_with_ties_across_partitions(spark):
    # many equal values so runs of one value cross partition boundaries
    rows = [(i, "hot" if i % 3 else "cold", float(i // 40)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, g string, x double").repartition(5)
    s = ordered.ordered_scan(df, ["g"], "x", ["id"], "x", descending=True, dense=True, rows_per_slot=SMALL)
    w = df.withColumn("d", F.dense_rank().over(Window.partitionBy("g").orderBy(F.col("x").desc())))
    a = sorted((r.id, r._dense) for r in s.collect())
    b = sorted((r.id, r.d) for r in w.collect())
    assert a == b


def test_affordability_rank_equals_window_form(spark):
    from rentscope.plans import market
    rnd = random.Random(9)
    rows = []
    for i in range(1500):
        city = "big" if rnd.random() < 0.5 else f"c{rnd.randint(0, 4)}"
        nb = f"n{rnd.randint(0, 60)}"
        rows.append((city, nb, float(rnd.choice([10, 20, 30, 40, 55]))))  # many tied medians
    tr = spark.createDataFrame(rows, "city_name string, neighborhood_final string, rent_value double")
    got, whole = (sorted(tuple(r) for r in market.affordability_rank(tr, 3, slot).select(
        "city_name", "neighborhood_final", "median_rent", "rank_cheapest", "rank_priciest").collect()) for slot in (20, None))
    assert got == whole
    m = tr.groupBy("city_name", "neighborhood_final").agg(F.median("rent_value").alias("median_rent"))
    lo = Window.partitionBy("city_name").orderBy(F.col("median_rent").asc(), F.col("neighborhood_final").asc())
    hi = Window.partitionBy("city_name").orderBy(F.col("median_rent").desc(), F.col("neighborhood_final").asc())
    w = (m.withColumn("rank_cheapest", F.row_number().over(lo)).withColumn("rank_priciest", F.row_number().over(hi))
          .where("rank_cheapest <= 3 OR rank_priciest <= 3"))
    want = sorted(tuple(r) for r in w.select("city_name", "neighborhood_final", "median_rent",
                                            "rank_cheapest", "rank_priciest").collect())
    assert got == want


def test_scan_with_more_partitions_than_rows(spark):
    df = spark.createDataFrame([(i, "g" if i < 5 else None, float(i)) for i in range(8)], "id int, g string, x double")
    s = ordered.ordered_scan(df, ["g"], "x", ["id"], "x", rows_per_slot=2)
    got = sorted(((r.g, r.id, r._rank, r._cum, r._n) for r in s.collect()), key=repr)
    want = sorted([("g", i, i + 1, float(sum(range(i + 1))), 5) for i in range(5)] +
                  [(None, i, i - 4, float(sum(range(5, i + 1))), 3) for i in range(5, 8)], key=repr)
    assert got == want


def test_median_by_all_null_group(spark):
    from rentscope.operators.quantiles import median_by
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("z", None), ("z", None)], "g string, x double")
    for slot in (1, None):
        got = {r.g: r.m for r in median_by(df, "g", {"m": F.col("x")}, extra=[F.count(F.lit(1)).alias("n")], rows_per_slot=slot).collect()}
        assert got == {"a": 2.0, "z": None}


def test_values_keep_their_types(spark):
    import datetime as dt
    from decimal import Decimal
    rows = [(1, 9007199254740993, Decimal("90071992547409.93"), dt.datetime(9999, 12, 31)),
            (2, None, Decimal("0.01"), None), (3, 9007199254740995, None, dt.datetime(1, 1, 1))]
    df = spark.createDataFrame(rows, "id int, b bigint, d decimal(38,2), t timestamp_ntz").withColumn("g", F.lit("g"))
    got = {r.id: r for r in ordered.ordered_scan(df, ["g"], "id", [], "d", rows_per_slot=1).collect()}
    assert [got[k].b for k in (1, 2, 3)] == [9007199254740993, None, 9007199254740995]
    assert [got[k]._cum for k in (1, 2, 3)] == [Decimal("90071992547409.93"), Decimal("90071992547409.94"), Decimal("90071992547409.94")]
    assert got[1].t == dt.datetime(9999, 12, 31)
    by_time = {r.id: r._rank for r in ordered.ordered_scan(df, ["g"], "t", [], nulls_last=True, rows_per_slot=1).collect()}
    assert by_time == {3: 1, 1: 2, 2: 3}
    big = {r.id: r._rank for r in ordered.ordered_scan(df, ["g"], "b", [], descending=True, rows_per_slot=1).collect()}
    assert big == {3: 1, 1: 2, 2: 3}


def test_special_values_follow_the_window(spark):
    rows = [(k, "g", v) for k, v in enumerate([0.0, -0.0, float("nan"), float("inf"), float("-inf"), None, 1e-300, 1e300, -5.0, None])]
    df = spark.createDataFrame(rows, "id int, g string, x double")
    for desc in (False, True):
        o = F.col("x").desc() if desc else F.col("x").asc()
        w = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(o, "id")))
        for slot in (1, 3, None):
            s = ordered.ordered_scan(df, ["g"], "x", ["id"], descending=desc, rows_per_slot=slot)
            assert sorted((r.id, r.r) for r in w.collect()) == sorted((r.id, r._rank) for r in s.collect())


def _largest_slot(df, lead, ties, rows_per_slot, **kw):
    slots = Slots.of(df, lead, ties, rows_per_slot=rows_per_slot, **kw)
    sizes = ordered._slotted(df, ["g"], slots).groupBy("_k").count()
    return sizes.agg(F.max("count"), F.count("*")).first()


def test_no_task_scans_a_hot_group(spark):
    """A group with a third of the rows: its largest (group, slot) is a small part of it."""
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("g"),
                                   (F.rand(7) * F.rand(8) * 1000).alias("x"))
    largest, _ = _largest_slot(df, "x", ["id"], 500, descending=True)
    assert largest < 1000
    plan = ordered.ordered_scan(df, ["g"], "x", ["id"], "x", rows_per_slot=500)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_an_outlier_does_not_collapse_the_slots(spark):
    df = spark.range(200_001).select("id", F.when(F.col("id") == 7, 1e15).otherwise(F.col("id").cast("double")).alias("x"),
                                     F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("g"))
    largest, slots = _largest_slot(df, "x", ["id"], 1000)
    assert slots > 200 and largest < 2000


def test_a_hot_value_is_cut_by_its_ties(spark):
    # a third of the rows hold one value, a third none; the first tie-break column is constant
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 3 == 1, F.col("id") / 9.0).alias("x"),
                                    F.lit("k").alias("t"), F.lit("a").alias("g"), (F.col("id") % 11).alias("v"))
    largest, slots = _largest_slot(df, "x", ["t", "id"], 200, descending=False, nulls_last=True)
    assert largest < 450 and slots > 130
    for descending in (False, True):
        o = F.col("x").desc_nulls_last() if descending else F.col("x").asc_nulls_last()
        rows, alike = Window.partitionBy("g").orderBy(o, "t", "id"), Window.partitionBy("g").orderBy(o)
        want = df.select("id", F.row_number().over(rows).alias("a"), F.dense_rank().over(alike).alias("b"),
                         F.sum("v").over(rows.rowsBetween(Window.unboundedPreceding, 0)).alias("c"), (F.rank().over(alike) - 1).alias("d"),
                         F.count("*").over(alike).alias("e"))
        got = ordered.ordered_scan(df, ["g"], "x", ["t", "id"], "v", descending, True, dense=True, ranks=True, rows_per_slot=200) \
            .select("id", "_rank", "_dense", "_cum", "_below", "_upto")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_string_and_time_ties_cut_a_hot_value(spark):
    df = spark.range(6000).select("id", F.lit(1).alias("x"), F.lit("a").alias("g"), F.lpad(F.col("id").cast("string"), 6, "0").alias("name"),
                                  F.timestamp_seconds(F.col("id") * 60).alias("t"))
    for tie in ("name", "t", "id"):
        largest, slots = _largest_slot(df, "x", [tie], 100)
        assert largest < 300 and slots > 40, tie


def test_relative_ranks_equal_window(spark):
    df = _skewed(spark)
    for descending in (False, True):
        o = Window.partitionBy("g").orderBy(F.col("x").desc() if descending else F.col("x").asc())
        want = df.select("id", F.percent_rank().over(o).alias("p"), F.cume_dist().over(o).alias("c"))
        for slot in (SMALL, None):
            got = ordered.relative_ranks(df, "g", "x", "p", "c", descending, ties=["id"], rows_per_slot=slot).select("id", "p", "c")
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    one = spark.createDataFrame([("g", 1.0)], "g string, x double")
    assert tuple(ordered.relative_ranks(one, "g", "x").first())[2:] == (0.0, 1.0)


def test_neighbours_equal_window(spark):
    df = _skewed(spark).withColumn("y", F.col("id") * 2)
    for descending in (False, True):
        o = Window.partitionBy("g").orderBy(F.col("x").desc() if descending else F.col("x").asc(), "id")
        want = df.select("id", F.lag("x").over(o).alias("px"), F.lag("y").over(o).alias("py"), F.lead("x").over(o).alias("nx"))
        for slot in (SMALL, 5, None):
            got = ordered.neighbours(df, "g", "x", ["id"], {"px": "x", "py": "y"}, {"nx": "x"}, descending, rows_per_slot=slot)
            assert sorted(map(str, got.select("id", "px", "py", "nx").collect())) == sorted(map(str, want.collect()))


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id int, g string, x double")
    assert ordered.ordered_scan(df, ["g"], "x", ["id"], "x", dense=True, ranks=True).count() == 0
    assert ordered.neighbours(df, "g", "x", ["id"], {"p": "x"}).count() == 0
    assert ordered.median(df, ["g"], "x").count() == 0


def test_last_edge_equals_bisection(spark):
    import bisect
    from rentscope.operators.slots import _with_last_edge
    inf = float("inf")
    lists = [[-inf, inf], [-inf, 1.0, 2.0, inf], [-inf, *[float(k) for k in range(9)], inf]]
    values = [-inf, -5.0, 0.0, 1.0, 1.5, 2.0, 8.0, 8.5, 1e300, inf]
    df = spark.createDataFrame([(e, v) for e in lists for v in values] + [(None, 3.0), ([-inf, inf], None)], "e array<double>, v double")
    for r in _with_last_edge(df, "e", "v", "at", max(map(len, lists))).collect():
        assert r.at == (0 if r.e is None or r.v is None else bisect.bisect_right(r.e, r.v) - 1), r


def test_tiles_of_scanned_rows_equal_window(spark):
    df = _skewed(spark)
    s = ordered.ordered_scan(df, ["g"], "x", ["id"], "x", descending=True, dense=True, rows_per_slot=SMALL)
    a = ordered.ntile(s, "g", "x", ["id"], 7, out="t", scanned=True).select("id", "t", ordered.DENSE)
    w = Window.partitionBy("g").orderBy(F.col("x").desc())
    b = df.select("id", F.ntile(7).over(w.orderBy(F.col("x").desc(), "id")).alias("t"), F.dense_rank().over(w).cast("bigint").alias(ordered.DENSE))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_hot_values_are_scanned_once(spark):
    """Running sums and tiles of the same order read the table for the rows and for
    the offsets; a row's slot is compiled, not folded in a lambda."""
    from conftest import SF_MID
    from rentscope.plans.catalog_history import quantity_running
    plan = quantity_running(spark, SF_MID)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 2, plan
    assert "lambda" not in plan and "namedlambda" not in plan
