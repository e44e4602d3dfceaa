from pyspark.sql import Window
from pyspark.sql import functions as F

from rentscope.functions.text import capitalize_first, words
from rentscope.operators import aggregates as agg
from rentscope.operators import joins, nested, windows


def test_capitalize_sort(spark):
    df = spark.createDataFrame([("mIRA",), ("otto",), ("BEN",), ("zoe",)], "n string")
    got = [r.c for r in df.select(capitalize_first(F.col("n")).alias("c")).orderBy("c").collect()]
    assert got == ["Ben", "Mira", "Otto", "Zoe"]


def test_word_frequency(spark):
    df = spark.createDataFrame([("tide moon tide",), ("Moon; tide--star",)], "t string")
    got = {r.word: r.n for r in agg.word_frequency(df, words(F.col("t"))).collect()}
    assert got == {"tide": 3, "moon": 2, "star": 1}


def test_even_rows_tripled(spark):
    df = spark.range(4, 12)
    got = [r.x for r in df.where(F.col("id") % 2 == 0).select((F.col("id") * 3).alias("x")).orderBy("x").collect()]
    assert got == [12, 18, 24, 30]


def test_invert_index(spark):
    df = spark.createDataFrame([("k3", 7), ("k1", 9), ("k2", 7), ("k2", 7), (None, 9)], "k string, v int")
    got = {r.v: r["keys"] for r in agg.invert_index(df, "k", "v").collect()}
    assert got == {7: ["k2", "k3"], 9: ["k1"]}


def test_origin_distance_and_buckets(spark):
    df = spark.createDataFrame([(8, 15), (0, 0), (-7, 24)], "x int, y int")
    assert [r.d for r in df.select(F.hypot("x", "y").alias("d")).collect()] == [17.0, 0.0, 25.0]
    t = spark.createDataFrame([(v,) for v in (19, 20, 29, 30)], "t int")
    lab = F.when(F.col("t") < 20, "low").when(F.col("t") >= 30, "high").otherwise("medium")
    assert [r.b for r in t.select(lab.alias("b")).collect()] == ["low", "medium", "medium", "high"]


def test_cond_convert_and_filter_project(spark):
    df = spark.createDataFrame([("p", 60.0), ("q", 122.0), ("r", 212.0)], "k string, v double")
    v = F.col("v")
    got = [r.c for r in df.select(F.when(v > 60, (v - 32) * 5 / 9).otherwise(v).alias("c")).collect()]
    assert got == [60.0, 50.0, 100.0]
    gear = spark.createDataFrame([("lamp", 8, True), ("rope", 3, True), ("axe", 9, False)], "name string, weight int, packed boolean")
    assert [r.name for r in gear.where("weight > 5 and packed").select("name").collect()] == ["lamp"]


def _shelves(spark):
    return spark.createDataFrame(
        [("s1", [("bolt", 40), ("nut", 2)]), ("s2", [("bolt", 1)]), ("s3", [])],
        "shelf string, parts array<struct<item:string, qty:int>>")


def test_nested_record_sum(spark):
    got = {r.shelf: r.total for r in nested.record_sum(_shelves(spark), "parts", "qty").collect()}
    assert got == {"s1": 42, "s2": 1, "s3": 0}
    got = {r.shelf: r.total for r in nested.record_sum(_shelves(spark), "parts", "qty", min_total=1).collect()}
    assert got == {"s1": 42}


def _crates(spark):
    return spark.createDataFrame([
        ("metal", "round", [("bolt", 4), ("ring", 5)]),
        ("metal", "flat", [("plate", 11)]),
        ("metal", "round", [("ring", 2)]),
        ("glass", "flat", [("pane", 3), ("lens", 1)]),
    ], "kind string, form string, parts array<struct<item:string, qty:int>>")


def test_nested_means_and_having(spark):
    got = {r.kind: r.mean_qty for r in nested.category_mean(_crates(spark), "kind", "parts", "item", "qty").collect()}
    assert got == {"metal": 5.5, "glass": 2.0}
    got = {r.kind: r.total for r in
           nested.category_sum_having(_crates(spark), "kind", "parts", "item", "qty", 22).collect()}
    assert got == {"METAL": 22}


def test_two_level_totals(spark):
    out = nested.two_level_totals(_crates(spark), "kind", "form", "parts", "item", "qty", 11)
    assert {r.kind: dict(r.totals) for r in out.collect()} == {"metal": {"round": 11, "flat": 11}}


def test_map_of_lists_totals(spark):
    df = spark.createDataFrame([
        ("n", {"wood": [("oak", 3), ("ash", 4)], "wax": [("bee", 9)]}),
        ("n", {"wood": [("elm", 10)]}),
        ("m", {"wax": [("soy", 2)], "oil": []})],
        "site string, stock map<string, array<struct<item:string, qty:int>>>")
    got = {r.site: dict(r.totals) for r in nested.map_totals(df, "site", "stock", "item", "qty").collect()}
    assert got == {"n": {"wood": 17, "wax": 9}, "m": {"wax": 2}}


def test_published_orders_of_rows(spark):
    """Queries whose source ends in ORDER BY return their rows in that order."""
    from conftest import SF_SMALL

    from rentscope.plans import catalog
    q = catalog.queries()
    keys = {"above_group_avg": lambda r: -r.revenue, "groups_above_mean_total": lambda r: -r.total,
            "monthly_avg": lambda r: (r.mth, r.user_id), "group_range": lambda r: -r.difference,
            "loss_by_group": lambda r: -r.drug_count}
    for name, key in keys.items():
        rows = q[name](spark, SF_SMALL).collect()
        assert rows and [key(r) for r in rows] == sorted(key(r) for r in rows), name


def test_exact_rounding(spark):
    from decimal import Decimal

    from rentscope.functions.numeric import avg_rounded, round_ratio
    r = spark.sql("SELECT 9007199254740993L AS n, 1L AS d, -5L AS m, 2L AS two, 0L AS z").select(
        round_ratio(F.col("n"), F.col("d"), 0).alias("a"), round_ratio(F.col("m"), F.col("two"), 0).alias("b"),
        round_ratio(F.col("m"), F.col("z"), 0).alias("c"), round_ratio(F.col("d"), F.lit(3), 4).alias("e")).first()
    assert (r.a, r.b, r.c, r.e) == (9007199254740993, -3, None, Decimal("0.3333"))
    big = spark.range(3).select((F.col("id") + F.lit(1.2e15)).alias("x"))
    assert big.agg(avg_rounded(F.col("x"), 4).alias("m")).first().m == 1200000000000001.0
    half = spark.createDataFrame([(0.00004,), (0.00006,)], "x double")
    assert half.agg(avg_rounded(F.col("x"), 4).alias("m")).first().m == 0.0001


def test_window_invariants(spark):
    import random
    rnd = random.Random(3)
    rows = [(i, f"g{rnd.randint(0, 3)}", float(rnd.randint(1, 50))) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g string, x double")
    r = windows.running_total(df, "g", [F.col("x").desc(), F.col("id")], "x").toPandas()
    tot = df.groupBy("g").agg(F.sum("x").alias("t")).toPandas().set_index("g")["t"]
    last = r.groupby("g")["running"].max()  # positive values: the last running value is the largest
    assert (last.sort_index() == tot.sort_index()).all()
    p = windows.pareto(df, "g", "x", [F.col("id")]).toPandas()
    assert (p["cum_pct"] <= 80).all()
    # share of group sums to 100 per group
    s = windows.share_of_group(df, "g", "x").groupBy("g").agg(F.sum("pct").alias("s")).collect()
    assert all(abs(x.s - 100.0) < 1e-6 for x in s)
    # global dense top-k == window formulation
    a = windows.global_dense_top(df, "x", 5).select("id", "dense_rank")
    w = df.withColumn("dense_rank", F.dense_rank().over(Window.orderBy(F.col("x").desc()))) \
          .where("dense_rank <= 5").select("id", "dense_rank")
    assert sorted(a.collect()) == sorted(w.collect())
    # latest per key == row_number formulation
    lt = windows.latest_per_key(df, "g", ["x", "id"]).select("g", "id")
    rn = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.col("x").desc(), F.col("id").desc())))
    assert sorted(lt.collect()) == sorted(rn.where("r = 1").select("g", "id").collect())


def test_joins(spark):
    pages = spark.createDataFrame([(1,), (2,), (3,)], "page_id int")
    likes = spark.createDataFrame([(1,), (1,), (3,)], "page_id int")
    assert [r.page_id for r in joins.anti_join(pages, likes, "page_id").collect()] == [2]
    sal = spark.createDataFrame([(100,), (200,), (300,), (300,)], "s int")
    assert joins.max_below_max(sal, "s", "second").first().second == 200
    one = spark.createDataFrame([(5,)], "s int")
    assert joins.max_below_max(one, "s", "second").first().second is None
    assert [r.s for r in windows.global_dense_top(sal, "s", 2, only=2).collect()] == [200]
    g = spark.createDataFrame([("a", 10.0), ("a", 10.0), ("b", 1.0), ("c", 30.0)], "k string, v double")
    got = {r.k for r in joins.groups_above_mean_total(g, "k", "v").collect()}
    assert got == {"a", "c"}  # totals 20, 1, 30; mean 17


def test_aggregates(spark):
    tw = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,)], "u int")
    assert sorted(tuple(r) for r in agg.count_histogram(tw, "u").collect()) == [(1, 1), (2, 2)]
    sk = spark.createDataFrame([(1, "weld"), (1, "rivet"), (1, "solder"), (2, "weld"), (2, "weld"), (2, "rivet")],
                               "c int, s string")
    req = ["weld", "rivet", "solder"]
    assert [r.c for r in agg.has_all(sk, "c", "s", req).collect()] == [1]
    assert sorted(r.c for r in agg.has_all(sk, "c", "s", req, distinct=False).collect()) == [1, 2]
    tx = spark.createDataFrame([(1, "in", 3.0), (1, "out", 5.5), (2, "out", 1.0)], "a int, t string, x double")
    assert {r.a: r.b for r in agg.signed_sum(tx, "a", "x", F.col("t") == "out", "b").collect()} == {1: -2.5, 2: -1.0}
    sizes = spark.createDataFrame([(2, 30), (5, 10)], "size int, times int")
    assert agg.weighted_mean(sizes, "size", "times").first().weighted_mean == 2.8


def test_share_of_group_null_key_is_a_group(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 3.0), (3, "a", 2.0)], "id int, g string, x double")
    got = {r.id: r.pct for r in windows.share_of_group(df, "g", "x").collect()}
    assert got == {1: 25.0, 2: 75.0, 3: 100.0}


def test_global_dense_top_ranks_null_like_the_window(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 5.0), (4, 1.0)], "id int, x double")
    a = sorted((r.id, r.dense_rank) for r in windows.global_dense_top(df, "x", 3).collect())
    w = df.withColumn("dense_rank", F.dense_rank().over(Window.orderBy(F.col("x").desc()))).where("dense_rank <= 3")
    assert a == sorted((r.id, r.dense_rank) for r in w.collect()) == [(1, 1), (2, 3), (3, 1), (4, 2)]
