import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentscope.functions.fuzzy import lcs_bitparallel, ratio, ratio_py
from rentscope.operators.standardize import standardize


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ABCNIQUÍA ", max_size=14), st.text(alphabet="ABCNIQUÍA ", max_size=14))
def test_bitparallel_equals_dp(a, b):
    assert lcs_bitparallel(a, b) == lcs_dp(a, b)


def test_native_equals_bitparallel(spark):
    rnd = random.Random(7)
    pairs = []
    for _ in range(300):
        a = "".join(rnd.choice("ABCDÉ ") for _ in range(rnd.randint(0, 12)))
        b = "".join(rnd.choice("ABCDÉ ") for _ in range(rnd.randint(0, 12)))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", ratio(F.col("a"), F.col("b")).alias("s")).collect()
    for r in got:
        assert abs(r.s - ratio_py(r.a, r.b)) < 1e-9, (r.a, r.b)


def test_fixture_cases(spark):
    seed = spark.createDataFrame(
        [("medellin", "SANTA ANA"), ("bello", "NIQUÍA")], "city_name string, neighborhood_official_name string")
    rows = [
        (1, "ANA SANTA", "medellin"),   # token order ignored -> 100
        (2, "NIQUIA", "bello"),         # LCS 5 -> 83.3 >= 65
        (3, "XYZ", "bello"),            # 0 < 65 -> original
        (4, None, "bello"),             # NULL name kept
        (5, "NIQUIA", ""),              # empty city kept
        (6, "NIQUIA", "cali"),          # city without seed kept
        (7, "NIQUIA", "medellin"),      # blocked by city
        (8, "NIQUIA", None),            # NULL city matches nothing
    ]
    df = spark.createDataFrame(rows, "id int, common_neighborhood_name string, city_name string")
    for scorer in ("vectorized", "native"):
        out = standardize(df, seed, name="common_neighborhood_name", block="city_name",
                          official="neighborhood_official_name", out="neighborhood_final", scorer=scorer)
        got = {r.id: r.neighborhood_final for r in out.collect()}
        assert got == {1: "SANTA ANA", 2: "NIQUÍA", 3: "XYZ", 4: None, 5: "NIQUIA", 6: "NIQUIA",
                       7: "NIQUIA", 8: "NIQUIA"}, scorer
        assert out.count() == len(rows)


def test_best_score_wins_with_name_tiebreak(spark):
    seed = spark.createDataFrame([("c", "ABCD"), ("c", "ABCE"), ("c", "ZZZZ")],
                                 "city_name string, neighborhood_official_name string")
    df = spark.createDataFrame([(1, "ABC", "c")], "id int, common_neighborhood_name string, city_name string")
    out = standardize(df, seed, "common_neighborhood_name", "city_name", "neighborhood_official_name", "nf")
    assert out.collect()[0].nf == "ABCD"  # equal scores: the smallest name


def test_prefix_candidates_equal_block_candidates(spark):
    """Exact prefix filtering loses no match: same result as comparing every
    length-compatible pair of the block, on random near-duplicate names."""
    rnd = random.Random(5)
    words = ["SANTA", "ANA", "NIQUÍA", "BELLO", "SAN", "JOSE", "LA", "CANDELARIA", "NORTE", "SUR", "A"]
    def name():
        toks = [rnd.choice(words) for _ in range(rnd.randint(1, 3))]
        t = " ".join(toks)
        if t and rnd.random() < 0.5:  # typo: drop or swap one character
            i = rnd.randrange(len(t))
            t = t[:i] + t[i + 1:] if rnd.random() < 0.5 else t[:i] + rnd.choice("AEIOUXZ") + t[i + 1:]
        return t
    cities = ["c1", "c2", "c3"]
    seed = spark.createDataFrame(list({(rnd.choice(cities), name()) for _ in range(60)}),
                                 "city_name string, neighborhood_official_name string")
    rows = [(i, name(), rnd.choice(cities)) for i in range(300)] + [(900, "", "c1"), (901, "", "c2")]
    seed = seed.union(spark.createDataFrame([("c1", "")], "city_name string, neighborhood_official_name string"))
    df = spark.createDataFrame(rows, "id int, common_neighborhood_name string, city_name string")
    got = {}
    for how in ("prefix", "block"):
        for thr in (65.0, 40.0, 90.0):
            out = standardize(df, seed, "common_neighborhood_name", "city_name", "neighborhood_official_name",
                              "nf", threshold=thr, candidates=how)
            got[(how, thr)] = sorted((r.id, r.nf) for r in out.collect())
    for thr in (65.0, 40.0, 90.0):
        assert got[("prefix", thr)] == got[("block", thr)], thr
    assert dict(got[("prefix", 65.0)])[900] == ""  # empty name matches the empty official name (score 100)


def test_prefix_candidates_on_a_hot_block(spark):
    """One city with all names: the default finds what all pairs find, from far fewer pairs."""
    import random

    from rentscope.operators import standardize as S
    rnd = random.Random(5)
    official = sorted({"".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(300)})
    messy = sorted({"".join(c for c in o if rnd.random() > 0.1) for o in official})
    names = spark.createDataFrame([("hot", n) for n in messy], "city string, name string")
    seed = spark.createDataFrame([("hot", o) for o in official], "city string, official string")
    got = {k: sorted(map(tuple, S.best_matches(names, seed, "city", "name", "official", candidates=k).collect()))
           for k in ("prefix", "block")}
    assert got["prefix"] == got["block"] and len(got["prefix"]) > 200
    q = names.select("city", F.col("name").alias("_qs"))
    s = seed.select(F.col("city").alias("_sb"), F.col("official").alias("_ss"))
    assert S._candidates_prefix(q, s, "city", S.DEFAULT_THRESHOLD).count() < 0.9 * len(messy) * len(official)
