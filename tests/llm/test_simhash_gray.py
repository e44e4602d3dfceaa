import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rentscope.llm import simhash_gray as G
from rentscope.llm.components import components


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(values, limit=3):
    lab = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= limit:
                a, b = lab[i], lab[j]
                lab = [min(a, b) if x in (a, b) else x for x in lab]
    return lab


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_simhash_equals_brute_force(text):
    assert G.simhash(text.encode("utf-8", "surrogatepass")) == brute_bytes(text)


def brute_bytes(text):
    raw = text.encode("utf-8", "surrogatepass").translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    w = raw.split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_gray_index_equals_brute_force():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 4, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << rng.integers(0, 64, 90).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 90).astype(np.uint64)) for b in base]
    x = np.unique(np.concatenate([*near, rng.integers(0, 2**63, 300, dtype=np.uint64)]))
    order, labels = G.gray_links(x)
    assert closure([int(v) for v in x[order]]) == labels.tolist()


def test_gray_rank_is_a_gray_code_position():
    n = np.arange(64, dtype=np.uint64)
    assert (G.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def _nodes(spark, values):
    return spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)], "id bigint, fp bigint")


def test_ranges_lose_no_link(spark):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**63))
    values = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))}
                    | {int(v) for v in rng.integers(0, 2**64, 60, dtype=np.uint64)})
    lab = closure(values)
    want = {i: c for i, c in enumerate(lab) if lab.count(c) > 1}
    for rows in (None, 16, 5):
        got = {r.node: r.component for r in components(G.link_forest(_nodes(spark, values), rows=rows)).collect()}
        assert got == want


def test_gray_order_in_spark_is_the_rank(spark):
    values = [0, 1, 2**63, 2**64 - 1, *np.random.default_rng(1).integers(0, 2**64, 200, dtype=np.uint64).tolist()]
    rows = _nodes(spark, values).select("id", G.gray_order(G.F.col("fp")).alias("r")).orderBy("r").collect()
    rank = G.gray_rank(np.array(values, np.uint64))
    assert [r.id for r in rows] == np.argsort(rank, kind="stable").tolist()


def test_the_hierarchy_forms_and_prunes_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    nodes = G.materialize(G.fingerprints(docs), "test-fps").groupBy("fp").agg(G.F.min("id").alias("id"))
    index = G.gray_index(nodes)
    ranges = index.count()
    x = np.concatenate([np.frombuffer(r.fps, np.uint64) for r in index.select("range", "fps").orderBy("range").collect()])
    rank = G.gray_rank(x)
    assert ranges > 10 and len(x) == nodes.count() and (rank[1:] > rank[:-1]).all()
    assert index.where("mask <> 0").count() > ranges / 2          # neighbours share bits
    pairs = G.range_pairs(index).count()
    assert ranges <= pairs < ranges * (ranges + 1) // 2           # whole ranges are pruned,
    seen = {}
    order, labels = G.gray_links(x, seen=seen)
    upper = sum(len(level[0]) for level in G._groups(x)[1:])
    assert upper > 50 and seen["pruned"] > seen["judged"] / 2    # ... and groups within them
    # every link is found: all pairs, in blocks
    want = np.arange(len(x))
    for k in range(0, len(x), 256):
        i, j = np.nonzero(np.bitwise_count(x[k:k + 256, None] ^ x[None, :]) <= 3)
        G._merge(want, i + k, j)
    assert (labels == want).all() and (order == np.arange(len(x))).all()


def test_components_of_paths_loops_and_nothing(spark):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (200, 100), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100, 200: 100}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_groups_of_documents(spark, make_docs, prose):
    a, b = prose(1, 150), prose(2, 150)
    texts = [(9, a), (4, a), (4, a), (7, a + " tail."), (2, None), (3, ""), (5, " \n"), (6, b), (8, "two words"), (11, b.upper())]
    docs = make_docs(texts)
    rows = G.near_dup_groups(docs).collect()
    fps = [(i, brute(t)) for i, t in texts]
    lab = closure([f for _, f in fps])
    small = {c: min(fps[k][0] for k in range(len(fps)) if lab[k] == c) for c in lab}
    assert sorted((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in rows) == sorted((i, f, small[c]) for (i, f), c in zip(fps, lab))
    assert G.near_dup_groups(docs.limit(0)).count() == 0
