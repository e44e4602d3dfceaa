"""The pipeline stage by stage on a small table with planted cases, against
brute-force versions of its filters."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P

from .test_fm_decontam import brute as brute_hits
from .test_packing_tokens import ids_of
from .test_simhash_gray import brute as fingerprint
from .test_simhash_gray import closure

SF = "/root/testdata/sf0.001"
KEY = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6"


def test_registered():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination",
                                        "secret_scans", "best_fit_packing"]
    assert E.queries()["pipeline"] is P.run and "pipeline" not in E.oracle_sql()


def test_stages_on_planted_cases(spark, make_docs, prose):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()
    good = {k: prose(k, 200) for k in range(1, 9)}
    rows = [(k, t) for k, t in good.items()]
    rows += [(20, good[1]), (21, good[2]), (21, good[2]), (22, prose(9, 200) + "\n" + item.text),
             (23, prose(10, 200) + f'\nThe token = "{KEY}" stays there.'), (24, " | ".join(prose(11, 200).split())),
             (25, None), (26, ""), (None, prose(12, 200))]
    docs = make_docs(rows).withColumn("kept", F.lit("extra")).withColumn("text_hash", F.lit(1))
    cols = docs.columns
    one = P.quality_rules(spark, docs, SF)
    assert one.columns == cols
    assert sorted((r.doc_id or -1) for r in one.collect()) == sorted([*good, 20, 21, 21, 22, 23, -1])
    two = P.simhash_near_dedup(spark, one, SF)
    assert two.columns == cols
    assert sorted((r.doc_id or -1) for r in two.collect()) == sorted([*good, 22, 23, -1])
    three = P.benchmark_decontamination(spark, two, SF)
    assert three.columns == cols
    assert sorted((r.doc_id or -1) for r in three.collect()) == sorted([*good, 23, -1])
    four = P.secret_scans(spark, three, SF)
    texts = {r.doc_id: r for r in four.collect()}
    assert {(r.kept, r.text_hash) for r in texts.values()} == {("extra", 1)}
    assert four.columns == cols and KEY not in texts[23].text and "[SECRET]" in texts[23].text
    assert texts[23].n_chars == len(texts[23].text) and all(texts[k].text == good[k] for k in good)
    five = P.best_fit_packing(spark, four, SF).collect()
    assert sum(r.length for r in five) == sum(len(ids_of(r.text)) + 1 for r in texts.values())
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_run_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    read = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id: r.text for r in P.quality_rules(spark, read, SF).collect()}
    ids = sorted(kept)
    lab = closure([fingerprint(kept[i]) for i in ids])
    first = {c: min(i for i, x in zip(ids, lab) if x == c) for c in lab}
    stays = [i for i, c in zip(ids, lab) if first[c] == i]
    dirty = {r[0] for r in brute_hits([(i, kept[i]) for i in stays], items) if r[5]}
    texts = {i: re.sub(r'(token = ")[0-9a-fA-F]{40}(")', r"\1[SECRET]\2", kept[i], flags=re.I) for i in stays if i not in dirty}
    assert dirty and len(texts) < len(docs)
    got = {}
    for r in P.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(ids_of(t)) + 1 for i, t in texts.items()}


def test_near_dedup_with_shared_and_missing_ids(spark, make_docs, prose):
    a, b, c = (prose(k, 200) for k in (31, 32, 33))
    rows = [(5, a), (5, b), (None, c), (None, c + " "), (9, b), (7, a), (None, prose(34, 200))]
    got = sorted((r.doc_id or -1, r.text) for r in P.simhash_near_dedup(spark, make_docs(rows), SF).collect())
    want = {(5, a), (5, b), (-1, prose(34, 200))}
    assert len(got) == 4 and want < set(got) and [t for i, t in got if i == -1 and t.strip() == c]
