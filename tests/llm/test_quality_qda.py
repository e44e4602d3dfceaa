import zlib

import numpy as np
from pyspark.sql import functions as F

from rentscope.llm import quality_qda as Q

SF = "/root/testdata/sf0.01"


def test_fit_equals_numpy(spark):
    rng = np.random.default_rng(2)
    p = len(Q.STATS)
    x = {0: rng.normal(0, 1, (60, p)) @ rng.normal(0, 1, (p, p)), 1: rng.normal(1, 2, (90, p))}
    rows = [(v.tolist(), k) for k in x for v in x[k]]
    model = Q.fit(spark.createDataFrame(rows, "x array<double>, label int"))
    cov = [np.cov(x[k].T) for k in (0, 1)]
    pooled = (59 * cov[0] + 89 * cov[1]) / 148
    logs = []
    for k in (0, 1):
        c = 0.9 * cov[k] + 0.1 * pooled
        c = 0.99 * c + 0.01 * np.trace(c) / p * np.eye(p)
        d = x[1] - x[k].mean(axis=0)
        logs.append(np.log(len(x[k]) / 150) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (d @ np.linalg.inv(c) * d).sum(axis=1))
    want = 1 / (1 + np.exp(logs[0] - logs[1]))
    assert np.allclose(model.score(x[1]), want, atol=1e-6)


def test_held_out_accuracy_and_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = Q.score_documents(docs, labels)
    rows = out.join(labels, "doc_id").collect()
    assert out.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    # labels of the held-out fold change nothing
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in Q.score_documents(docs, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in rows)


def test_edges(spark, make_docs, prose):
    docs = make_docs([(1, None), (1, None), (2, ""), (None, "a b"), (4, "word"), (5, prose(1, 9000))]).withColumn("score", F.lit("x"))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = Q.score_documents(docs, none).collect()
    assert len(rows) == 6 and all(r.score == 0.5 and r.predicted == 0 for r in rows)
    one = spark.createDataFrame([(1, 1), (4, 1), (5, None)], "doc_id bigint, quality int")
    assert {r.score for r in Q.score_documents(docs, one).collect()} <= {1.0, 0.5}
    assert Q.score_documents(docs.limit(0), none).count() == 0
