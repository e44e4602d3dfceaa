"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a few statistics on a log scale (built-in functions, one
pass, written once to the shared folder).  Class counts, sums and products of
the labelled rows are one small aggregate; class covariances are shrunk towards
the pooled one and then towards a multiple of the identity.  A score is the
logistic of the difference of the class log densities, each a Mahalanobis term
by a Cholesky factor that is computed once.

Only the text enters a score.  Defined cases: null and empty texts are scored
from zero counts; a text of one word has no windows; repeated rows and labels
count each; rows without an id are scored but never learned from; extra
columns are ignored; without labelled rows of both classes every score is the
share of label 1 among them (0.5 if there are none); an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import let, words_of

POOL = 0.1      # weight of the pooled covariance in each class
RIDGE = 0.01    # weight of the scaled identity
THRESHOLD = 0.7
HELD_OUT = 2    # remainder of crc32(id as text) mod 4 that is never learned from

STATS = ["words", "symbols", "upper", "digits", "stops", "shouts", "distinct", "repeats", "letters", "word_length",
         "line_repeats", "line_rate"]


def statistics(text: Column) -> Column:
    """Array of the transformed statistics of a text, in the order of ``STATS``."""
    t = F.coalesce(text, F.lit(""))

    def log_rate(count: Column, total: Column, spare: float) -> Column:
        return F.log((count + 0.5) / (total + spare))

    def of_text(x: Column) -> Column:
        def of_words(w: Column) -> Column:
            n, nw = F.length(x), F.size(w)
            windows = F.slice(F.transform(w, lambda a, i: F.xxhash64(a, F.get(w, i + 1), F.get(w, i + 2))),
                              F.lit(1), F.greatest(nw - 2, F.lit(0)))
            lines = F.filter(F.split(x, "\n"), lambda a: F.rlike(a, F.lit("[^\\x20\\x09-\\x0D]")))

            def count(pattern: str) -> Column:
                return F.regexp_count(x, F.lit(pattern))

            return let(F.struct(windows.alias("h"), lines.alias("l")), lambda z: F.array(
                F.log1p(nw),
                log_rate(count("[#*$%&|<>]"), n, 20),
                log_rate(count("\\p{Lu}"), n, 20),
                log_rate(count("[0-9]"), n, 20),
                log_rate(count("[.,;:!?]"), n, 20),
                log_rate(n - F.length(F.replace(x, F.lit("!"), F.lit(""))), n, 20),
                F.log((F.size(F.array_distinct(w)) + 1) / (nw + 2)),
                log_rate(F.size(z["h"]) - F.size(F.array_distinct(z["h"])), nw, 10),
                log_rate(count("\\p{L}"), n, 2),
                F.log((n + 1) / (nw + 1)),
                log_rate(F.size(z["l"]) - F.size(F.array_distinct(z["l"])), F.size(z["l"]), 2),
                F.log((F.size(z["l"]) + 1) / (nw + 10))))
        return let(words_of(x), of_words)

    return let(t, of_text)


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors and constants; or a constant score."""

    means: np.ndarray | None
    inverse: np.ndarray | None   # inverse of each class covariance's Cholesky factor
    offset: np.ndarray | None    # log prior minus half the log determinant
    constant: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        if self.means is None:
            return np.full(len(x), self.constant)
        logs = [self.offset[k] - 0.5 * (((x - self.means[k]) @ self.inverse[k].T) ** 2).sum(axis=1) for k in (0, 1)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def fit(labelled: DataFrame, pool: float = POOL, ridge: float = RIDGE) -> Discriminant:
    """Discriminant from rows of (x array<double>, label 0/1); two rows reach the driver."""
    p = len(STATS)
    x = [F.col("x")[i] for i in range(p)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(p)]
    products = [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(p) for j in range(i + 1)]
    rows = {r["label"]: r for r in labelled.groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect()}
    n = np.array([rows[k]["n"] if k in rows else 0 for k in (0, 1)], float)
    if n.min() < 2:
        return Discriminant(None, None, None, n[1] / n.sum() if n.sum() else 0.5)
    means = np.array([[rows[k][f"s{i}"] for i in range(p)] for k in (0, 1)]) / n[:, None]
    scatter = np.empty((2, p, p))
    for k in (0, 1):
        for i in range(p):
            for j in range(i + 1):
                scatter[k, i, j] = scatter[k, j, i] = rows[k][f"q{i}_{j}"] - n[k] * means[k, i] * means[k, j]
    pooled = scatter.sum(axis=0) / (n.sum() - 2)
    inverse, offset = [], []
    for k in (0, 1):
        cov = (1 - pool) * scatter[k] / (n[k] - 1) + pool * pooled
        cov = (1 - ridge) * cov + (ridge * np.trace(cov) / p + 1e-9) * np.eye(p)
        factor = np.linalg.cholesky(cov)
        inverse.append(np.linalg.inv(factor))
        offset.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(inverse), np.array(offset))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                    label: str = "quality") -> DataFrame:
    """(id_col, held_out, score, predicted), a row per document."""
    described = materialize(docs.select(F.col(f"`{id_col}`").alias("id"),
                                        statistics(F.col(f"`{text}`")).alias("x")), "statistics")
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")) \
        .where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    model = fit(described.join(known, "id").select("x", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x) if len(x) else [], pa.float64())],
                                             names=["id", "score"])

    scored = described.mapInArrow(run, f"id {described.schema['id'].dataType.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
