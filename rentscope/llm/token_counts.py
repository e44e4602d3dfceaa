"""Token counts: an exact histogram of encoded lengths and its suffix sums.

Every task counts its documents by length (a few thousand numbers), one small
shuffle adds the counts up.  Suffix sums then answer totals, quantiles and
truncated totals for every context limit without the texts.  They are taken
in two levels (within blocks of lengths, and over the blocks), so no window
holds the whole histogram.

Defined cases: null and empty texts have length 0 and are counted; repeated
rows count each; extra columns are ignored; an empty table gives an empty
histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import map_arrow
from .encode import WordEncoder

BLOCK = 256  # lengths in a block of the suffix sums


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(n_tokens, n_docs): documents by encoded length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = WordEncoder.of(tokenizer)
        counts: dict[int, int] = {}
        for b in batches:
            for t in b.column(0).to_pylist():
                n = len(enc.encode(t)) // 4
                counts[n] = counts.get(n, 0) + 1
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()),
                                              pa.array(list(counts.values()), pa.int64())], names=["n_tokens", "n"])

    parts = map_arrow(docs.select(F.col(f"`{text}`").cast("string").alias("t")), run, "n_tokens bigint, n bigint")
    return parts.groupBy("n_tokens").agg(F.sum("n").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """A row per length L with what a context limit of L keeps.

    ``docs_at_least`` / ``tokens_at_least`` cover the documents of L tokens or
    more, ``tokens_truncated`` is the corpus cut to L tokens a document,
    ``share_at_most`` the share of documents no longer than L (L is the
    quantile of every share up to it and above the row before)."""
    # read twice below (within blocks, over blocks): written once, so the texts are encoded once
    h = materialize(hist, "lengths").withColumn("block", F.floor(F.col("n_tokens") / BLOCK)) \
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    down = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    over = blocks.select(
        "block", F.coalesce(F.sum("d").over(down), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(down), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(Window.partitionBy(F.lit(1))).alias("total_docs"),
        F.sum("t").over(Window.partitionBy(F.lit(1))).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    return h.join(over, "block") \
        .withColumn("docs_at_least", F.sum("n_docs").over(inside) + F.col("docs_above")) \
        .withColumn("tokens_at_least", F.sum("tokens").over(inside) + F.col("tokens_above")) \
        .select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "total_docs", "total_tokens",
                (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least"))
                .alias("tokens_truncated"),
                ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs"))
                .alias("share_at_most"))


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, tokens_truncated) for any limits, from ``suffix_sums``.

    The first length at or above a limit tells how many documents reach it."""
    cells = []
    for limit in limits:
        reach = F.min_by(F.struct("docs_at_least", "tokens_at_least"),
                         F.when(F.col("n_tokens") >= limit, F.col("n_tokens")))
        kept = F.coalesce(reach["docs_at_least"] * limit - reach["tokens_at_least"], F.lit(0))
        cells.append(F.struct(F.lit(limit).cast("bigint").alias("context_limit"),
                              (F.coalesce(F.max("total_tokens"), F.lit(0)) + kept).alias("tokens_truncated")))
    return sums.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that so large a share of documents does not exceed."""
    cells = [F.struct(F.lit(s).alias("share"),
                      F.min(F.when(F.col("share_at_most") >= s, F.col("n_tokens"))).alias("n_tokens")) for s in shares]
    return sums.agg(F.array(*cells).alias("a")).select(F.inline("a"))
