"""City-blocked fuzzy standardization of free-text names.

For every row, the name is replaced by the best-scoring official name of the
same block (city) when that score reaches the threshold; otherwise the
original is kept.  Work is done once per distinct (block, name), not per row:

1. distinct (block, name) over the data (partial aggregate),
2. candidates = the block's official names that share a rare (character,
   occurrence) token, as every qualifying pair must, and whose *length bound*
   can still reach the threshold (LCS <= shorter length),
3. LCS score (bit-parallel in Arrow batches, or the native expression),
   once per distinct pair of token-sorted texts; best candidate per (block, name) by max score then the
   smallest name (a deterministic tie-break),
4. join the small result back on (block, name).

The candidate join is left to AQE: it broadcasts the seed side only when the
measured size is under the broadcast threshold, and otherwise runs a
sort-merge join whose hot (city) partitions it splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import length_bound, ratio, ratio_vectorized
from ..functions.text import token_sort

DEFAULT_THRESHOLD = 65.0  # fixed value: acceptance score of the source rule


def _min_overlap(own_len, threshold: float):
    """Smallest multiset overlap any qualifying partner can need: the
    partner is at least thr/(200-thr) times as long (else the length bound
    fails), and the score needs LCS >= thr*(la+lb)/200 (LCS <= overlap)."""
    eps = 1e-9
    partner_min = F.ceil(own_len * threshold / (200.0 - threshold) - eps)
    return F.ceil((own_len + partner_min) * threshold / 200.0 - eps)


def _prefix_tokens(df: DataFrame, key_cols: list, text: str, counts: DataFrame, threshold: float) -> DataFrame:
    """(key..., ch, occ) for the rarest ``len - t + 1`` tokens of each text,
    where a token is (character, occurrence number of that character)."""
    chars = F.split(F.col(text), "")
    occ = F.transform(chars, lambda c, i: F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == c)))
    toks = (df.select(*key_cols, text, F.explode(F.arrays_zip(chars.alias("ch"), occ.alias("occ"))).alias("_t"))
              .select(*key_cols, text, "_t.ch", "_t.occ").where(F.length("ch") > 0))
    ranked = toks.join(counts, ["ch", "occ"])
    per = ranked.groupBy(*key_cols, text).agg(
        F.array_sort(F.collect_list(F.struct("_freq", "ch", "occ"))).alias("_toks"))
    n = F.length(text)
    plen = F.least(n, F.greatest(F.lit(1), n - _min_overlap(n, threshold) + 1)).cast("int")
    return (per.select(*key_cols, text, F.explode(F.slice("_toks", 1, plen)).alias("_p"))
               .select(*key_cols, text, "_p.ch", "_p.occ"))


def _candidates_prefix(q: DataFrame, s: DataFrame, block: str, threshold: float) -> DataFrame:
    """(block, _qs, _ss) pairs that can reach the threshold, found through an
    equi-join on (block, prefix token) -- exact prefix filtering, so no pair
    that could qualify is lost and no all-pairs product is formed.  Two
    empty texts (score 100) have no tokens and are paired directly."""
    qt = q.select(F.col(block).alias("_b"), "_qs").distinct()
    st = s.select(F.col("_sb").alias("_b"), "_ss").distinct()
    # global token order: rarest (character, occurrence) first
    both = (qt.select(F.col("_qs").alias("_x")).union(st.select(F.col("_ss").alias("_x"))))
    cc = F.split(F.col("_x"), "")
    occ = F.transform(cc, lambda c, i: F.size(F.filter(F.slice(cc, 1, i + 1), lambda x: x == c)))
    counts = (both.select(F.explode(F.arrays_zip(cc.alias("ch"), occ.alias("occ"))).alias("_t"))
                  .select("_t.ch", "_t.occ").where(F.length("ch") > 0)
                  .groupBy("ch", "occ").agg(F.count(F.lit(1)).alias("_freq")))
    qp = _prefix_tokens(qt, ["_b"], "_qs", counts, threshold)
    sp = _prefix_tokens(st, ["_b"], "_ss", counts, threshold)
    pairs = qp.join(sp, ["_b", "ch", "occ"]).select("_b", "_qs", "_ss").distinct()
    empty = (qt.where(F.length("_qs") == 0).join(st.where(F.length("_ss") == 0), "_b")
               .select("_b", "_qs", "_ss"))
    return pairs.unionByName(empty).withColumnRenamed("_b", block)


def best_matches(names: DataFrame, seed: DataFrame, block: str, name: str, official: str,
                 threshold: float = DEFAULT_THRESHOLD, scorer: str = "vectorized",
                 candidates: str = "prefix") -> DataFrame:
    """(block, name) -> (block, name, match, score) for names with a candidate
    at or above the threshold.

    ``candidates="prefix"`` (default) generates pairs by exact prefix
    filtering on (block, rare token): no qualifying pair is lost and no
    all-pairs product of a block is formed.  ``"block"`` pairs each distinct
    name with the official names of its block that pass the length bound;
    fine where a block's official list is short (tests compare the two)."""
    q = (names.select(block, name).where(F.col(name).isNotNull() & F.col(block).isNotNull())
              .distinct()
              .select(block, name, token_sort(F.col(name)).alias("_qs")))
    q = q.select("*", F.length("_qs").alias("_ql"))
    s = (seed.select(F.col(block).alias("_sb"), F.col(official).alias("_off"))
             .where(F.col("_off").isNotNull()).distinct()
             .select("_sb", "_off", token_sort(F.col("_off")).alias("_ss")))
    s = s.select("*", F.length("_ss").alias("_sl"))
    if candidates == "prefix" and threshold > 0:
        cand = _candidates_prefix(q, s, block, threshold).select(
            F.col(block).alias("_cb"), F.col("_qs").alias("_cq"), F.col("_ss").alias("_cs"))
        # merged: the size of q is planned from the packed files of the rows' table, so it
        # might be broadcast whatever its size in memory
        pairs = (cand.join(q.hint("merge"), (F.col("_cb") == F.col(block)) & (F.col("_cq") == F.col("_qs")))
                     .join(s.hint("merge"), (F.col("_cb") == F.col("_sb")) & (F.col("_cs") == F.col("_ss")))
                     .where(length_bound(F.col("_ql"), F.col("_sl")) >= threshold)
                     .select(block, name, "_off", "_qs", "_ss"))
    else:
        # Candidate pairs: same block, and a length bound that can still reach
        # the threshold.  AQE broadcasts the seed side when its measured size
        # is small and otherwise keeps a skew-split sort-merge join.
        cond = (F.col(block) == F.col("_sb")) & (length_bound(F.col("_ql"), F.col("_sl")) >= threshold)
        pairs = q.join(s, cond, "inner").select(block, name, "_off", "_qs", "_ss")
    # The score depends only on the two token-sorted texts: score each distinct
    # text pair once (names repeat across blocks), then join the scores back.
    # The pairs are few bytes but CPU-heavy to score, and AQE would coalesce
    # them by bytes into one task: they are hash-split into as many tasks as the
    # session's shuffles have (sized for the data), two per core at least.
    score_fn = ratio_vectorized if scorer == "vectorized" else ratio
    spark = names.sparkSession
    n_parts = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    scores = (pairs.select("_qs", "_ss").repartition(n_parts, "_qs", "_ss").distinct()
                   .withColumn("_score", score_fn(F.col("_qs"), F.col("_ss")))
                   .where(F.col("_score") >= threshold))
    scored = pairs.join(scores, ["_qs", "_ss"])
    best = scored.groupBy(block, name).agg(
        F.min_by(F.struct("_off", "_score"), F.struct(-F.col("_score"), F.col("_off"))).alias("_b"))
    return best.select(block, name, F.col("_b._off").alias("match"), F.col("_b._score").alias("score"))


def standardize(df: DataFrame, seed: DataFrame, name: str, block: str, official: str,
                out: str, threshold: float = DEFAULT_THRESHOLD, scorer: str = "vectorized",
                candidates: str = "prefix") -> DataFrame:
    """df + ``out``: matched official name or the original.

    Guards: NULL name, empty block, or a block without seed rows keep the
    original (a NULL block matches nothing)."""
    best = best_matches(df.where(F.col(block) != ""), seed, block, name, official, threshold, scorer,
                        candidates)
    best = best.select(F.col(block).alias("_mb"), F.col(name).alias("_mn"), "match")
    joined = df.join(best, (F.col(block) == F.col("_mb")) & (F.col(name) == F.col("_mn")), "left")
    return joined.withColumn(out, F.coalesce(F.col("match"), F.col(name))).drop("_mb", "_mn", "match")
