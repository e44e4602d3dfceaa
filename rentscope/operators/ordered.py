"""Skew-safe ordered scans: row number, ranks, running sums, neighbour rows,
medians, without sending any group to a single task.

A window ``PARTITION BY g ORDER BY x`` puts every row of a group in one task;
a group holding a third of the table would then be scanned by one core.  Here
each group is cut into slots (``operators.slots``): ranges that follow the
order, of a bounded number of rows, whatever the distribution of the values and
also where one value holds most of them.  Window functions run per (group,
slot); a summary with one row per (group, slot) -- a partial aggregate -- gives
the offsets of the slots before.  A table that fits one slot as a whole is
scanned by plain windows over its groups.

Everything is built-in functions, values keep their types, and results do not
depend on the cuts.  Requires a total order within each group: ``ties`` names
ascending tie-break columns (or gives sort expressions, which order rows but
cannot cut a hot value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .slots import Slots

RANK, CUM, COUNT, TOTAL, DENSE, BELOW, UPTO = "_rank", "_cum", "_n", "_total", "_dense", "_below", "_upto"


def _direction(lead: str, descending: bool, nulls_last: bool) -> Column:
    x = F.col(f"`{lead}`")
    return (x.desc_nulls_last() if nulls_last else x.desc_nulls_first()) if descending else \
        (x.asc_nulls_last() if nulls_last else x.asc_nulls_first())


def _slots(df: DataFrame, lead: str, ties: Sequence, descending: bool, nulls_last: bool, rows: int | None,
           rows_per_slot: int | None) -> Slots:
    names = []
    for t in ties:
        if not isinstance(t, str):
            break
        names.append(t)
    return Slots.of(df, lead, names, descending, nulls_last, rows, rows_per_slot)


def _slotted(df: DataFrame, by: Sequence[str], slots: Slots) -> DataFrame:
    """df + ``_k``: (group columns, slot path), a struct whose NULL fields compare equal."""
    return slots.apply(df).withColumn("_k", F.struct(*[F.col(f"`{c}`") for c in by], *slots.paths)).drop(*slots.paths)


def _group(by: Sequence[str]) -> list[Column]:
    return [F.col(f"_k.`{c}`") for c in by]


def _offsets(slotted: DataFrame, by: Sequence[str], slots: Slots, value: Column, dense: bool) -> DataFrame:
    """Per (group, slot): rows, value sum and count of the slots before and of
    the group; rows and distinct values of the leading column below the slot's."""
    sums = [F.count(F.lit(1)).alias("_pn"), F.sum(value).alias("_ps"), F.count(value).alias("_pc")]
    path = [F.col(f"_k.{c}") for c in slots.paths]
    group = _group(by)
    lead = path[0]
    if dense:
        # by slot and value, then by slot: one pass over the rows for sums and distinct values
        per = slotted.groupBy("_k", F.col(f"`{slots.lead}`").alias("_lead")).agg(*sums).groupBy("_k").agg(
            *[F.sum(c).alias(c) for c in ("_pn", "_ps", "_pc")], F.count(F.lit(1)).alias("_pd"))
        # the slots of a hot value share it: it counts where its first slot is
        first = F.row_number().over(Window.partitionBy(*group, lead).orderBy(*path)) == 1
        per = per.withColumn("_pd", F.when(first, F.col("_pd")).otherwise(0))
    else:
        per = slotted.groupBy("_k").agg(*sums)
    before = Window.partitionBy(*group).orderBy(*path).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy(*group).orderBy(lead).rangeBetween(Window.unboundedPreceding, -1)
    whole, alike = Window.partitionBy(*group), Window.partitionBy(*group, lead)
    return per.select(
        "_k", "_pn",
        F.coalesce(F.sum("_pn").over(before), F.lit(0)).alias("_rank_off"),
        F.sum("_ps").over(before).alias("_cum_off"),
        F.coalesce(F.sum("_pc").over(before), F.lit(0)).alias("_cnt_off"),
        F.coalesce(F.sum("_pn").over(below), F.lit(0)).alias("_below_off"),
        F.sum("_pn").over(alike).alias("_alike"), F.count(F.lit(1)).over(alike).alias("_parts"),
        *([F.coalesce(F.sum("_pd").over(below), F.lit(0)).alias("_dense_off")] if dense else []),
        F.sum("_pn").over(whole).alias(COUNT), F.sum("_ps").over(whole).alias(TOTAL))


def ordered_scan(df: DataFrame, by: Sequence[str], lead: str, ties: Sequence = (), value: str | None = None,
                 descending: bool = False, nulls_last: bool | None = None, dense: bool = False, ranks: bool = False,
                 rows: int | None = None, rows_per_slot: int | None = None) -> DataFrame:
    """df + _rank (row number in group order), _cum (running SUM(value), NULL
    while no non-NULL value seen), _n (group rows), _total (SUM(value)); with
    ``dense`` _dense (DENSE_RANK of ``lead``); with ``ranks`` _below and _upto
    (rows before the first, and up to the last, of equal ``lead``).

    NULLs come first in ascending and last in descending order unless
    ``nulls_last`` says otherwise.  ``rows`` is a known bound of the table's
    rows; otherwise they are counted."""
    by = list(by)
    nulls_last = descending if nulls_last is None else nulls_last
    first = _direction(lead, descending, nulls_last)
    val = F.col(f"`{value}`") if value else F.lit(None).cast("double")
    slots = _slots(df, lead, ties, descending, nulls_last, rows, rows_per_slot)
    keys = [F.col(f"`{c}`") for c in by] if slots.single else [F.col("_k")]
    slotted = df if slots.single else _slotted(df, by, slots)
    order = Window.partitionBy(*keys).orderBy(first, *ties)
    alike = Window.partitionBy(*keys).orderBy(first)
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    local = {"_lrank": F.row_number().over(order), "_lcum": F.sum(val).over(running), "_lcnt": F.count(val).over(running)}
    if dense:
        local["_ldense"] = F.dense_rank().over(alike)
    if ranks:
        local |= {"_lbelow": F.rank().over(alike) - 1,
                  "_lupto": F.count(F.lit(1)).over(alike.rangeBetween(Window.unboundedPreceding, Window.currentRow))}
    if slots.single:
        whole = Window.partitionBy(*keys)
        j = slotted.withColumns(local | {COUNT: F.count(F.lit(1)).over(whole), TOTAL: F.sum(val).over(whole)})
        zero = F.lit(0)
        offsets = dict.fromkeys(("_rank_off", "_cnt_off", "_below_off", "_dense_off"), zero)
        cum, upto = F.col("_lcum"), F.col("_lupto")
    else:
        j = slotted.withColumns(local).join(_offsets(slotted, by, slots, val, dense), "_k")
        offsets = {c: F.col(c) for c in ("_rank_off", "_cnt_off", "_below_off", "_dense_off")}
        cum = F.when(F.col("_lcum").isNull(), F.col("_cum_off")).when(F.col("_cum_off").isNull(), F.col("_lcum")) \
            .otherwise(F.col("_lcum") + F.col("_cum_off"))
        upto = F.when(F.col("_parts") > 1, F.col("_alike")).otherwise(F.col("_lupto"))
    extra = [(F.col("_ldense") + offsets["_dense_off"]).cast("bigint").alias(DENSE)] if dense else []
    if ranks:
        extra += [(F.col("_lbelow") + offsets["_below_off"]).cast("bigint").alias(BELOW),
                  (upto + offsets["_below_off"]).cast("bigint").alias(UPTO)]
    return j.select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("_lrank") + offsets["_rank_off"]).cast("bigint").alias(RANK),
                    F.when(F.col("_lcnt") + offsets["_cnt_off"] > 0, cum).alias(CUM), F.col(COUNT), F.col(TOTAL), *extra)


def _by(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def running_total(df: DataFrame, by, x: str, ties: Sequence, out: str = "running", lead: str | None = None,
                  descending: bool = True, rows: int | None = None, rows_per_slot: int | None = None) -> DataFrame:
    """Running SUM(x) in the order of ``lead`` (``x`` itself by default)."""
    s = ordered_scan(df, _by(by), lead or x, ties, x, descending, rows=rows, rows_per_slot=rows_per_slot)
    return s.withColumnRenamed(CUM, out).drop(RANK, COUNT, TOTAL)


def ntile(df: DataFrame, by, lead: str, ties: Sequence, n: int, out: str = "tile", descending: bool = True,
          rows: int | None = None, rows_per_slot: int | None = None, scanned: bool = False) -> DataFrame:
    """NTILE(n): bucket sizes differ by at most one, larger buckets first.

    ``scanned``: df comes from ``ordered_scan`` over the same groups in the same
    order and still has its row numbers and counts; they are not made again."""
    s = df if scanned else ordered_scan(df, _by(by), lead, ties, descending=descending, rows=rows, rows_per_slot=rows_per_slot)
    r, N = F.col(RANK), F.col(COUNT)
    q = F.floor(N / n).cast("long")
    rem = (N - q * n).cast("long")
    big = rem * (q + 1)
    tile = F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1) \
            .otherwise(rem + F.floor((r - big - 1) / F.when(q > 0, q).otherwise(F.lit(1))) + 1)
    return s.withColumn(out, tile.cast("int")).drop(RANK, CUM, COUNT, TOTAL)


def pareto(df: DataFrame, by, x: str, ties: Sequence, cut: float = 80.0, rows: int | None = None,
           rows_per_slot: int | None = None) -> DataFrame:
    """Skew-safe form of ``windows.pareto`` (same columns)."""
    s = ordered_scan(df, _by(by), x, ties, x, descending=True, dense=True, rows=rows, rows_per_slot=rows_per_slot)
    s = (s.withColumnRenamed(CUM, "cum_value").withColumnRenamed(TOTAL, "group_total")
          .withColumnRenamed(DENSE, "ranking")
          .withColumn("cum_pct", F.lit(100.0) * F.try_divide(F.col("cum_value"), F.col("group_total")))
          .drop(RANK, COUNT))
    return s.filter(F.col("cum_pct") <= cut)


def relative_ranks(df: DataFrame, by, lead: str, percent: str = "percent_rank", cumulative: str = "cume_dist",
                   descending: bool = False, nulls_last: bool | None = None, ties: Sequence[str] = (),
                   rows: int | None = None, rows_per_slot: int | None = None) -> DataFrame:
    """df + PERCENT_RANK and CUME_DIST of ``lead`` within its group.

    Rows of equal ``lead`` share both values; ``ties`` only name columns by
    which a hot value may be cut."""
    s = ordered_scan(df, _by(by), lead, ties, None, descending, nulls_last, ranks=True, rows=rows, rows_per_slot=rows_per_slot)
    n = F.col(COUNT)
    return s.withColumns({percent: F.when(n > 1, F.col(BELOW) / (n - 1)).otherwise(F.lit(0.0)), cumulative: F.col(UPTO) / n}) \
        .drop(RANK, CUM, COUNT, TOTAL, BELOW, UPTO)


def neighbours(df: DataFrame, by, lead: str, ties: Sequence, previous: dict[str, str] | None = None,
               following: dict[str, str] | None = None, descending: bool = False, nulls_last: bool | None = None,
               rows: int | None = None, rows_per_slot: int | None = None) -> DataFrame:
    """df + LAG / LEAD by one row: ``previous`` and ``following`` map a new
    column to the column it takes from the row before or behind.

    Within a slot these are window functions; the first and last rows of the
    slots are the summary, in which a slot finds the nearest one that the
    group has."""
    by, previous, following = _by(by), previous or {}, following or {}
    nulls_last = descending if nulls_last is None else nulls_last
    slots = _slots(df, lead, ties, descending, nulls_last, rows, rows_per_slot)
    keys = [F.col(f"`{c}`") for c in by] if slots.single else [F.col("_k")]
    order = Window.partitionBy(*keys).orderBy(_direction(lead, descending, nulls_last), *ties)
    before = {out: F.lag(F.col(f"`{c}`")).over(order) for out, c in previous.items()}
    behind = {out: F.lead(F.col(f"`{c}`")).over(order) for out, c in following.items()}
    if slots.single:
        return df.withColumns(before | behind)
    local = _slotted(df, by, slots).withColumns(before | behind | {
        "_at": F.row_number().over(order), "_size": F.count(F.lit(1)).over(Window.partitionBy(*keys))})
    last = F.struct(*[F.col(f"`{c}`").alias(f"p{k}") for k, c in enumerate(previous.values())], F.lit(1).alias("any"))
    head = F.struct(*[F.col(f"`{c}`").alias(f"f{k}") for k, c in enumerate(following.values())], F.lit(1).alias("any"))
    ends = local.where((F.col("_at") == 1) | (F.col("_at") == F.col("_size"))).groupBy("_k").agg(
        F.max_by(last, "_at").alias("_last"), F.min_by(head, "_at").alias("_head"))
    over = Window.partitionBy(*_group(by)).orderBy(*[F.col(f"_k.{c}") for c in slots.paths])
    edge = ends.select("_k", F.lag("_last").over(over).alias("_last"), F.lead("_head").over(over).alias("_head"))
    j = local.join(edge, "_k")
    fixed = {out: F.when(F.col("_at") == 1, F.col(f"_last.p{k}")).otherwise(F.col(out)) for k, out in enumerate(previous)} | \
        {out: F.when(F.col("_at") == F.col("_size"), F.col(f"_head.f{k}")).otherwise(F.col(out)) for k, out in enumerate(following)}
    return j.withColumns(fixed).select(*[F.col(f"`{c}`") for c in df.columns], *previous, *following)


def carry_forward(df: DataFrame, by, lead: str, ties: Sequence, value: str, out: str, descending: bool = False,
                  nulls_last: bool | None = None, rows: int | None = None, rows_per_slot: int | None = None) -> DataFrame:
    """df + the last non-NULL ``value`` at or before each row of its group.

    A slot's own last value is the summary; a slot without one takes that of the
    nearest slot before."""
    by = _by(by)
    nulls_last = descending if nulls_last is None else nulls_last
    slots = _slots(df, lead, ties, descending, nulls_last, rows, rows_per_slot)
    keys = [F.col(f"`{c}`") for c in by] if slots.single else [F.col("_k")]
    rows_to_here = Window.partitionBy(*keys).orderBy(_direction(lead, descending, nulls_last), *ties) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.last(F.col(f"`{value}`"), ignorenulls=True).over(rows_to_here)
    if slots.single:
        return df.withColumn(out, here)
    local = _slotted(df, by, slots).withColumns({out: here, "_at": F.count(F.lit(1)).over(rows_to_here)})
    ends = local.groupBy("_k").agg(F.max_by(out, "_at").alias("_end"))
    before = Window.partitionBy(*_group(by)).orderBy(*[F.col(f"_k.{c}") for c in slots.paths]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_k", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    return local.join(carried, "_k").withColumn(out, F.coalesce(out, "_carried")) \
        .select(*[F.col(f"`{c}`") for c in df.columns], out)


def median(df: DataFrame, by: Sequence[str], x: Column | str, out: str = "median", rows: int | None = None,
           rows_per_slot: int | None = None) -> DataFrame:
    """Exact median per group (mean of the two middle values when the count is
    even): the summary names the slots that hold the middle ranks, and only
    their rows are numbered; a slot of one value needs no numbers.  A table that
    fits one slot is aggregated directly."""
    by = list(by)
    xc = F.col(x) if isinstance(x, str) else x
    v = df.select(*by, xc.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    slots = Slots.of(v, "_v", rows=rows, rows_per_slot=rows_per_slot)
    if slots.single:
        return v.groupBy(*by).agg(F.median("_v").alias(out))
    slotted = _slotted(v, by, slots)
    per = slotted.groupBy("_k").agg(F.count(F.lit(1)).alias("_pn"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    group, path = _group(by), [F.col(f"_k.{c}") for c in slots.paths]
    off = F.coalesce(F.sum("_pn").over(Window.partitionBy(*group).orderBy(*path)
                                       .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = F.sum("_pn").over(Window.partitionBy(*group))
    middle = F.array_distinct(F.array(F.floor((n + 1) / 2), F.ceil((n + 1) / 2)))
    ranked = per.withColumns({"_off": off, "_want": middle}).select(
        "_k", "_lo", "_hi", "_off",
        F.filter("_want", lambda r: (r > F.col("_off")) & (r <= F.col("_off") + F.col("_pn"))).alias("_want")) \
        .where(F.size("_want") > 0)
    one = ranked.where(F.col("_lo").eqNullSafe(F.col("_hi"))).select("_k", F.explode("_want").alias("_r"), F.col("_lo").alias("_v"))
    many = slotted.join(ranked.where(~F.col("_lo").eqNullSafe(F.col("_hi"))), "_k")
    number = F.row_number().over(Window.partitionBy("_k").orderBy("_v")) + F.col("_off")
    mid = many.withColumn("_r", number).where(F.array_contains("_want", F.col("_r"))).select("_k", "_r", "_v")
    return one.unionByName(mid).select(*[c.alias(n) for c, n in zip(group, by)], "_v").groupBy(*by).agg(F.avg("_v").alias(out))
