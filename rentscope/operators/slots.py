"""Order-preserving slots: groups cut into ranges of rows of bounded size.

A slot is a range of the leading order column, from boundaries that a
distributed quantile sketch has found: whatever the distribution, about as many
rows of the whole table lie between two boundaries, so no group has more of
them in a slot.  Outliers take no slots of their own accord.  A value that is a
boundary has a slot to itself; where the sketch names it more than once it
holds more rows than a slot should, and is cut again, into ranges of the first
tie-break column, then of the next.

The sketch is taken once, merged in two steps, and only its boundaries (a
bounded number) reach the driver, where they become literals of the plan: a
row's slot depends on nothing but the row, however often a stage is run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_SLOT = 500_000
MAX_SLOTS = 4096
SKETCH_K = 4096             # rank error of about one part in a thousand
MERGE_WAYS = 64             # sketches of partitions are merged so many at a time, then together
_TOP = 2 * MAX_SLOTS + 2    # above all numbered ranges


def ascending_value(df: DataFrame, name: str) -> Column | None:
    """A double that never falls as the column rises (equal where it cannot
    tell values apart); None for types it has no such value for."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double") + F.lit(0.0)        # -0.0 equals 0.0
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.StringType):              # the first six bytes, in binary order
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    return None


def _sketched(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """(keys, n, finite, specials, sketch) of a value per key."""
    finite = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    parts = df.select(*keys, finite.alias("_f"), F.spark_partition_id().alias("_p")).groupBy(
        *keys, F.pmod("_p", F.lit(MERGE_WAYS)).alias("_way")).agg(
        F.count(F.lit(1)).alias("_n"), F.count("_f").alias("_m"), F.kll_sketch_agg_double("_f", F.lit(SKETCH_K)).alias("_s"))
    return parts.groupBy(*keys).agg(F.sum("_n").alias("n"), F.sum("_m").alias("finite"),
                                    F.kll_merge_agg_double(F.when(F.col("_m") > 0, F.col("_s"))).alias("sketch"))


def _boundaries(row, rows_per_slot: int) -> list[float]:
    """Boundaries of equal shares, with repeats, from a row of quantiles."""
    q = row["quantiles"]
    if not q:
        return []
    slots = min(len(q), math.ceil(row["finite"] / rows_per_slot))
    return [q[round(k * len(q) / slots)] for k in range(1, slots)]


def _quantiles(sketched: DataFrame, slots: int) -> DataFrame:
    shares = F.expr(f"array({', '.join(f'{k / slots}D' for k in range(slots))})")
    return sketched.withColumn("quantiles", F.when(F.col("finite") > 0, F.kll_sketch_get_quantile_double("sketch", shares))).drop("sketch")


def _edges(bounds: Sequence[float]) -> list[float]:
    """Edges of half-open ranges, of which each boundary has one to itself."""
    return sorted({float("-inf"), float("inf"), *bounds, *(math.nextafter(b, float("inf")) for b in bounds)})


def _place(value: Column, ranged: Column, descending: bool, nulls_last: bool) -> Column:
    """Slot number in scan order, with places for special values."""
    slot = F.when(F.isnan(value), F.lit(_TOP + 1)).when(value == float("inf"), F.lit(_TOP)).when(value == float("-inf"), F.lit(-1)) \
        .otherwise(ranged)
    slot = -slot if descending else slot
    return F.when(value.isNull(), F.lit(2 * _TOP if nulls_last else -2 * _TOP)).otherwise(slot).cast("int")


def _local(df: DataFrame, paths: Sequence[str], rows: Sequence[tuple], edges: str | None = None) -> DataFrame:
    """A few rows as a local table: (paths), with a list of edges behind.  Made from
    Arrow, its rows lie in the plan and no Python worker has to unpack them."""
    columns = list(zip(*rows))
    arrays = {c: pa.array(v, pa.int32()) for c, v in zip(paths, columns)}
    if edges:
        arrays[edges] = pa.array(columns[-1], pa.list_(pa.float64()))
    return df.sparkSession.createDataFrame(pa.table(arrays))


def _with_last_edge(df: DataFrame, edges: str, value: str, out: str, most: int) -> DataFrame:
    """df + the index of the last of at most ``most`` edges at or below a value, by
    bisection: one projection a halving, which Spark compiles, where a fold over the
    array would be interpreted row by row."""
    at, e = F.col(out), F.col(edges)
    df = df.withColumn(out, F.lit(0))       # -infinity is at or below all
    for k in reversed(range((most - 1).bit_length())):
        df = df.withColumn(out, F.when(F.get(e, at + (1 << k)) <= F.col(value), at + (1 << k)).otherwise(at))
    return df


class Slots:
    """Slots of a table for one order: ``apply`` adds ``paths``, one integer
    column per level that has been cut (the leading column, then tie-breaks).

    ``single`` is true of tables that fit one slot; ``of`` counts the rows
    unless a bound of them is given."""

    def __init__(self, lead: str, descending: bool, nulls_last: bool):
        self.lead, self.descending, self.nulls_last = lead, descending, nulls_last
        self.single = True
        self.edges: list[float] = []
        self.levels: list[tuple[str, DataFrame, int]] = []     # tie-break column, (prefix, edges) of hot slots, most edges

    @property
    def paths(self) -> list[str]:
        return [f"_s{k}" for k in range(len(self.levels) + 1)]

    @classmethod
    def of(cls, df: DataFrame, lead: str, ties: Sequence[str] = (), descending: bool = False, nulls_last: bool = True,
           rows: int | None = None, rows_per_slot: int | None = None) -> Slots:
        """``ties`` are names of ascending tie-break columns."""
        found = cls(lead, descending, nulls_last)
        rows_per_slot = rows_per_slot or ROWS_PER_SLOT
        n = df.count() if rows is None else rows
        if n <= rows_per_slot:
            return found
        found.single = False
        most = min(MAX_SLOTS, math.ceil(n / rows_per_slot))
        value = ascending_value(df, lead)
        value = F.lit(0.0) if value is None else value
        row = _quantiles(_sketched(df, [], value), most).first()
        if row is None:
            return found
        steps = _boundaries(row, rows_per_slot)
        found.edges = _edges(steps)
        sign = -1 if descending else 1
        hot = [sign * found.edges.index(b) for b in sorted(set(steps)) if steps.count(b) > 1]
        if row["n"] - row["finite"] > rows_per_slot:      # NULL, NaN and infinite values may be hot, too
            hot += [-sign, sign * _TOP, sign * (_TOP + 1), 2 * _TOP if nulls_last else -2 * _TOP]
        prefixes = [(h,) for h in hot]
        for tie in ties:
            v = ascending_value(df, tie)
            if v is None or not prefixes:
                break
            table = _local(df, found.paths, prefixes)
            slotted = found.apply(df).join(F.broadcast(table), found.paths)
            cut, deeper = [], []
            for r in _quantiles(_sketched(slotted, found.paths, v), most).toLocalIterator():
                steps = _boundaries(r, rows_per_slot)
                if steps:
                    edges = _edges(steps)
                    prefix = tuple(r[c] for c in found.paths)
                    cut.append((*prefix, edges))
                    deeper += [(*prefix, edges.index(b)) for b in sorted(set(steps)) if steps.count(b) > 1]
            if not cut:
                break
            found.levels.append((tie, _local(df, found.paths, cut, "_edges"), max(len(c[-1]) for c in cut)))
            prefixes = deeper
        return found

    def apply(self, df: DataFrame) -> DataFrame:
        """df + the slot columns."""
        value = ascending_value(df, self.lead)
        value = F.lit(0.0) if value is None else value
        out = df.withColumn("_v0", F.when(F.abs(value) < float("inf"), value).otherwise(F.lit(0.0)))
        ranged = F.lit(0)
        if len(self.edges) > 2:
            out = Bucketizer(splits=self.edges, inputCol="_v0", outputCol="_b0").transform(out)
            ranged = F.col("_b0").cast("int")
        out = out.withColumn("_s0", _place(value, ranged, self.descending, self.nulls_last)).drop("_v0", "_b0")
        for k, (tie, table, most) in enumerate(self.levels):
            out = out.join(F.broadcast(table), [f"_s{i}" for i in range(k + 1)], "left").withColumn("_tv", ascending_value(df, tie))
            out = _with_last_edge(out, "_edges", "_tv", "_te", most)
            place = _place(F.col("_tv"), F.col("_te"), False, False)      # ties rise, NULLs first
            out = out.withColumn(f"_s{k + 1}", F.when(F.col("_edges").isNotNull(), place).otherwise(F.lit(0))).drop("_edges", "_tv", "_te")
        return out.select(*[F.col(f"`{c}`") for c in df.columns], *self.paths)
