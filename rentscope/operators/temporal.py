"""Joins along time, without theta joins.

* ``as_of_join``: the latest right row at or before each left row of its key.
  Both sides become one table ordered by (key, time); a right row's columns are
  carried forward to the left rows behind it, through slots, so a key that
  holds a third of all rows is worked on by many tasks.
* ``interval_join``: all right intervals that hold a left row's time.  An
  interval lies in at most two cells of a grid whose width is the power of two
  at or above its length; a point lies in one cell of each width that occurs.
  The join is an equality on (key, width, cell), so a hot key is spread over its
  cells, long and short intervals do not disturb each other, and a candidate is
  at most a cell away from a match.
* ``changes``: the history of a value as periods during which it held.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, carry: Sequence[str], right_time: str | None = None,
               max_age_seconds: float | None = None, ties: Sequence[str] = (), rows: int | None = None,
               rows_per_slot: int | None = None) -> DataFrame:
    """left + ``carry`` columns and ``<time>_as_of`` of the right row valid at
    its time; NULL where there is none or it is older than ``max_age_seconds``.

    Right rows of equal key and time are told apart by ``ties``, the last one
    counts.  Rows with a NULL time or key have no valid row."""
    right_time = right_time or time
    keys = list(keys)
    fields = [F.col(f"`{right_time}`").alias("_at"), *[F.col(f"`{c}`") for c in carry]]
    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    known = right.where(" and ".join(f"`{c}` is not null" for c in [*keys, right_time]))
    order = F.struct(*[F.col(f"`{c}`") for c in ties]) if ties else F.struct(F.lit(0).alias("none"))
    # one valid row per key and time, so that rights come before lefts of that time
    valid = known.groupBy(*keys, F.col(f"`{right_time}`").alias("_time")).agg(F.max_by(F.struct(*fields), order).alias("_valid")) \
        .select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_time", F.lit(0).alias("_side"), "_valid")
    asked = left.select(*[F.col(f"`{k}`").alias(f"_key_{k}") for k in keys], F.col(f"`{time}`").alias("_time"),
                        F.lit(1).alias("_side"), whole.alias("_row"))
    both = asked.unionByName(valid, allowMissingColumns=True)
    found = ordered.carry_forward(both, [f"_key_{k}" for k in keys], "_time", ["_side"], "_valid", "_found", rows=rows,
                                  rows_per_slot=rows_per_slot).where("_side = 1")
    ok = F.col("_time").isNotNull()
    if max_age_seconds is not None:
        age = F.unix_micros(F.col("_time").cast("timestamp")) - F.unix_micros(F.col("_found._at").cast("timestamp"))
        ok = ok & (age <= int(max_age_seconds * 1_000_000))
    return found.select("_row.*", F.when(ok, F.col("_found._at")).alias(f"{time}_as_of"),
                        *[F.when(ok, F.col(f"_found.`{c}`")).alias(c) for c in carry])


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str, start: str, end: str,
                  carry: Sequence[str], how: str = "inner") -> DataFrame:
    """points + (start, end, carry) of every interval of its key with
    start <= time < end; ``how="left"`` keeps points without one.

    Empty and reversed intervals, and NULL keys or ends, hold no point."""
    keys = list(keys)
    first, behind = _micros(F.col(f"`{start}`")), _micros(F.col(f"`{end}`"))
    level = F.ceil(F.log2((F.col("_to") - F.col("_from")).cast("double"))).cast("int")
    spans = intervals.select(*[F.col(f"`{k}`").alias(f"_key_{k}") for k in keys], first.alias("_from"), behind.alias("_to"),
                             F.struct(F.col(f"`{start}`"), F.col(f"`{end}`"), *[F.col(f"`{c}`") for c in carry]).alias("_span")) \
        .where("_from < _to").withColumn("_level", level)
    widths = [r["_level"] for r in spans.select("_level").distinct().collect()]      # at most 64 powers of two

    def cell(micros: Column, at: Column) -> Column:
        return F.floor(micros / F.pow(F.lit(2.0), at)).cast("bigint")

    gridded = spans.withColumn("_cell", F.explode(F.array_distinct(F.array(
        cell(F.col("_from"), F.col("_level")), cell(F.col("_to") - 1, F.col("_level"))))))
    points = points.withColumn("_point", F.monotonically_increasing_id()) if how == "left" else points
    at = _micros(F.col(f"`{time}`"))
    spread = points.withColumn("_t", at).withColumn("_level", F.explode(F.lit(widths).cast("array<int>"))) \
        .withColumn("_cell", cell(F.col("_t"), F.col("_level")))
    same = [F.col(f"`{k}`") == F.col(f"_key_{k}") for k in keys]
    joined = spread.withColumnRenamed("_level", "_plevel").withColumnRenamed("_cell", "_pcell").join(
        gridded, [*same, F.col("_plevel") == F.col("_level"), F.col("_pcell") == F.col("_cell")])
    hits = joined.where("_t >= _from and _t < _to")
    columns = [c for c in points.columns if c != "_point"]
    out = [start, end, *carry]
    if how == "inner":
        return hits.select(*[F.col(f"`{c}`") for c in columns], "_span.*")
    found = hits.select(F.col("_point").alias("_hit"), "_span")
    return points.join(found, F.col("_point") == F.col("_hit"), "left").select(
        *[F.col(f"`{c}`") for c in columns], *[F.col(f"_span.`{c}`").alias(c) for c in out])


def changes(df: DataFrame, by, time: str, value: str, ties: Sequence[str] = (), rows: int | None = None,
            rows_per_slot: int | None = None) -> DataFrame:
    """(by, value, valid_from, valid_to, previous): periods during which the
    value held, from sightings; ``valid_to`` is NULL while it still holds.

    A sighting opens a period if its value differs from the sighting before
    (NULL is a value); the next opening closes it."""
    by = [by] if isinstance(by, str) else list(by)
    seen = df.select(*by, time, value, *[t for t in ties if t not in (*by, time, value)]).withColumn("_any", F.lit(1))
    with_before = ordered.neighbours(seen, by, time, ties, {"previous": value, "_older": "_any"}, rows=rows, rows_per_slot=rows_per_slot)
    opened = with_before.where(F.col("_older").isNull() | ~F.col(value).eqNullSafe(F.col("previous"))).drop("_any", "_older")
    closed = ordered.neighbours(opened, by, time, ties, following={"valid_to": time}, rows=rows, rows_per_slot=rows_per_slot)
    return closed.select(*by, value, F.col(time).alias("valid_from"), "valid_to", "previous")
