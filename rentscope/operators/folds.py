"""Folds of long rows into maps and lists of a bounded size.

A collected map or list holds the whole domain of its key, and one key may hold
a third of all rows.  Here a key's entries are dealt by hash into as many parts
as its count needs, so that a part holds about ``entries`` of them: a small key
keeps one row, a large one becomes several, and no task ever holds more than a
part.  The long rows remain the form to compute with; a fold is a view for
readers that want maps, and ``whole`` the same for keys that are known to fit one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTRIES = 100_000


def dealt(long: DataFrame, keys: Sequence[str], item: str, entries: int = ENTRIES) -> DataFrame:
    """long + ``part`` and ``parts`` (per key; 0 and 1 for a key that fits one part)."""
    sizes = long.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / entries).cast("int").alias("parts"))
    other = sizes.select(*[F.col(k).alias(f"_o_{k}") for k in keys], "parts")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys])
    joined = long.join(other, same).drop(*[f"_o_{k}" for k in keys])
    return joined.withColumn("part", F.pmod(F.xxhash64(item), F.col("parts")).cast("int"))


def _folded(long: DataFrame, keys: Sequence[str], item: str, entries: int, fold: Column) -> DataFrame:
    return dealt(long, keys, item, entries).groupBy(*keys, "part", "parts").agg(fold)


def maps(long: DataFrame, keys: Sequence[str], item: str, value: str, out: str = "totals", entries: int = ENTRIES) -> DataFrame:
    """(keys, part, parts, out): maps item -> value in item order, of about ``entries`` entries at most.

    Items are unique per key; rows with a NULL item cannot be in a map and are left out."""
    pairs = F.array_sort(F.collect_list(F.struct(item, value)))
    return _folded(long.where(F.col(item).isNotNull()), keys, item, entries, F.map_from_entries(pairs).alias(out))


def lists(long: DataFrame, keys: Sequence[str], item: str, out: str = "items", entries: int = ENTRIES) -> DataFrame:
    """(keys, part, parts, out): sorted lists of items, of about ``entries`` at most."""
    return _folded(long.where(F.col(item).isNotNull()), keys, item, entries, F.sort_array(F.collect_list(item)).alias(out))


def whole(folded: DataFrame) -> DataFrame:
    """One row per key, without part numbers; fails at run time on a key that has several parts."""
    one = F.when(F.col("parts") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("a key has more entries than one row may hold")).cast("boolean"))
    return folded.where(one).drop("part", "parts")
