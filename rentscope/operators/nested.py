"""Operators over nested records: arrays of (item, qty) structs and maps of
category -> array.  Row-wise work uses higher-order functions (no Python);
grouped work explodes first so the aggregate is partial and shuffles only
(group, partial sum) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import folds


def record_sum(df: DataFrame, items: str, qty_field: str, out: str = "total",
               min_total: float | None = None) -> DataFrame:
    """Per record: sum of the quantities in its item list; optional filter
    on that sum (strictly greater than ``min_total``)."""
    total = F.aggregate(F.col(items), F.lit(0.0).cast("double"),
                        lambda acc, x: acc + x[qty_field].cast("double"))
    out_df = df.withColumn(out, total)
    if min_total is not None:
        out_df = out_df.filter(F.col(out) > min_total)
    return out_df


def explode_items(df: DataFrame, keys, items: str, name_field: str, qty_field: str) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.select(*keys, F.explode(items).alias("_it"))
              .select(*keys, F.col(f"_it.{name_field}").alias("item"),
                      F.col(f"_it.{qty_field}").alias("qty")))


def category_mean(df: DataFrame, category: str, items: str, name_field: str, qty_field: str,
                  out: str = "mean_qty") -> DataFrame:
    """Mean quantity over all items of all records of a category."""
    ex = explode_items(df, category, items, name_field, qty_field)
    return ex.groupBy(category).agg(F.avg("qty").alias(out))


def category_sum_having(df: DataFrame, category: str, items: str, name_field: str, qty_field: str,
                        min_total: float, out: str = "total") -> DataFrame:
    """Upper-cased category -> summed quantity, kept when >= min_total."""
    ex = explode_items(df, category, items, name_field, qty_field)
    return (ex.groupBy(F.upper(F.col(category)).alias(category))
              .agg(F.sum("qty").alias(out))
              .filter(F.col(out) >= min_total))


def two_level_totals_long(df: DataFrame, outer: str, inner: str, items: str, name_field: str,
                          qty_field: str, min_total: float) -> DataFrame:
    """(outer, inner, total) with inner totals >= min_total.  An outer key
    whose inner totals all fail simply has no rows, which is the "drop
    emptied outers" rule.  ``inner`` is a record column (a subcategory) or,
    when the record has no such column, the item name.  Nothing is collected
    per key: a partially aggregated groupBy over exploded items."""
    record_level = inner in df.columns
    keys = [outer, inner] if record_level else [outer]
    ex = explode_items(df, keys, items, name_field, qty_field)
    if not record_level:
        ex = ex.withColumnRenamed("item", inner)
    return (ex.groupBy(outer, inner).agg(F.sum("qty").alias("total"))
              .filter(F.col("total") >= min_total))


def two_level_totals(df: DataFrame, outer: str, inner: str, items: str, name_field: str,
                     qty_field: str, min_total: float, entries: int = folds.ENTRIES) -> DataFrame:
    """outer -> map(inner -> total): the long form folded into maps of a bounded
    size, (outer, part, parts, totals); a key of more inner keys has several
    rows (see ``operators.folds``)."""
    sums = two_level_totals_long(df, outer, inner, items, name_field, qty_field, min_total)
    return folds.maps(sums, [outer], inner, "total", entries=entries)


def map_of_lists_totals(df: DataFrame, key: str, cat_map: str, name_field: str, qty_field: str) -> DataFrame:
    """(key, map<category, array<item>>) records -> (key, category, total)."""
    cats = df.select(key, F.explode(cat_map).alias("category", "_items"))
    items = cats.select(key, "category", F.explode("_items").alias("_it"))
    return (items.groupBy(key, "category")
                 .agg(F.sum(F.col(f"_it.{qty_field}")).alias("total")))


def map_totals(df: DataFrame, key: str, cat_map: str, name_field: str, qty_field: str, entries: int = folds.ENTRIES) -> DataFrame:
    """Same totals folded into maps of a bounded size per key: (key, part, parts, totals)."""
    t = map_of_lists_totals(df, key, cat_map, name_field, qty_field)
    return folds.maps(t, [key], "category", "total", entries=entries)
