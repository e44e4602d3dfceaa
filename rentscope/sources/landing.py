"""Landing JSON pages -> bronze parquet.

A landing page is one JSON object ``{totalEntries, results: [listing...]}``
per file (or per line), stored under ``.../city=<name>/``.  Executors parse
files in parallel with an explicit schema; only a load's row count, the largest
catalog size and which fields occurred reach the driver, observed while the load
is staged.

A listing is a map from its keys, in page order, to typed JSON values (variants),
parsed once: whether a value is an object is a matter of its type, never of its
text.  A dotted column name is looked up along the objects to any depth.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.listings import BRONZE_COLUMNS
from ..session import materialize
from .bronze import read_loads, write_load


# A page as the portal returns it.  Cells reach bronze as text, so a badly typed or
# drifted one is kept as it came and staging's casts decide about it; numbers are
# written in plain form (50.0 as 50).
PAGE_SCHEMA = T.StructType([
    T.StructField("totalEntries", T.LongType()),
    T.StructField("results", T.ArrayType(T.MapType(T.StringType(), T.VariantType()))),
])

# Other spellings of a required field, tried in order where the field is absent or null.
FALLBACKS = {
    "MCIUDAD.NOMBRE": ["MCIUDAD"],
    "MZONA.NOMBRE": ["MZONA"],
    "MTIPOINMUEBLE.NOMBRE": ["MTIPOINMUEBLE"],
    "DATA.MVALORADMINISTRACION": ["MVALORADMINISTRACION"],
    "LOCALIZACION.LON": ["LON"],
    "LOCALIZACION.LAT": ["LAT"],
}


def read_pages(spark: SparkSession, path: str, multi_line: bool = False, schema=PAGE_SCHEMA,
               partition_col: str | None = "city") -> DataFrame:
    """Landing pages with an explicit schema (no inference pass).  A
    ``city=<name>`` folder level becomes the string column ``city``."""
    if partition_col:
        schema = T.StructType(schema.fields + [T.StructField(partition_col, T.StringType())])
    r = spark.read.schema(schema)
    if multi_line:
        r = r.option("multiLine", True)
    return r.json(path)


def listings(pages: DataFrame, keep=("city",)) -> DataFrame:
    """A1: one row per listing (``listing``, a map of its fields); pages with
    NULL or empty results add nothing."""
    keep = [k for k in keep if k in pages.columns]
    return pages.select(*keep, F.explode("results").alias("listing"))


def _object(value: Column) -> Column:
    """The fields of a JSON object; NULL for any other value."""
    return F.try_variant_get(value, "$", "map<string,variant>")


class _Fields(NamedTuple):
    """SQL of an object's keys as column names, in its order, of their values, and
    of the values' texts."""

    names: str
    values: str
    texts: str


_OBJECT = "try_variant_get({}, '$', 'map<string,variant>')"


def _quoted(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fields(of: str, underscore_to_dot: bool) -> _Fields:
    """A4: the fields of a map; an object among its values has no text."""
    name = "replace(upper(k), '_', '.')" if underscore_to_dot else "upper(k)"
    values = f"map_values({of})"
    written = f"transform({values}, v -> cast(v AS string))"
    text = f"CASE WHEN NOT startswith(w, '{{') OR {_OBJECT.format('v')} IS NULL THEN w END"
    return _Fields(f"transform(map_keys({of}), k -> {name})", values, f"zip_with({written}, {values}, (w, v) -> {text})")


def _place(fields: _Fields, name: str) -> str:
    return f"array_position({fields.names}, {_quoted(name)})"


def _inside(fields: _Fields, key: str) -> str:
    """The object under the first of a key; NULL where there is none."""
    return _OBJECT.format(f"get({fields.values}, cast({_place(fields, key)} - 1 AS int))")


def _lookup(fields: _Fields, name: str, dots: bool, opened: dict[str, _Fields] | None = None) -> tuple[str, str]:
    """A3, A6: (text, occurs) of the leaf with a dotted name: the first key that
    equals it, or the rest of the name in the object under the first key that
    equals its beginning.  ``opened`` holds the fields of objects that are looked
    into more than once."""
    parts = name.split(".")
    texts = [f"get({fields.texts}, cast({_place(fields, name)} - 1 AS int))"]
    occurs = [f"coalesce({_place(fields, name)} > 0, false)"]
    for k in range(1, len(parts)):
        head = ".".join(parts[:k])
        inner = opened[head] if opened else _fields(_inside(fields, head), dots)
        below, there = _lookup(inner, ".".join(parts[k:]), dots)
        texts.append(below)
        occurs.append(there)
    return f"coalesce({', '.join(texts)})", f"({' OR '.join(occurs)})"


def columns_of(listed: DataFrame, names=BRONZE_COLUMNS, underscore_to_dot: bool = False) -> DataFrame:
    """A3-A7: the named columns of listings as text, and ``_occurs``, which of
    them a listing has.  A5: other spellings fill a column that is absent or null.

    Keys and texts of a listing are made once, by projections of their own; a
    column is then a place in them.  The expressions are SQL text, since a tree of
    columns of this size takes longer to build than to run."""
    spellings = {c: (c, *FALLBACKS.get(c, [])) for c in names}
    heads = sorted({n.rsplit(".", k)[0] for f in spellings.values() for n in f for k in range(1, n.count(".") + 1)})
    top = _Fields("_names", "_values", "_texts")
    opened = {h: _Fields(f"_n{k}", f"_v{k}", f"_t{k}") for k, h in enumerate(heads)}
    named = listed.selectExpr(*[f"{x} AS {c}" for x, c in zip(_fields("listing", underscore_to_dot), top)])
    named = named.selectExpr(*top, *[f"{_inside(top, h)} AS _in{k}" for k, h in enumerate(heads)])
    named = named.selectExpr(*top, *[f"{x} AS {c}" for k, f in enumerate(opened.values())
                                     for x, c in zip(_fields(f"_in{k}", underscore_to_dot), f)])
    found = {c: [_lookup(top, s, underscore_to_dot, opened) for s in f] for c, f in spellings.items()}
    texts = [F.expr(f"coalesce({', '.join(t for t, _ in f)})").alias(c) for c, f in found.items()]
    occurs = [" OR ".join(o for _, o in f) for f in found.values()]
    return named.select(*texts, F.expr(f"array({', '.join(occurs)})").alias("_occurs"))


def leaves(listed: DataFrame, keys: Sequence[str], underscore_to_dot: bool = False) -> DataFrame:
    """A3, A4: (keys, name, value): every leaf of every listing, objects
    flattened to any depth.  Each round takes one level off the objects that
    are left, until none is."""
    def level(df: DataFrame, name: Column) -> DataFrame:
        return df.select(*keys, name.alias("name"), F.col("value"), _object(F.col("value")).alias("inner"))

    def named(c: Column) -> Column:
        name = F.upper(c)
        return F.replace(name, F.lit("_"), F.lit(".")) if underscore_to_dot else name

    now = level(listed.select(*keys, F.explode("listing").alias("key", "value")), named(F.col("key")))
    done = []
    while True:
        now = materialize(now.withColumn("value", F.when(F.col("inner").isNull(), F.col("value").cast("string")))
                          .withColumn("inner", F.to_json(F.to_variant_object("inner"))), "leaves")
        done.append(now.where("inner is null").select(*keys, "name", "value"))
        deeper = now.where("inner is not null")
        if deeper.isEmpty():
            return reduce(lambda a, b: a.union(b), done)
        parsed = deeper.select(*keys, F.col("name").alias("prefix"), F.explode(_object(F.parse_json("inner"))).alias("key", "value"))
        now = level(parsed, F.concat("prefix", F.lit("."), named(F.col("key"))))


def catalog_summary(pages: DataFrame) -> DataFrame:
    """A2: reported catalog size per city (missing -> 0) next to what the
    pages actually held."""
    return pages.groupBy("city").agg(
        F.max(F.coalesce(F.col("totalEntries"), F.lit(0))).alias("total_entries"),
        F.sum(F.coalesce(F.size("results"), F.lit(0))).cast("bigint").alias("listings_seen"),
        F.count(F.lit(1)).alias("pages"))


def require_catalog(summary: DataFrame) -> DataFrame:
    """A2: the summary itself; raises if the reported sizes add up to 0."""
    if not summary.agg(F.sum("total_entries")).first()[0]:
        raise ValueError("the catalogs report no listings")
    return summary


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """A3: struct fields become top-level columns named ``parent.child`` at
    any depth (arrays are left as they are)."""
    cols: list[Column] = []

    def walk(dt: T.DataType, path: list[str]):
        if isinstance(dt, T.StructType) and path:
            for f in dt.fields:
                walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))

    for f in df.schema.fields:
        walk(f.dataType, [f.name])
    return df.select(*cols)


def normalize_names(df: DataFrame, underscore_to_dot: bool = False) -> DataFrame:
    """A4: upper-case names; optionally ``_`` -> ``.``."""
    names = [c.upper() for c in df.columns]
    if underscore_to_dot:
        names = [n.replace("_", ".") for n in names]
    return df.toDF(*names)


def first_of_duplicates(df: DataFrame) -> DataFrame:
    """A6: keep the first column of each repeated name."""
    tmp = [f"_c{i}" for i in range(len(df.columns))]
    seen, keep = set(), []
    for t, n in zip(tmp, df.columns):
        if n not in seen:
            seen.add(n)
            keep.append(F.col(t).alias(n))
    return df.toDF(*tmp).select(*keep)


def coalesce_fields(df: DataFrame, target: str, *alternatives: str) -> DataFrame:
    """A5: fill ``target`` from the first alternative spelling present.

    Spark resolves names case-insensitively, so spellings that differ only in
    case would be ambiguous by name: columns are matched and read by
    position instead; the merged column takes the place of the first one."""
    wanted = [n.lower() for n in (target, *alternatives)]
    hits = sorted((wanted.index(c.lower()), i) for i, c in enumerate(df.columns) if c.lower() in wanted)
    if not hits:
        return df
    tmp = [f"_c{i}" for i in range(len(df.columns))]
    t = df.toDF(*tmp)
    merged = F.coalesce(*[F.col(tmp[i]) for _, i in hits]).alias(target)
    first = min(i for _, i in hits)
    used = {i for _, i in hits}
    cols = []
    for i, name in enumerate(df.columns):
        if i == first:
            cols.append(merged)
        elif i not in used:
            cols.append(F.col(tmp[i]).alias(name))
    return t.select(*cols)


def enforce_columns(df: DataFrame, required=BRONZE_COLUMNS) -> DataFrame:
    """A7: raise on missing required columns; drop extras; fix the order."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in required])


def with_audit(df: DataFrame, loaded_at: _dt.datetime | Column, load_type: str) -> DataFrame:
    """A8: one load timestamp for every row of a load, and the load type."""
    ts = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return df.withColumns({"UPLOADED_DATE": ts.cast("timestamp_ntz"), "LOAD_TYPE": F.lit(load_type)})


def to_bronze(pages: DataFrame, loaded_at, load_type: str) -> DataFrame:
    """A1, A3-A8 in one projection chain (streaming-safe: no actions): the
    required columns as text, the load instant and the load type."""
    rows = columns_of(listings(pages, keep=()), underscore_to_dot=load_type == "FULL")
    return with_audit(rows.drop("_occurs"), loaded_at, load_type)


def load(spark: SparkSession, pages: DataFrame, bronze_path: str, load_id: str, load_type: str,
         loaded_at: _dt.datetime | Column) -> int:
    """A7-A9: one load, staged, checked, then published (see ``sources.bronze``);
    returns its rows.

    The landing is parsed once: the staging write observes which required
    fields occurred and the largest reported catalog size (A2).  A load that
    lacks a field, or whose catalogs report no entries at all, raises and leaves
    an earlier load of its id as it was.  Writing the same load again replaces
    it, so a replay leaves one copy."""
    seen, catalogs = Observation(), Observation()
    pages = pages.observe(catalogs, F.max("totalEntries").alias("most"))
    rows = columns_of(listings(pages, keep=()), underscore_to_dot=load_type == "FULL")
    rows = rows.observe(seen, *[F.max(F.get("_occurs", F.lit(k)).cast("int")).alias(f"p{k}") for k in range(len(BRONZE_COLUMNS))])
    out = with_audit(rows.drop("_occurs"), loaded_at, load_type).drop("LOAD_TYPE").withColumn("LOAD_DATE", F.to_date("UPLOADED_DATE"))

    def check(n: int) -> None:
        if catalogs.get["most"] == 0:
            raise ValueError("the catalogs report no listings")
        got = seen.get
        missing = [c for k, c in enumerate(BRONZE_COLUMNS) if n and not got[f"p{k}"]]
        if missing:
            raise ValueError(f"missing required columns: {missing}")

    return write_load(out, bronze_path, load_type, load_id, check)


def full_load(spark: SparkSession, landing: str, bronze_path: str, loaded_at: _dt.datetime | None = None,
              multi_line: bool = False, load_id: str | None = None) -> DataFrame:
    """A10: every page of every city -> bronze (batch)."""
    loaded_at = loaded_at or _dt.datetime.now().replace(microsecond=0)
    load_id = load_id or f"full-{_dt.datetime.now():%Y%m%dT%H%M%S%f}"
    if not load(spark, read_pages(spark, landing, multi_line), bronze_path, load_id, "FULL", loaded_at):
        raise ValueError("no listings extracted")
    return read_loads(spark, bronze_path)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A15: the official-name seed (CSV with header)."""
    return spark.read.option("header", True).schema(
        "city_name string, neighborhood_official_name string").csv(path)
