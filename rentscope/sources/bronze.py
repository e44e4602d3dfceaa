"""Bronze loads: committed through a log, read back across type drift (A9, A12).

A load is written to a hidden staging folder, checked there, moved to a folder
of its own (``LOAD_TYPE=/LOAD_ID=/LOAD_DATE=``) and then published: a log entry
under the next free number, by one rename.  The entry is the commit.  Readers,
batch and stream, follow the log, so none sees a load before its checks ended,
a load that fails them leaves the one before it as it was, and a load written
again replaces its folder only after the new one is published.

The entry holds the load's schema.  A read groups the loads by schema, casts
each group to text and unions them by name (missing columns become NULL); no
footer is opened for it, whatever the number of loads.  Staging then types the
text once, with the rules of ``functions.clean``.  A folder without a log (loads
written by other means) is read by its listing and footers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.listings import AUDIT_COLUMNS
from ..session import drop_path, list_names, path_exists, publish_text, rename_path

LOG = "_log"
STAGING = "_staging"
ENTRY = "number bigint, load_type string, load_id string, folder string, rows bigint, schema string"
VERSION = "\\.v[0-9]+$"      # behind the id of a load that was written again
LOAD_COLUMNS = [*AUDIT_COLUMNS, "LOAD_ID", "LOAD_DATE"]


def as_text(df: DataFrame, keep=tuple(LOAD_COLUMNS)) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") if c in keep else F.col(f"`{c}`").cast("string").alias(c)
                       for c in df.columns])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [as_text(f) for f in frames])


def load_folders(spark: SparkSession, path: str, load_types=None) -> list[str]:
    """Folders of the loads, by type and id."""
    root = path.rstrip("/")
    types = [t for t in list_names(spark, root) if t.startswith("LOAD_TYPE=")
             and (not load_types or t.split("=", 1)[1] in load_types)]
    return [f"{root}/{t}/{i}" for t in types for i in list_names(spark, f"{root}/{t}") if i.startswith("LOAD_ID=")]


def read_versions(spark: SparkSession, folders: list[str], base: str) -> DataFrame:
    """The given loads, one read per schema version among them."""
    versions: dict[str, tuple[T.StructType, list[str]]] = {}
    for folder in folders:
        schema = spark.read.parquet(folder).schema
        versions.setdefault(json.dumps(schema.jsonValue(), sort_keys=True), (schema, []))[1].append(folder)
    frames = []
    for schema, paths in versions.values():
        full = T.StructType([*schema.fields, T.StructField("LOAD_TYPE", T.StringType()),
                             T.StructField("LOAD_ID", T.StringType())])
        frames.append(spark.read.schema(full).option("basePath", base).parquet(*paths))
    return union_by_name(frames)


def with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """df, with NULL text for the columns that none of its loads has."""
    return df.withColumns({c: F.lit(None).cast("string") for c in names if c not in df.columns})


# ---- the log ----------------------------------------------------------------

def log_entries(spark: SparkSession, path: str) -> list[dict]:
    """All entries in order, in one job."""
    log = f"{path.rstrip('/')}/{LOG}"
    if not path_exists(spark, log):
        return []
    return sorted((r.asDict() for r in spark.read.schema(ENTRY).json(log).collect()), key=lambda e: e["number"])


def current_loads(entries: list[dict]) -> list[dict]:
    """The last entry of every load."""
    last = {(e["load_type"], e["load_id"]): e for e in entries}
    return sorted(last.values(), key=lambda e: e["number"])


def write_load(df: DataFrame, path: str, load_type: str, load_id: str, check: Callable[[int], None] | None = None) -> int:
    """A9: one load of any column types, with a ``LOAD_DATE`` column; returns its rows.

    ``check`` gets the number of rows once they are staged; if it raises, the
    staged rows go and nothing else has changed.  A load without rows is not
    published.  A load id written before is replaced."""
    spark, root = df.sparkSession, path.rstrip("/")
    staged = f"{root}/{STAGING}/{load_id}-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy("LOAD_DATE").parquet(staged)
        n = seen.get["n"]
        if check:
            check(n)
    except BaseException:
        drop_path(spark, staged)
        raise
    if not n:
        drop_path(spark, staged)
        return 0
    while True:
        entries = log_entries(spark, root)
        number = entries[-1]["number"] + 1 if entries else 1
        folder = f"LOAD_TYPE={load_type}/LOAD_ID={load_id}"
        if path_exists(spark, f"{root}/{folder}"):
            folder += f".v{number}"
        rename_path(spark, staged, f"{root}/{folder}")
        entry = {"number": number, "load_type": load_type, "load_id": load_id, "folder": folder, "rows": n,
                 "schema": df.schema.json()}
        try:
            publish_text(spark, f"{root}/{LOG}/{number:012d}.json", json.dumps(entry))
            break
        except FileExistsError:      # another load took the number
            rename_path(spark, f"{root}/{folder}", staged)
    for e in entries:
        if (e["load_type"], e["load_id"]) == (load_type, load_id):
            drop_path(spark, f"{root}/{e['folder']}")
    return n


def read_entries(spark: SparkSession, entries: list[dict], path: str) -> DataFrame:
    """The given loads, one read per schema among them, without a look at their files' footers."""
    root = path.rstrip("/")
    versions: dict[str, list[str]] = {}
    for e in entries:
        versions.setdefault(e["schema"], []).append(f"{root}/{e['folder']}")
    frames = []
    for schema, folders in versions.items():
        full = T.StructType([*T.StructType.fromJson(json.loads(schema)).fields, T.StructField("LOAD_TYPE", T.StringType()),
                             T.StructField("LOAD_ID", T.StringType())])
        frames.append(spark.read.schema(full).option("basePath", root).parquet(*folders))
    found = union_by_name(frames)
    return found.withColumn("LOAD_ID", F.regexp_replace("LOAD_ID", VERSION, ""))


def read_loads(spark: SparkSession, path: str, load_types=None, since=None, until=None) -> DataFrame:
    """Bronze rows of selected loads, unioned by name as text.  The load type
    selects folders; LOAD_DATE filters prune partitions before any file is opened."""
    entries = current_loads(log_entries(spark, path))
    if entries:
        chosen = [e for e in entries if not load_types or e["load_type"] in load_types]
        if not chosen:
            raise ValueError(f"no loads in {path}")
        df = read_entries(spark, chosen, path)
    else:
        folders = load_folders(spark, path, load_types)
        if not folders:
            raise ValueError(f"no loads in {path}")
        df = read_versions(spark, folders, path)
    if since is not None:
        df = df.where(F.col("LOAD_DATE") >= F.lit(since).cast("date"))
    if until is not None:
        df = df.where(F.col("LOAD_DATE") < F.lit(until).cast("date"))
    return df
