"""S2: keep the silver snapshot current as new bronze arrives.

A mergeable per-property *state* (latest sighting, first and last sighting;
``plans.listings.snapshot_state``) is stored in hash buckets of
``property_id``.  Each batch of new bronze rows is reduced to a state of its own
(partial aggregation), the stored state is read only for the buckets the batch
touches, the two are merged with the same max_by / min / max, and only those
buckets are written.  The work per batch is the batch plus the touched buckets'
state -- never the whole bronze history.

The stored state is versioned.  A merge writes its buckets into a folder of its
own and then publishes a manifest (bucket -> folder, bucket count, the batch)
under the next free number by one rename; readers use the manifest with the
highest number.  A merge that breaks off halfway leaves the published state as
it was, and running it again replaces its folder.  A batch whose id the manifest
already has is skipped.

The bucket count comes from the number of properties (``ROWS_PER_BUCKET``) and
is stored in the manifest; when the state has outgrown it fourfold, the next
merge writes all buckets anew with a larger count.

Beside the buckets the state keeps *sketches* of all sightings per city and
month (``operators.cubes``: counts, extremes, a KLL sketch of the rents, an HLL
sketch of the properties).  They merge, so a batch adds its own to those of the
months it touches; distinct counts and medians over any cities and months
are read from them without the history.

Late files need no watermark: the newest ``extracted_at`` wins and first/last
sightings do not depend on arrival order.  Silver is ``lifecycle(state,
as_of)``: a projection computed on read.
"""

from __future__ import annotations

import json
import math
import zlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cubes
from ..plans.listings import BRONZE_COLUMNS, NON_RESIDENTIAL_TYPES, lifecycle, merge_states, snapshot_state, staging
from ..session import drop_path, list_names, publish_text, read_text, scratch_path
from ..sources.bronze import ENTRY, LOG, as_text, current_loads, log_entries, read_entries, with_columns

ROWS_PER_BUCKET = 500_000
SKETCHED_BY = ["city_name", "month"]


def bucket_of(c, n: int):
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")


def manifest(spark: SparkSession, state_path: str) -> dict | None:
    """The published state: number, n_buckets, rows, batch, buckets {bucket: folder}."""
    names = [n for n in list_names(spark, state_path) if n.startswith("manifest-")]
    return json.loads(read_text(spark, f"{state_path}/{names[-1]}")) if names else None


def read_state(spark: SparkSession, state_path: str, found: dict, buckets=None) -> DataFrame | None:
    """The stored rows of some buckets (or all); None if they hold none."""
    chosen = [f"{state_path}/{f}/bucket={b}" for b, f in found["buckets"].items()
              if buckets is None or int(b) in buckets]
    return spark.read.parquet(*chosen) if chosen else None


def merge_batch(spark: SparkSession, bronze_rows: DataFrame, state_path: str, batch_id: str,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Fold a batch of bronze rows into the stored state; a repeated batch id changes nothing."""
    state_path = state_path.rstrip("/")
    now = manifest(spark, state_path)
    if now and batch_id in now["batches"]:
        return
    stg = staging(as_text(bronze_rows))
    staged = scratch_path(spark, "batch-state")  # read twice below: buckets, rows
    folded, merged_rows, old_rows = Observation(), Observation(), Observation()
    n = F.count(F.lit(1)).alias("n")
    snapshot_state(stg).observe(folded, n).write.parquet(staged)
    new = spark.read.parquet(staged)
    n_new = folded.get["n"]
    if not n_new:
        return
    n_buckets = now["n_buckets"] if now else max(1, math.ceil(n_new / rows_per_bucket))
    wide = now is not None and now["rows"] > 4 * n_buckets * rows_per_bucket
    if wide:
        n_buckets = math.ceil(now["rows"] / rows_per_bucket)
    # the touched bucket ids: at most n_buckets small ints
    touched = None if wide else {r.b for r in new.select(bucket_of(F.col("property_id"), n_buckets).alias("b"))
                                 .distinct().collect()}
    old = read_state(spark, state_path, now, touched) if now else None
    if old is not None:
        old = old.select(*new.columns).observe(old_rows, n)
    merged = merge_states(new if old is None else new.unionByName(old)).observe(merged_rows, n)
    folder = f"data/{zlib.crc32(batch_id.encode()):08x}-{(now or {'number': 0})['number'] + 1:09d}"
    merged.withColumn("bucket", bucket_of(F.col("property_id"), n_buckets)).repartition("bucket") \
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket") \
        .parquet(f"{state_path}/{folder}")
    written = [int(n.split("=", 1)[1]) for n in list_names(spark, f"{state_path}/{folder}") if n.startswith("bucket=")]
    buckets = {} if wide or not now else dict(now["buckets"])
    buckets.update({str(b): folder for b in written})
    number = (now["number"] if now else 0) + 1
    known = {"number": number, "n_buckets": n_buckets, "buckets": buckets,
             "sketches": _merge_sketches(spark, stg, state_path, folder.replace("data/", "data/s-"), (now or {}).get("sketches", {})),
             "batches": [*(now["batches"] if now else []), batch_id][-1000:],
             "previous": sorted({*now["buckets"].values(), *now.get("sketches", {}).values()}) if now else []}
    replaced = old_rows.get["n"] if old is not None else 0
    known["rows"] = (now["rows"] if now else 0) - replaced + merged_rows.get["n"]
    publish_text(spark, f"{state_path}/manifest-{number:09d}.json", json.dumps(known))
    drop_path(spark, staged)
    _clean(spark, state_path, known)


def _merge_sketches(spark: SparkSession, stg: DataFrame, state_path: str, folder: str, stored: dict[str, str]) -> dict[str, str]:
    """Adds a batch's sketches to the stored ones; returns month -> folder."""
    month = F.coalesce(F.date_format("extracted_at", "yyyy-MM"), F.lit("none"))
    staged = scratch_path(spark, "batch-sketches")
    cubes.states(stg.withColumn("month", month), SKETCHED_BY, F.col("rent_value"), F.col("property_id")).write.parquet(staged)
    new = spark.read.parquet(staged)
    touched = sorted(r["month"] for r in new.select("month").distinct().collect())
    old = sorted({f"{state_path}/{stored[m]}/of={m}" for m in touched if m in stored})
    both = new.unionByName(spark.read.parquet(*old)) if old else new
    both.groupBy(*SKETCHED_BY).agg(*cubes.merged()).withColumn("of", F.col("month")).repartition("of").write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy("of").parquet(f"{state_path}/{folder}")
    drop_path(spark, staged)
    return stored | dict.fromkeys(touched, folder)


def read_sketches(spark: SparkSession, state_path: str, by=("city_name", "month"), months=None) -> DataFrame:
    """Measures of all sightings (``cubes.measures``) by any of city and month,
    for some months or all: the stored states, merged."""
    root = state_path.rstrip("/")
    found = manifest(spark, root)
    if found is None:
        raise ValueError(f"no state in {state_path}")
    folders = [f"{root}/{f}/of={m}" for m, f in sorted(found["sketches"].items()) if months is None or m in months]
    if not folders:
        raise ValueError(f"no such months in {state_path}")
    return cubes.measures(spark.read.parquet(*folders).groupBy(*by).agg(*cubes.merged()))


def _clean(spark: SparkSession, state_path: str, known: dict) -> None:
    """Folders that neither this state nor the one before refers to."""
    live = {*known["buckets"].values(), *known["sketches"].values(), *known["previous"]}
    for name in list_names(spark, f"{state_path}/data"):
        if f"data/{name}" not in live:
            drop_path(spark, f"{state_path}/data/{name}")


def read_silver(spark: SparkSession, state_path: str, as_of=None, non_residential=NON_RESIDENTIAL_TYPES) -> DataFrame:
    found = manifest(spark, state_path)
    if found is None:
        raise ValueError(f"no state in {state_path}")
    return lifecycle(read_state(spark, state_path.rstrip("/"), found), as_of, non_residential)


def refresh_from_stream(spark: SparkSession, bronze_path: str, state_path: str, checkpoint: str,
                        rows_per_bucket: int = ROWS_PER_BUCKET, loads_per_trigger: int | None = None) -> StreamingQuery:
    """Stream the log of bronze loads; fold every micro-batch's loads into the state.

    The stream's rows are log entries, one per published load, so a batch reads
    its loads by the schemas recorded with them: loads whose types or columns
    drifted pass like any other.  An entry whose load has been written again
    since is left to the newer entry."""
    stream = f"{zlib.crc32(checkpoint.encode()):08x}"

    def per_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        live = {e["number"] for e in current_loads(log_entries(session, bronze_path))}
        entries = sorted((r.asDict() for r in batch.collect()), key=lambda e: e["number"])  # a row per load
        entries = [e for e in entries if e["number"] in live]
        if entries:
            rows = with_columns(read_entries(session, entries, bronze_path), BRONZE_COLUMNS)
            merge_batch(session, rows, state_path, f"{stream}-{epoch}", rows_per_bucket)

    reader = spark.readStream.schema(ENTRY)
    if loads_per_trigger:
        reader = reader.option("maxFilesPerTrigger", loads_per_trigger)
    return (reader.json(f"{bronze_path.rstrip('/')}/{LOG}")
            .writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
