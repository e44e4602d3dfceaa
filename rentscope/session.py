"""Session construction and shared-storage helpers.

Jobs never assume a machine-local scratch folder: lineage cuts go to the
shared folder named by ``spark.checkpoint.dir``.  Only when that setting is
absent (unit tests, local runs) do we pick a folder ourselves.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins at runtime (broadcast when
# a side is measured small, skew-split otherwise) and coalesces small
# shuffle partitions; UTC keeps timestamp text identical across engines.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce to the advisory size rather than keeping one task per core
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "rentscope",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOT: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts; read from the session first."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        # Only local runs may fall back to a folder of this machine: on a
        # cluster every executor would write to its own disk.
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        # One folder per application, remembered here because core settings
        # may not be changeable at runtime.
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOT.setdefault(app, tempfile.mkdtemp(prefix="rentscope-ckpt-"))
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - a read-only core setting
            pass
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root


_CREATED: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder.  Paths handed out
    here are removed when this process exits (they are only read by jobs of
    this process: materialized models, scan outputs, staged merges)."""
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _CREATED.append((spark, path))
    return path


def _remove_scratch() -> None:
    for spark, path in reversed(_CREATED):
        try:
            if spark.sparkContext._jsc is not None:
                drop_path(spark, path)
                continue
        except Exception:  # noqa: BLE001 - the JVM may already be gone at exit
            pass
        shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)


atexit.register(_remove_scratch)


def materialize(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` to the shared folder and read it back (lineage cut)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def scale_conf(shuffle_bytes: float, executor_cores: int, executors: int,
               target_partition_bytes: float = 256 * 1024 ** 2) -> dict:
    """Spill-aware sizing for a large run (set at submit time).

    Shuffle partitions are chosen so each reducer holds about
    ``target_partition_bytes`` of the largest shuffle (AQE then merges small
    ones and splits skewed ones), never fewer than 2 tasks per core; scans
    are split at 256 MB, and broadcasts stay under 64 MB so a measured-small
    side never costs executor memory at 1000 executors.
    """
    cores = max(1, executor_cores * executors)
    parts = max(2 * cores, int(shuffle_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_partition_bytes)),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(int(4 * target_partition_bytes)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table through the Hadoop FileSystem of its URI
    (HDFS, object stores or local), once no job reads it any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# ---- small files through the Hadoop FileSystem of their URI ------------------

def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a name that is not taken; its parents are made."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise FileExistsError(target)


def file_stamp(spark: SparkSession, path: str) -> tuple:
    """(length, modification time) of a table's files, by name."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return ()
    found = fs.listStatus(p)
    return tuple(sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in found))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name, then rename it to a name that
    is not taken yet: readers see all of it or nothing."""
    fs, p = _fs(spark, path)
    fs_tmp, tmp = _fs(spark, f"{os.path.dirname(path)}/_tmp-{uuid.uuid4().hex[:12]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise FileExistsError(path)
