"""Session settings and the shared folder that intermediate tables land in."""

from __future__ import annotations

import gc
import hashlib
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here assumes. Broadcasts are left to Spark's own
# size check (autoBroadcastJoinThreshold, adaptive re-planning); a hot join key
# is split at run time even where that costs the plan one more exchange. The JVM never
# compiles a method of more than 8,000 bytes: beyond it, as with projections of many text
# columns, a plan without whole-stage code is several times as fast.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}
SHARED_DIR_KEY = "spark.checkpoint.dir"
#: Landed tables are written once and read a few times: disk and network weigh more than CPU.
LANDED_CODEC = "zstd"
#: Seconds of a written step from which its shuffle files are worth a collection of garbage.
RELEASE_AFTER_S = 10


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    A session without ``spark.checkpoint.dir`` uses its warehouse folder; a cluster
    whose warehouse is on one machine's disk is refused, because tables landed there
    would be in pieces on the executors' own disks.
    """
    named = spark.conf.get(SHARED_DIR_KEY, None)
    if named:
        return named.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = folder.startswith(("file:", "/"))
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_KEY}: {folder} is not shared between executors")
    return f"{folder}/landed"


def _landing(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/freightlens/{spark.sparkContext.applicationId}"


def release(spark: SparkSession, began: float) -> None:
    """Let go of the shuffle files of what was written since ``began`` (``time.monotonic``).

    Spark removes them once the driver has found their plan to be garbage, which a driver with
    memory to spare may not look for before the last step: until then the disk holds the
    shuffles of all steps at once. After a short step there is little to remove. A second
    collection finds what the first one's clean-up has let go of.
    """
    if time.monotonic() - began < RELEASE_AFTER_S:
        return
    for wait in (0.5, 0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage at a layer boundary with a table that outlives any executor
    and that later plans can prune and push filters into.
    """
    spark, began = df.sparkSession, time.monotonic()
    path = f"{_landing(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").option("compression", LANDED_CODEC).parquet(path)
    release(spark, began)
    landed = spark.read.schema(df.schema).parquet(path)
    landed._landed_at = path
    return landed


def _filesystem_path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this name, on whatever store it is."""
    files, at = _filesystem_path(spark, path)
    return files.exists(at)


def still_landed(df: DataFrame | None) -> bool:
    """Whether a landed table is still in its folder, so that it can be used again."""
    return df is not None and path_exists(df.sparkSession, df._landed_at)


def source_state(spark: SparkSession, folder: str) -> str:
    """What tells one state of a folder's files from another: paths, lengths, times."""
    files, at = _filesystem_path(spark, folder)
    if not files.exists(at):
        return ""
    found, seen = files.listFiles(at, True), []
    while found.hasNext():
        entry = found.next()
        seen.append((entry.getPath().toString(), entry.getLen(), entry.getModificationTime()))
    return hashlib.md5(repr(sorted(seen)).encode()).hexdigest()


def discard_landed(spark: SparkSession) -> bool:
    """Remove what this application has landed; call it when its results are written."""
    files, at = _filesystem_path(spark, _landing(spark))
    return files.delete(at, True)
