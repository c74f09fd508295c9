"""Session defaults and the shared working folder.

Scratch output (staged streams, checkpoints, sink tables) always lives under
the folder the cluster names in ``spark.checkpoint.dir``. Only when the
session has no such folder (local runs, tests) is one made here.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Defaults for sessions built by this package. A session handed in by a caller
# is never reconfigured, except for the checkpoint folder when it is unset.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Counter and dedup state lives for ever (one entry per target): keep it
    # off-heap in RocksDB instead of the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Commit only the changed keys per batch (snapshots are made in the
    # background) instead of uploading a full RocksDB snapshot every batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "playtally",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()  # the scratch folder is made when something first needs it


def _context(spark: SparkSession):
    """The SparkContext of a classic session, or None (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def work_root(spark: SparkSession) -> str:
    """The reliable checkpoint folder of the session, made only if unset."""
    sc = _context(spark)
    root = sc.getCheckpointDir() if sc is not None else None
    if root:
        return root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach; "
                               "a machine-local temporary folder does not survive lost executors")
        # Local runs and tests only: a cluster names a shared folder here.
        configured = tempfile.mkdtemp(prefix="playtally-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", configured)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint folder."""
    return f"{work_root(spark).rstrip('/')}/playtally/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop_fs(spark: SparkSession, path: str):
    sc = _context(spark)
    if sc is None or getattr(sc, "_jvm", None) is None:
        # A client without a JVM sees only its own disk, where a cluster path is always absent.
        raise RuntimeError("folder state needs a session with a JVM (not Spark Connect)")
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through Hadoop's FileSystem, so any cluster store works."""
    fs, hpath = _hadoop_fs(spark, path)
    return bool(fs.exists(hpath))


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Integer values of ``column=N`` sub-folders of ``path`` (folder listing only)."""
    fs, hpath = _hadoop_fs(spark, path)
    if not fs.exists(hpath):
        return []
    # All names in one call: each call to the JVM costs as much as a small listing.
    jvm = spark.sparkContext._jvm
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(hpath))
    listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)
    return sorted(int(n) for n in re.findall(rf"/{column}=(-?[0-9]+)(?=,|}}$)", listed))


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file (and its folders); an existing one stays."""
    fs, hpath = _hadoop_fs(spark, path)
    if not fs.exists(hpath):
        fs.create(hpath, True).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop_fs(spark, path)
    fs.delete(hpath, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop_fs(spark, path)
    fs.mkdirs(hpath)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a folder (listing only)."""
    fs, hpath = _hadoop_fs(spark, path)
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file through Hadoop's FileSystem, None if it is absent."""
    fs, hpath = _hadoop_fs(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, complete when its name appears (written aside, then renamed)."""
    fs, hpath = _hadoop_fs(spark, path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(aside, hpath):
        raise FileExistsError(path)


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did (clusters whose nodes do
    not share the code get it by ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def materialize(df, name: str):
    """Write ``df`` once to a fresh folder below the checkpoint folder and
    return it read back (explicit schema, no inference job).

    Cuts lineage where a plan would otherwise scan and compute the same
    input twice (self-joins defeat exchange reuse); the folder lives on the
    cluster's shared store, so lost executors lose nothing.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
