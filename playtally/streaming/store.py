"""The job's stored state: batch folders, completion marks, snapshots.

Tables of an output folder, each with one ``batch_id=N`` folder per batch that wrote to it:
``deltas`` (per-target sums), ``rejected``, ``metrics``, ``notices``, ``pending`` (notices to
be sent), ``ledger`` (offset ranges), ``files`` (log files read).

*Marks.* ``done/batch_id=N`` marks a complete batch. Every ``MARKS_KEPT`` batches the marks
are folded into ``manifest/upto=N`` (all batches up to N are complete) and removed, so their
number does not grow with the job's age. Readers use marked batches only.

*Snapshots* of batch N hold everything up to N: ``snapshots`` (counters) and
``notice_snapshots`` by hash bucket of the target (``buckets=B/bucket=K``), so a batch opens
only the buckets its targets fall in; ``positions`` (committed offset of each topic
partition) and ``file_snapshots``. ``B`` doubles when buckets outgrow ``BUCKET_BYTES``.
With those, the batch folders behind the second newest snapshot are only history and may be
removed (:func:`expire_batches`).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally.functions.keys import counter_key
from playtally.operators.offsets import committed_offsets
from playtally.session import folder_bytes, partition_values, path_exists, remove_folder, touch

MARKS_KEPT = 16
BUCKET_BYTES = 32 << 20
SNAPSHOTS_KEPT = 3       # the newest, and two for readers that are still on them


@dataclass(frozen=True)
class JobLayout:
    root: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def part(self, name: str, batch_id: int) -> str:
        return f"{self.table(name)}/batch_id={batch_id}"


# Schemas of the job's output tables (explicit, so reading them back needs
# no footer-inference job). ``batch_id`` comes from the folder names.
SCHEMAS = {
    "deltas": "target_id BIGINT, batch_count BIGINT",
    "snapshots": "target_id BIGINT, view_count BIGINT",
    "notices": "target_id BIGINT, notice_key STRING, view_count BIGINT",
    "ledger": "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT",
    "metrics": "n_rows BIGINT, n_rejected BIGINT",
    "files": "file STRING",
    "notice_snapshots": "target_id BIGINT, notice_key STRING, view_count BIGINT, noticed_in BIGINT",
    "positions": "topic STRING, partition INT, until_offset BIGINT",
    "file_snapshots": "file STRING",
}
SNAPSHOT_TABLES = ("snapshots", "notice_snapshots", "positions", "file_snapshots")


@dataclass(frozen=True)
class Marks:
    """Which batches are complete: all up to ``upto``, and the listed ones."""

    upto: int
    listed: frozenset[int]

    @classmethod
    def load(cls, spark: SparkSession, layout: JobLayout) -> Marks:
        # In this order: marks are removed only after the manifest that holds them is written.
        listed = partition_values(spark, layout.table("done"), "batch_id")
        upto = partition_values(spark, layout.table("manifest"), "upto")
        return cls(upto[-1] if upto else -1, frozenset(listed))

    def __contains__(self, batch_id: int) -> bool:
        return batch_id <= self.upto or batch_id in self.listed

    def last(self) -> int:
        """The newest complete batch, -1 if there is none."""
        return max(self.upto, *self.listed) if self.listed else self.upto

    def between(self, after: int, before: int | None = None) -> range:
        """Complete batches after ``after``, up to ``before`` or the first without a mark (batch ids
        have no gaps)."""
        stop = max(after + 1, self.upto + 1)
        while stop in self.listed and (before is None or stop < before):
            stop += 1
        return range(after + 1, stop if before is None else min(stop, before))


def is_done(spark: SparkSession, layout: JobLayout, batch_id: int) -> bool:
    return path_exists(spark, layout.part("done", batch_id)) or batch_id in Marks.load(spark, layout)


def mark_done(spark: SparkSession, layout: JobLayout, batch_id: int) -> None:
    """Mark a batch complete; the marks before it are folded when there are many."""
    touch(spark, f"{layout.part('done', batch_id)}/mark")
    listed = partition_values(spark, layout.table("done"), "batch_id")
    if len(listed) <= MARKS_KEPT:
        return
    older = partition_values(spark, layout.table("manifest"), "upto")
    # The newest marks stay, so that a batch that runs again after a failure can lose its own.
    folded = older[-1] if older else -1
    complete = Marks(folded, frozenset(listed)).between(folded)
    if len(complete) < 2:
        return
    upto = complete[-2]
    touch(spark, f"{layout.table('manifest')}/upto={upto}/mark")
    for n in listed:
        if n <= upto:
            remove_folder(spark, layout.part("done", n))
    for n in older:
        if n < upto:
            remove_folder(spark, f"{layout.table('manifest')}/upto={n}")


def last_snapshot(spark: SparkSession, layout: JobLayout, before: int | None = None) -> int | None:
    """Newest snapshot of a complete batch (older than ``before``)."""
    snaps = partition_values(spark, layout.table("snapshots"), "batch_id")
    marks = Marks.load(spark, layout) if snaps else None
    for s in reversed(snaps):
        if (before is None or s < before) and s in marks:
            return s
    return None


def snapshot_buckets(spark: SparkSession, layout: JobLayout, snap: int | None) -> int:
    """Number of buckets of a snapshot (one if there is none)."""
    found = partition_values(spark, layout.part("snapshots", snap), "buckets") if snap is not None else []
    return found[-1] if found else 1


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("target_id"), F.lit(buckets)).cast("int")


def _columns(name: str) -> list[str]:
    return [field.split()[0] for field in SCHEMAS[name].split(", ")]


def read_batches(spark: SparkSession, layout: JobLayout, name: str, batches: Iterable[int]) -> DataFrame | None:
    """Rows of the named batches' folders, opened by name; None if none of them wrote to the table."""
    stored = set(partition_values(spark, layout.table(name), "batch_id"))
    paths = [layout.part(name, n) for n in batches if n in stored]
    if not paths:
        return None
    reader = spark.read.option("basePath", layout.table(name))
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name] + ", batch_id BIGINT")
    rows = reader.parquet(*paths).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    # A batch's folder may have folders of its own (a stateful query's micro-batches).
    return rows.select(*_columns(name), "batch_id") if name in SCHEMAS else rows


def read_snapshot(spark: SparkSession, layout: JobLayout, name: str, snap: int | None,
                  touched: Iterable[int] | None = None) -> DataFrame | None:
    """Rows of a snapshot table; with ``touched`` only those buckets' folders are opened."""
    if snap is None or not path_exists(spark, layout.part(name, snap)):
        return None
    reader = spark.read.schema(SCHEMAS[name])
    if touched is None:
        return reader.parquet(layout.part(name, snap)).select(*_columns(name))
    folder = f"{layout.part(name, snap)}/buckets={snapshot_buckets(spark, layout, snap)}"
    held = sorted(set(partition_values(spark, folder, "bucket")) & set(touched))
    return reader.parquet(*(f"{folder}/bucket={k}" for k in held)) if held else None


def union(parts: list[DataFrame | None]) -> DataFrame | None:
    out = None
    for p in parts:
        if p is not None:
            out = p if out is None else out.unionByName(p)
    return out


def history(spark: SparkSession, layout: JobLayout, before: int | None = None,
            touched: Iterable[int] | None = None) -> DataFrame | None:
    """``target_id, batch_count`` rows whose sum per target is the total before batch ``before``
    (default: of all complete batches): the latest snapshot (of the ``touched`` buckets) plus
    later deltas, at most ``compact_every`` folders."""
    snap = last_snapshot(spark, layout, before)
    base = read_snapshot(spark, layout, "snapshots", snap, touched)
    later = read_batches(spark, layout, "deltas",
                         Marks.load(spark, layout).between(-1 if snap is None else snap, before))
    return union([None if base is None else base.select("target_id", F.col("view_count").alias("batch_count")),
                  None if later is None else later.select("target_id", "batch_count")])


def notified(spark: SparkSession, layout: JobLayout, before: int | None = None,
             touched: Iterable[int] | None = None) -> DataFrame | None:
    """Notices of the batches before ``before``, with the batch of each as ``noticed_in``."""
    snap = last_snapshot(spark, layout, before)
    base = read_snapshot(spark, layout, "notice_snapshots", snap, touched)
    later = read_batches(spark, layout, "notices",
                         Marks.load(spark, layout).between(-1 if snap is None else snap, before))
    return union([base, None if later is None else later.withColumnRenamed("batch_id", "noticed_in")])


def _since_snapshot(spark: SparkSession, layout: JobLayout, snapshot_name: str, batch_name: str, columns: list[str],
                    before: int | None = None) -> DataFrame | None:
    snap = last_snapshot(spark, layout, before)
    later = read_batches(spark, layout, batch_name,
                         Marks.load(spark, layout).between(-1 if snap is None else snap, before))
    return union([read_snapshot(spark, layout, snapshot_name, snap), None if later is None else later.select(*columns)])


def positions(spark: SparkSession, layout: JobLayout, before: int | None = None) -> DataFrame | None:
    """``topic, partition, until_offset``: from the newest positions snapshot and later ledgers."""
    rows = _since_snapshot(spark, layout, "positions", "ledger", ["topic", "partition", "until_offset"], before)
    return None if rows is None else committed_offsets(rows)


def consumed_files(spark: SparkSession, layout: JobLayout, before: int | None = None) -> DataFrame | None:
    """``file``: log files whose lines are in the complete batches before ``before``."""
    return _since_snapshot(spark, layout, "file_snapshots", "files", ["file"], before)


def write_snapshots(spark: SparkSession, layout: JobLayout, n: int, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Snapshots as of batch ``n``, from complete batches and the one being finished; older ones go,
    but for the newest."""
    last = last_snapshot(spark, layout, n)
    buckets = snapshot_buckets(spark, layout, last)
    size = folder_bytes(spark, layout.part("snapshots", last)) if last is not None else 0
    while size > buckets * bucket_bytes:
        buckets *= 2

    def own(name: str, *columns: Column | str) -> DataFrame | None:
        rows = read_batches(spark, layout, name, [n])
        return None if rows is None else rows.select(*columns)

    def write(rows: DataFrame, name: str) -> None:
        (rows.withColumn("buckets", F.lit(buckets)).withColumn("bucket", bucket_of(buckets))
         .repartition(buckets, "bucket").write.mode("overwrite").partitionBy("buckets", "bucket")
         .parquet(layout.part(name, n)))

    totals = union([history(spark, layout, n), own("deltas", "target_id", "batch_count")])
    if totals is None:
        return
    told = union([notified(spark, layout, n), own("notices", "target_id", "notice_key", "view_count",
                                                  F.col("batch_id").alias("noticed_in"))])
    if told is not None:
        write(told, "notice_snapshots")
    at = union([positions(spark, layout, n), own("ledger", "topic", "partition", "until_offset")])
    if at is not None:
        committed_offsets(at).write.mode("overwrite").parquet(layout.part("positions", n))
    files = union([consumed_files(spark, layout, n), own("files", "file")])
    if files is not None:
        files.distinct().write.mode("overwrite").parquet(layout.part("file_snapshots", n))
    # The counters last: a snapshot without them is none.
    write(totals.groupBy("target_id").agg(F.sum("batch_count").cast("bigint").alias("view_count")), "snapshots")
    for name in SNAPSHOT_TABLES:
        for old in partition_values(spark, layout.table(name), "batch_id")[:-SNAPSHOTS_KEPT]:
            remove_folder(spark, layout.part(name, old))


def read_counters(spark: SparkSession, out_dir: str) -> DataFrame:
    """Counter table ``target_id, counter_key, view_count`` over the complete batches of a job's
    output folder."""
    rows = history(spark, JobLayout(out_dir))
    if rows is None:
        return spark.createDataFrame([], "target_id BIGINT, counter_key STRING, view_count BIGINT")
    return (rows.groupBy("target_id").agg(F.sum("batch_count").cast("bigint").alias("view_count"))
            .select("target_id", counter_key().alias("counter_key"), "view_count"))


def committed_positions(spark: SparkSession, out_dir: str) -> DataFrame:
    """``topic, partition, until_offset`` of the complete batches (for a resume)."""
    rows = positions(spark, JobLayout(out_dir))
    return rows if rows is not None else spark.createDataFrame([], SCHEMAS["positions"])


def read_output(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """One output table (``notices``, ``ledger``, ``rejected``, ``metrics``, ``deltas``, ``files``) over
    the complete batches that retention has left; notices are always whole."""
    layout = JobLayout(out_dir)
    marks = Marks.load(spark, layout)
    if name == "notices":
        rows = notified(spark, layout)
        if rows is not None:
            rows = rows.withColumnRenamed("noticed_in", "batch_id")
    else:
        rows = read_batches(spark, layout, name,
                            [n for n in partition_values(spark, layout.table(name), "batch_id") if n in marks])
    if rows is not None:
        return rows
    return spark.createDataFrame([], f"{SCHEMAS.get(name, 'line STRING')}, batch_id BIGINT")


def expire_batches(spark: SparkSession, out_dir: str, keep: int) -> list[int]:
    """Retention: remove the batch folders that the second newest snapshot covers and that are older
    than the newest ``keep`` batches. Counters, notices, positions and consumed files stay as they
    are (the snapshots hold them); deltas, ledger rows, rejected rows and metrics of those batches go."""
    layout = JobLayout(out_dir)
    marks = Marks.load(spark, layout)
    snaps = [s for s in partition_values(spark, layout.table("snapshots"), "batch_id") if s in marks]
    if len(snaps) < 2:
        return []
    last, gone = min(snaps[-2], marks.last() - keep), set()
    for name in ("deltas", "rejected", "metrics", "ledger", "notices", "pending", "files"):
        for n in partition_values(spark, layout.table(name), "batch_id"):
            if n <= last:
                remove_folder(spark, layout.part(name, n))
                gone.add(n)
    return sorted(gone)
