"""A table that a stream writes batch by batch, with a log that says which folders are the table.

Every micro-batch goes to a fresh folder and becomes part of the table by one small log entry, put in place by a
rename. A repeated batch replaces its entry, so a restart never doubles rows, and a batch that failed half-way is in
no entry. Compaction writes what the table says into one folder and becomes valid by the entry ``snapshot-<version>``,
which names the last batch it has read: readers take the latest snapshot and the batches after it, so a query that
writes meanwhile loses nothing, and a reader sees the table before or after the switch. Folders without an entry stay
until ``vacuum``, for readers that began before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _put(spark: SparkSession, sink: str, name: str, entry: dict, replace: bool) -> None:
    """Write a log entry aside and rename it into place; without ``replace`` an entry of that name is an error."""
    jvm = spark._jvm
    aside, fs = _path(spark, f"{sink}/log/.{name}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    target, _ = _path(spark, f"{sink}/log/{name}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    how = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(how, 1)
    options[0] = how.OVERWRITE if replace else how.NONE
    context.rename(aside, target, options)


def _log(spark: SparkSession, sink: str) -> list[dict]:
    """All entries. There is one per batch since the last ``vacuum``."""
    folder, fs = _path(spark, f"{sink}/log")
    if not fs.exists(folder):
        return []
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(f"{sink}/log").collect()
    return [json.loads(r.value) for r in rows]


def _state(spark: SparkSession, sink: str) -> tuple[dict | None, dict[int, str]]:
    """The latest snapshot, and the folder of every batch after it."""
    entries = _log(spark, sink)
    snapshot = max((e for e in entries if "version" in e), key=lambda e: e["version"], default=None)
    upto = snapshot["upto"] if snapshot else -1
    return snapshot, {e["batch"]: e["folder"] for e in entries if "batch" in e and e["batch"] > upto}


def write_batch(df: DataFrame, batch_id: int, sink: str) -> None:
    """Make a micro-batch part of the table, in place of an earlier attempt at the same batch."""
    folder = f"{sink}/data/batch-{batch_id}-{uuid.uuid4().hex}"
    df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.parquet(folder)
    _put(df.sparkSession, sink, f"batch-{batch_id}", {"batch": batch_id, "folder": folder}, replace=True)


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    """All rows of the table as it is now, with the ``batch_id`` they came by; a snapshot's rows have its last one."""
    snapshot, batches = _state(spark, sink)
    folders = [*([snapshot["folder"]] if snapshot else []), *(batches[b] for b in sorted(batches))]
    if not folders:
        raise ValueError(f"no batch has been written to {sink}")
    return spark.read.parquet(*folders)


def compact(spark: SparkSession, sink: str, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Bring the table into one folder, its rows reduced by ``merge``, and return the snapshot's version.

    Batches that arrive meanwhile are not in the snapshot and stay in the table. Of two compactions at the same time
    one fails, and changes nothing. ``merge`` keeps what later readers need; ``batch_id`` is set here.
    """
    snapshot, batches = _state(spark, sink)
    upto = max([*batches, snapshot["upto"] if snapshot else -1])
    version = snapshot["version"] + 1 if snapshot else 0
    folders = [*([snapshot["folder"]] if snapshot else []), *(batches[b] for b in sorted(batches))]
    merged = merge(spark.read.parquet(*folders)).withColumn("batch_id", F.lit(upto).cast("bigint"))
    folder = f"{sink}/data/snapshot-{version}-{uuid.uuid4().hex}"
    merged.write.parquet(folder)
    entry = {"version": version, "upto": upto, "folder": folder}
    _put(spark, sink, f"snapshot-{version}", entry, replace=False)
    return version


def vacuum(spark: SparkSession, sink: str) -> int:
    """Delete the folders and entries that the latest snapshot replaced; returns how many folders went.

    Call it when no reader is left that began before the snapshot. Folders of batches after it, written or being
    written, are left alone.
    """
    snapshot, _ = _state(spark, sink)
    if snapshot is None:
        return 0
    gone = 0
    for entry in _log(spark, sink):
        old = entry.get("version", snapshot["version"]) < snapshot["version"] or entry.get("batch", snapshot["upto"] + 1) <= snapshot["upto"]
        if old:
            name = f"snapshot-{entry['version']}" if "version" in entry else f"batch-{entry['batch']}"
            for target in (f"{sink}/log/{name}.json", entry["folder"]):
                path, fs = _path(spark, target)
                fs.delete(path, True)
            gone += 1
    return gone
