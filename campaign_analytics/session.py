"""Session settings the library is written for, and where durable scratch data goes."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work the jobs rely on: it coalesces small shuffle
# partitions, splits skewed join partitions, and turns a join into a broadcast only after the
# measured size of a side is under the broadcast threshold.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# For the session builder only. Plans are built from many small column calls; recording the caller's
# stack for each of them takes longer than building the plan.
BUILDER = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def run_folder(spark: SparkSession) -> str:
    """The folder of this application under ``spark.checkpoint.dir``, the shared folder the cluster names.

    Only where that setting is missing (tests on one machine) is it a temporary folder, which goes with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    root = tempfile.mkdtemp(prefix="campaign-analytics-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder of this run for streaming checkpoints and written tables."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_run(spark: SparkSession) -> None:
    """Delete all that this application wrote to its run folder, once none of its frames is used any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
