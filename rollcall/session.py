"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings a registry job wants on any cluster. Broadcast joins are left to the planner: it
# broadcasts a side only when its size, from file or runtime statistics, is under
# spark.sql.autoBroadcastJoinThreshold, and sorts and merges otherwise.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Recording the Python line of every column expression costs more than planning a small query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Bytes one shuffle task should meet at most, and the least number of such tasks.
SHUFFLE_BYTES = 256 << 20
MIN_SHUFFLE_TASKS = 200


def shuffle_tasks(input_bytes: int) -> int:
    """Shuffle partitions to start from for an input of this size.

    Adaptive execution merges partitions that turn out small, but splits none except in skewed
    joins, so a large load must start with enough of them for each to fit in memory: 372,530 for
    100 TB, without an upper bound.
    """
    return max(MIN_SHUFFLE_TASKS, -(-input_bytes // SHUFFLE_BYTES))


def build_session(
    app: str = "rollcall",
    master: str | None = None,
    input_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the library's settings, its shuffles sized for ``input_bytes`` if given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **extra}
    if input_bytes is not None:
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_tasks(input_bytes)))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application.

    Needed where the package is neither installed on the machines nor in their working folder.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="rollcall-"), "rollcall_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


_local_scratch: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; a cluster session must
    name one, since a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="rollcall-")
    return _local_scratch[sc.applicationId]


def scratch_path(spark: SparkSession, stem: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"


def stage(df: DataFrame, stem: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For results that several later steps read: it cuts the lineage, survives lost executors and
    gives the planner real sizes.
    """
    path = scratch_path(df.sparkSession, stem)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
