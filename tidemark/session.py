"""Session construction and shared scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """A session configured the way every job here expects.

    Session time zone is pinned to UTC (event times are UTC wall-clock), AQE
    is on so shuffle partition counts and skewed partitions are re-planned at
    runtime, and the UI server stays off. Master and shuffle partitions are
    set only if given: ``spark-submit`` and the cluster's defaults decide else.
    """
    builder = (
        SparkSession.builder
        .appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a session in one process (``local``, as in tests)
    gets a private folder where it is unset. A cluster without it is an error:
    its machines share no folder of their own.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(CHECKPOINT_CONF, base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared folder; ``unique`` appends a fresh run id."""
    segs = [shared_dir(spark), "tidemark", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join(segs)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as it names it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def files_under(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, length, modification time) of every file under ``path``; none if it does not exist."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    out, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A short text as one file, in place of an older one."""
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    """A text that `write_small` wrote."""
    fs, p = file_system(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def cluster_conf(executor_cores_total: int) -> dict[str, str]:
    """Settings for a large cluster run (pass as ``build_session(extra=...)``).

    Shuffle partitions at ~3x the cores (AQE coalesces what turns out small,
    and splits skewed partitions); 256 MB scan splits; streaming state in
    RocksDB with changelog checkpointing so state size is bounded by local
    disk, not executor heap, and each commit uploads only the changes.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * executor_cores_total)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.minBatchesToRetain": "20",
    }
