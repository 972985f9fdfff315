"""Session settings and shared scratch storage.

The jobs never hard-code physical plans; they rely on Catalyst and adaptive
query execution (AQE). These settings are what we recommend for a large
cluster; ``build_session`` applies them for local runs, tests and the bench.
"""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that matter at scale:
# * AQE re-plans at stage boundaries from measured shuffle sizes: it coalesces
#   small partitions, splits skewed join partitions, and turns a sort-merge join
#   into a broadcast join only when the *measured* build side is under
#   ``spark.sql.adaptive.autoBroadcastJoinThreshold``. The planner's own choice,
#   which goes by compressed file sizes, is off, and no job carries a broadcast hint
#   on data tables: this is the only path to a broadcast.
# * ANSI mode makes bad money or timestamp text fail loudly instead of nulling.
# * Wall-clock timestamps are read as TIMESTAMP_NTZ; UTC keeps any LTZ input stable.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    master: str | None = None,
    app_name: str = "emporia",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the recommended settings.

    On a cluster, pass no ``master`` and let spark-submit decide; size
    ``shuffle_partitions`` to about total input bytes / 128 MB so that AQE can
    coalesce downward rather than spill.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Automatic shuffle sizing. Shuffled rows take about twice their
# compressed columnar size on disk.
SHUFFLE_BYTES_PER_INPUT_BYTE = 2
MIN_SHUFFLE_PARTITIONS = 8

_BYTE_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def byte_size(text: str) -> int:
    """``'128m'`` / ``'64MB'`` / ``'1048576'`` -> bytes (Spark's size notation)."""
    t = text.strip().lower().removesuffix("b") or "0"
    unit = t[-1] if t[-1] in _BYTE_UNITS else "b"
    number = t[:-1] if t[-1] in _BYTE_UNITS else t
    return int(float(number) * _BYTE_UNITS[unit])


def input_bytes(df: DataFrame) -> int:
    """On-disk size of the files under ``df``'s scans (a listing; no file is opened)."""
    files = df.inputFiles()
    if not files:
        return 0
    listed = df.sparkSession.read.format("binaryFile").load([unquote(f) for f in files])
    return int(listed.agg(F.sum("length")).first()[0] or 0)


def shuffle_partitions_for(spark: SparkSession, frames: list[DataFrame]) -> int:
    """Shuffle partitions for a job reading ``frames``: about one advisory-sized
    partition (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) per
    ``SHUFFLE_BYTES_PER_INPUT_BYTE`` x input bytes, at least
    ``MIN_SHUFFLE_PARTITIONS`` and without an upper bound.

    Sized for the largest shuffle the job can produce, so no partition has to
    spill heavily; AQE then coalesces the smaller shuffles down to the advisory
    size. Starting too low cannot be repaired at run time (AQE only merges).
    """
    advisory = byte_size(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
    total = sum(input_bytes(f) for f in frames)
    wanted = -(-total * SHUFFLE_BYTES_PER_INPUT_BYTE // advisory)
    return int(max(MIN_SHUFFLE_PARTITIONS, wanted))


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # no JVM context reachable (e.g. a remote session)
        return None


def _master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:
        return spark.conf.get("spark.master", "")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint directory set on
    the context). Only a local-mode session without one gets a fresh local
    folder, which is then also registered as its checkpoint directory.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or _context_checkpoint_dir(spark)
    if configured:
        return configured.rstrip("/")
    if not _master(spark).startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder; a machine-local "
            "temporary folder is not visible to every executor"
        )
    local = tempfile.mkdtemp(prefix="emporia-scratch-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path under the shared scratch root (never reused)."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for driver-side helpers in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = [
    "RECOMMENDED_CONF",
    "build_session",
    "byte_size",
    "input_bytes",
    "shuffle_partitions_for",
    "scratch_root",
    "fresh_scratch_path",
    "local_path",
]
