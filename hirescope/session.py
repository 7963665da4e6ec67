"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on.  They are *defaults*: a value
# set explicitly at submit time (present in the SparkConf) is kept.
_RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MiB splits keep scan tasks a comfortable size at any scale factor.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}
# Context-level settings (fixed when the context starts): no UI server, and
# checkpoint files of garbage-collected DataFrames are removed.
_STATIC_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "hirescope", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) the session with the package defaults applied.

    ``shuffle_partitions`` and ``extra`` are explicit requests and always win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _STATIC_DEFAULTS.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for k, v in _RUNTIME_DEFAULTS.items():
        if not submitted.contains(k) and k not in (extra or {}):
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        try:
            spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 -- static keys were applied by the builder
            pass
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and versioned tables.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder
    and is used as is.  Only when it is unset -- local tests -- do we create
    one under the system temp folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) on a cluster")
        d = tempfile.mkdtemp(prefix="hirescope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: a lineage cut that
    survives lost executors, and unlike a checkpoint is columnar, so every
    reader scans only its columns, and has a size the planner knows."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
