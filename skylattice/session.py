"""Session set-up and the shared folder in which jobs cut their lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning carries the skew handling of every join in this package: a hot
# frame or grid cell is split over tasks, and small measured sides are broadcast.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_folders: dict[str, str] = {}


def build_session(app="skylattice", master=None, conf=None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) gets a folder of its own; on
    a cluster a missing setting is an error, since a machine-local folder would be lost
    with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="skylattice-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared folder."""
    return f"{shared_folder(spark)}/skylattice/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Later steps then neither repeat the work nor depend on the executors that did it,
    and Spark sees the true size of the table, so it broadcasts the table only if that
    size is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
