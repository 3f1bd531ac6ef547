"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the next step then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Join and window state of a stream outgrows the heap; this provider keeps it on disk.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # The count of state rows, only a figure in the progress report, costs a look-up before every put and removal.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


LOCAL_FOLDERS: dict[str, str] = {}  # by application, for local sessions without the setting


def build_session(app: str = "tiffin", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this library expects. Keys are full Spark configuration names."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in LOCAL_FOLDERS:
        LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tiffin-")
    return LOCAL_FOLDERS[context.applicationId]


def scratch_root(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_dir(spark)}/tiffin/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the application's root; nothing is ever written there twice."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the application's intermediate tables. For the end of a job: results that still read them are lost."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so that several consumers see the same rows and a lost executor does not
    bring back a different split. Parquet rather than ``checkpoint()`` lets each consumer read
    only its columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
