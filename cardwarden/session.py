"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that change results or plans; a cluster sets the rest.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cardwarden")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure_streams(spark: SparkSession) -> SparkSession:
    """Keyed streams keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return configure(spark)


@contextmanager
def running_stream(spark: SparkSession):
    """Settings of a keyed stream that runs inside the block; the session's own come back after it.

    Each partition of a stream's state costs about half a second of a core in every micro-batch whatever it
    holds, so there are as many as tasks run at once. Of a run that is read to its end and not taken up
    again, only the last states are kept.
    """
    wanted = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    settings = {
        "spark.sql.shuffle.partitions": str(max(wanted, 1)), "spark.sql.streaming.minBatchesToRetain": "2",
        # A micro-batch of one small file is read by all tasks, not by one.
        "spark.sql.files.openCostInBytes": "262144",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for cut lineage: the shared one the session names, else one in the local warehouse.

    A cluster has to name it (spark.checkpoint.dir). In local mode the warehouse
    folder serves, in a folder of the application that goes when the JVM ends.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current is not None:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        shared = f"{warehouse}/cardwarden-stored/{spark.sparkContext.applicationId}"
        path, files = on_store(spark, shared)
        files.mkdirs(path)
        files.deleteOnExit(path)
    spark.sparkContext.setCheckpointDir(shared)
    return spark.sparkContext.getCheckpointDir() or shared


def on_store(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


_MADE: list[str] = []


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh place in the checkpoint folder; scratch() removes it."""
    folder = f"{use_checkpoint_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    _MADE.append(folder)
    return folder


@contextmanager
def scratch(spark: SparkSession):
    """Owns what is stored inside the block: at its end the stored tables are deleted.

    Results that read them must be consumed, or written elsewhere, before.
    """
    before = len(_MADE)
    try:
        yield
    finally:
        for folder in _MADE[before:]:
            path, files = on_store(spark, folder)
            files.delete(path, True)
        del _MADE[before:]


def stored(df: DataFrame) -> DataFrame:
    """Write a result to the checkpoint folder and go on from the written table.

    Cuts the lineage and survives lost executors; unlike a checkpointed RDD the
    table is columnar and its size is known to the planner.
    """
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that stored() returned, once everything made of it is stored itself."""
    path, files = on_store(table.sparkSession, table.stored_at)
    files.delete(path, True)
    _MADE.remove(table.stored_at)
