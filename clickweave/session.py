"""Session defaults and the shared scratch area.

Intermediate tables that must be evaluated exactly once (a row numbering, the
state between two routing iterations, ...) are written as parquet below the
folder named by ``spark.checkpoint.dir``. Unlike an RDD checkpoint the written
table keeps column pruning, filter push-down and a real size estimate, and it
survives the loss of executors.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A task holds a few Arrow batches at once, on both sides of its pipe to Python.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
_LOCAL_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(app: str = "clickweave", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # State of a week of keys belongs on disk, not on the heap.
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables of this application.

    On a cluster the folder must be named by ``spark.checkpoint.dir``. A
    machine-local folder is only made up for a ``local`` master.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _LOCAL_ROOTS.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="clickweave-"))
    return f"{base.rstrip('/')}/clickweave/{sc.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that nobody has used yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """RDD checkpoints of library algorithms go to the same shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "rdd"))


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; none may be in use any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, and batches of a
    bounded size unless the session names another."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="ship-")) / package.name), "zip",
                                  root_dir=package.parent, base_dir=package.name)
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
