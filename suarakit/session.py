"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 2048
BATCH_BYTES = 8 << 20

_shipped: set[str] = set()
_local_dirs: dict[str, str] = {}


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    Workers start in folders of their own, so a path that only the driver has does not help them.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="suarakit-ship-")
        copy = os.path.join(folder, "content", os.path.basename(package))
        shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
        archive = shutil.make_archive(os.path.join(folder, "suarakit"), "zip", os.path.dirname(copy))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators need to an existing session."""
    ship(spark)
    # Model output may repeat a key; the last one wins, as in most JSON readers.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # Ids seen by a stream outgrow executor memory; RocksDB keeps them on disk.
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # What a Python worker gets at once: few rows of long texts, a few blocks of vectors.
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        given = spark.conf.get(name)
        # Not positive: no limit.
        size = 0 if given.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given)
        spark.conf.set(name, str(min(size, most) if size else most))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("suarakit")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a session of one process (``local[n]``) may do without: it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        # The setting is fixed once a session runs, so the folder is remembered here.
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="suarakit-")
        root = _local_dirs[context.applicationId]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever reused or overwritten."""
    return f"{shared_dir(spark)}/suarakit/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it belongs to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`scratch_path` named; anything else is refused."""
    if not path.startswith(f"{shared_dir(spark)}/suarakit/"):
        raise ValueError(f"{path} is no scratch folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint that survives executor loss."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for CPU-heavy work when a scan is narrower than the cluster.

    A large scan already has more splits than cores and passes through untouched, so
    this never adds a shuffle there; it only deals out tables held in a few row groups.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
