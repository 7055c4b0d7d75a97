"""Session settings and the scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_scratch: tempfile.TemporaryDirectory | None = None
_scratch_paths: list[str] = []
_remembered: dict[str, dict] = {}


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own settings."""
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("skyledger")
    spark = builder.config(map={**defaults, **settings}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may do without
    that setting; it then gets a temporary folder that goes with the process.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="skyledger-")
        root = _local_scratch.name
    path = f"{root.rstrip('/')}/skyledger/{label}-{uuid.uuid4().hex}"
    _scratch_paths.append(path)
    return path


def remembered(spark: SparkSession) -> dict:
    """What this session keeps for later in scratch paths; emptied with them."""
    return _remembered.setdefault(spark.sparkContext.applicationId, {})


def tidy_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose queries leave no shuffle files behind.

    Otherwise they lie on the executors' disks until the driver's garbage collector has
    come across their frames: a run of many queries keeps the shuffles of all of them.
    """
    tidy = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            tidy.conf.set(name, value)
    tidy.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return tidy


def _delete(spark: SparkSession, place: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession, place: str) -> None:
    """Delete one scratch path that no frame will read again."""
    _scratch_paths.remove(place)
    _delete(spark, place)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch paths this process was given.

    Frames that read them are lazy, so only their user knows when that is safe.
    """
    remembered(spark).clear()
    while _scratch_paths:
        _delete(spark, _scratch_paths.pop())
