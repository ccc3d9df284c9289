"""Session set-up and the shared folder for state and written tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Applications whose workers were sent the package.
_shipped: set[str] = set()
# The folder of each application.
_scratch: dict[str, str] = {}

SETTINGS = {
    # One time zone on both sides of every timestamp cast.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top k drops rows before its shuffles for any k that a task can hold.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # A text file is cut into tasks the same way in every scan, whatever cores there are.
    "spark.sql.files.minPartitionNum": "64",
    # Stream state outside the heap: one row per open window and word.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(name: str = "wordflow", settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators expect, and more if given."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the workers of Python functions, if they would not find it.

    They do where it is installed, on ``PYTHONPATH``, or in the folder the session
    was started in.
    """
    root = Path(__file__).resolve().parent.parent
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    installed = root.name in ("site-packages", "dist-packages")
    if installed or str(root) in known or spark.sparkContext.applicationId in _shipped:
        return
    target = f"{tempfile.mkdtemp(prefix='wordflow-')}/wordflow"
    spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "wordflow"))
    _shipped.add(spark.sparkContext.applicationId)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def shared_base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a local session may do without; it gets a new temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="wordflow-")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors see.

    It lies in a folder of the application, which goes when the driver ends.
    """
    application = spark.sparkContext.applicationId
    if application not in _scratch:
        _scratch[application] = f"{shared_base(spark)}/wordflow-{application}"
        files, place = file_system(spark, _scratch[application])
        files.mkdirs(place)
        files.deleteOnExit(place)
    return f"{_scratch[application]}/{purpose}-{uuid.uuid4().hex}"
