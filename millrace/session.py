"""Session for tests and benchmarks, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "millrace", cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application, wherever the driver was started.

    Spark's own file server hands it out. Nothing is sent where the package is installed (``pip
    install .``) or the workers find it by PYTHONPATH or the folder they start in.
    """
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if context.applicationId in _shipped or "site-packages" in root or root in known:
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="millrace-package-"), "millrace"), "zip", root, "millrace")
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint directory.

    Only a local master, where all tasks share one machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    folder = tempfile.mkdtemp(prefix="millrace-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back: lineage is cut, and later passes read only their columns."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
