"""Session helper and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "threadloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; extra settings as keywords
    with dots written as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: list[tempfile.TemporaryDirectory] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Where none is
    named a local session gets a temporary folder, which goes when Python ends; on
    a cluster that is an error, as executors would each write to their own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _LOCAL.append(tempfile.TemporaryDirectory(prefix="threadloom-"))
        current = _LOCAL[-1].name
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's folder in the shared one."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/threadloom/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has written between its passes.

    For the caller to call when no frame made from it is needed any more.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Probe a path through the Hadoop file system it belongs to."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target))


def materialize(df, label: str):
    """Write a frame to the shared folder and read it back.

    Cuts the lineage with one computation, and a lost executor only rereads.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(*frames) -> None:
    """Remove what ``materialize`` wrote for these frames; nothing made from them may be read any more."""
    for df in frames:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written)
        target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def ship_package(spark) -> None:
    """Send this package to the executors, once per application.

    Arrow functions are unpickled there by module name.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="threadloom-ship-")) / "threadloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)
