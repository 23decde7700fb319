"""Session helpers: shipping the package to Python workers, tables in the shared folder, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PACKAGE = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
_shipped: dict[str, str] = {}
_own: dict[str, str] = {}


def _local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package: from the place it has here where they run on this machine alone, and on a
    cluster from an archive that is sent to the executors, once an application."""
    sc = spark.sparkContext
    env = sc.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    if not _local(spark) and sc.applicationId not in _shipped:
        at = os.path.join(tempfile.mkdtemp(), f"{PACKAGE}.zip")  # the driver's copy, which is sent from here
        with zipfile.ZipFile(at, "w") as z:
            for folder, _, names in os.walk(os.path.join(ROOT, PACKAGE)):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, ROOT))
        sc.addPyFile(at)
        _shipped[sc.applicationId] = at
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, one of our own on this machine in local mode, as in tests; on
    a cluster an error."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        held = sc._jsc.sc().getCheckpointDir()
        at = None if held.isEmpty() else held.get()
    if not at:
        if not _local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = _own.setdefault(sc.applicationId, "") or _own.update({sc.applicationId: tempfile.mkdtemp(prefix=f"{PACKAGE}-")}) or _own[sc.applicationId]
    return at


def release(spark: SparkSession) -> None:
    """Removes the tables this application has staged; results that still read them must be written first."""
    jvm, sc = spark._jvm, spark.sparkContext
    root = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{sc.applicationId}-*")) or []:
        fs.delete(status.getPath(), True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it from there: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most that many rows (it should be a staged table); else as it is, so that joins with it shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
