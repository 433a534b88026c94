"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A side is broadcast at run time, once its size is known to be within this bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Hourly state of a large fleet lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(master: str | None = None, name: str = "fleetwarden", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Hours are cut in UTC whatever the caller's session says."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir of the session.

    Only a local session without that setting gets a folder of its own; on a cluster a missing setting is
    an error, because a machine-local folder would not survive the loss of its machine.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="fleetwarden-")
        sc.setCheckpointDir(current)
    return current


def new_folder(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def staged(df: DataFrame) -> DataFrame:
    """Write df once as a table in the shared folder and read it back.

    Later steps start from the files: they do not repeat the lineage, read only the columns they need, survive
    lost executors, and Spark knows the real size when it chooses a join.
    """
    path = new_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller made."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once an application, so that they need no copy of it.

    Spark's file server hands the archive to every executor, also to those that join or come back later.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="fleetwarden-code-"), "fleetwarden.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
