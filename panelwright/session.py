"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Size-checked broadcasts and skew handling are left to the optimiser: no join in this
# package carries a broadcast hint, so a side is only ever broadcast after Spark has
# compared its estimated (or, under AQE, measured) size with these thresholds.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "panelwright", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="panelwright-")


def shared_folder(spark: SparkSession) -> str:
    """A fresh path under the cluster's shared folder (``spark.checkpoint.dir``).

    Where the setting is missing a local folder is used if the master is local, since driver
    and tasks then share it; on a cluster each executor would write to its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir is not set, and {master} has no folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/panelwright-{uuid.uuid4().hex}"


def files_under(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of every file of a folder, or of the file itself; none if there is nothing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, listed = [], fs.listFiles(place, True) if fs.exists(place) else None
    while listed is not None and listed.hasNext():
        f = listed.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
