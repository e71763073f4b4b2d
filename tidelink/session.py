"""Session construction and shared-folder handling."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: instants are UTC, AQE re-plans joins and
# coalesces/splits partitions at runtime (skew joins included).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # study folders hold many small files (markers, EDA): pack more of them
    # into one read task; large ECG files are split as usual
    "spark.sql.files.openCostInBytes": str(1 << 20),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidelink", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's required settings.

    On a cluster, leave ``master`` unset and let spark-submit decide; the
    local defaults are only for tests and the benchmark.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Pin the session time zone; operators assume UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


class NoSharedFolder(RuntimeError):
    """Raised on a cluster whose shared checkpoint folder is not named."""


# Folders made by each application, oldest first; see drop_scratch.
_MADE: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder. Where it is unset, a
    local master gets a folder of its own; any other master is an error, as
    its executors could not see one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidelink-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    made = f"{root.rstrip('/')}/{name or 'scratch'}-{uuid.uuid4().hex[:12]}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(made)
    return made


def scratch_made(spark: SparkSession) -> list[str]:
    """The scratch folders of this application that still stand, in order."""
    return list(_MADE.get(spark.sparkContext.applicationId, []))


def drop_scratch(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete scratch folders whose readers have all been executed."""
    known = _MADE.get(spark.sparkContext.applicationId, [])
    for folder in set(folders) & set(known):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        known.remove(folder)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage at a stage boundary: write the table as Parquet into the
    shared checkpoint folder and read it back (one pass; survives executor
    loss; never a local checkpoint; the reader gets real size statistics,
    so AQE can broadcast small stages).

    Used for the intermediate tables (marker windows, sessions, links) that
    several branches of a plan read, so they are computed once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "stage")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


__all__ = ["NoSharedFolder", "get_session", "ensure_conf", "scratch_dir", "scratch_made", "drop_scratch", "materialize"]
