"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tidewell",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    On a cluster ``master`` stays None and the submitter's settings win; the
    defaults only fill keys that are not set already.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and derived tables.

    Read ``spark.checkpoint.dir`` from the session (what a cluster names);
    only when it is unset on a local master (tests) create a scratch folder and
    register it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidewell-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stored_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes under ``path`` on the file system it names; None where nothing is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else None


def state_of(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(files, bytes, last change) of a table's path: other data under it give another state."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return 0, 0, 0
    total = fs.getContentSummary(p)
    last = max([s.getModificationTime() for s in fs.listStatus(p)], default=0)
    return total.getFileCount(), total.getLength(), last


def _scratch(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), "tables", spark.sparkContext.applicationId)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files of this application under the shared folder."""
    return os.path.join(_scratch(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts lineage (survives executor loss without recomputing the parent plan)
    and gives the planner a file-size statistic, so joins against small
    derived tables are broadcast only when their measured size allows. The
    tables of an application lie in one folder; see ``drop_materialised``.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_materialised(spark: SparkSession) -> None:
    """Remove what ``materialise`` wrote in this application, once its results are written elsewhere."""
    p = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
