"""Session defaults and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "annolytics", cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the engine's defaults; on a cluster the caller's session is used as it is."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where none is set, a temporary one, on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "annolytics-checkpoints")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


#: Folders of the tables this process wrote and didn't delete, by session.
_WRITTEN: dict[str, list[str]] = {}


def persist_table(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts the lineage and survives lost executors.

    `forget` deletes a table that nothing reads any more, `clean` all that are left of the session's application."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/annolytics-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._annolytics_path = path
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def forget(*tables: DataFrame) -> None:
    """Delete tables written by persist_table; data frames that weren't are left alone."""
    for df in tables:
        path = getattr(df, "_annolytics_path", None)
        if path:
            _delete(df.sparkSession, path)
            _WRITTEN.get(df.sparkSession.sparkContext.applicationId, []).remove(path)
            df._annolytics_path = None


def clean(spark: SparkSession) -> int:
    """Delete all tables that persist_table wrote in this application and that are left; gives their number. Results
    that weren't written elsewhere can't be read afterwards."""
    left = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in left:
        _delete(spark, path)
    return len(left)
