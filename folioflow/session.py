"""Session factory and the two ways this library cuts lineage (never a local checkpoint)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "folioflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE with skew handling, Arrow on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    return b.config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it. Where none is set, a local session takes a
    temporary one; on a cluster that would be each machine's own disk, so there it is an error."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir()
    if at is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            at = "file://" + os.path.join(tempfile.gettempdir(), "folioflow-checkpoints")
        sc.setCheckpointDir(at)
        at = sc.getCheckpointDir()
    return at


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small or numeric frame: survives executor loss and ends the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back: compressed, columnar, survives
    executor loss. Used instead of a checkpoint where the frame holds text. ``discard`` deletes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


_STAGED: list[str] = []


def discard(spark: SparkSession) -> int:
    """Delete the tables that ``stage`` wrote in this process, once no frame reads them any more; gives their
    number. Checkpoints go when their frames do (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    jvm = spark.sparkContext._jvm
    n = len(_STAGED)
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n
