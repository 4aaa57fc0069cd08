"""Places below the folder that driver and executors share (`spark.checkpoint.dir`)."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_STAGED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors; if the session names none, a private one in local mode, else an error."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="lattica-")
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; `clear_staged` removes it."""
    path = f"{shared_dir(spark)}/lattica/{label}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Remove what `staged` and `new_path` have left; results still to be read from them are lost."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _at_exit() -> None:
    try:
        spark = SparkSession.getActiveSession()
        if spark is not None and _STAGED:
            clear_staged(spark)
    except Exception:  # the session may be gone already
        pass
