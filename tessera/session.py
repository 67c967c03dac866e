"""Session helpers that every part of the engine shares."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch on its way to a Python worker, unless the session sets its own.
BATCH_BYTES = 4 << 20
_BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b")
#: Bytes of a Parquet row group of a stored table.
ROW_GROUP = 32 << 20
#: Rows of a narrow table that joins may broadcast.
LIGHT = 1 << 18
ROOT = str(Path(__file__).resolve().parent.parent)


def attach(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the driver found it.

    On a cluster the package is installed on the nodes or shipped with ``--py-files``; in local
    runs the workers only need the folder on their path.
    """
    if spark.conf.get(*_BATCH_BYTES) == _BATCH_BYTES[1]:  # as Spark has it: whole texts need smaller batches
        spark.conf.set(_BATCH_BYTES[0], str(BATCH_BYTES))
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = ROOT + (os.pathsep + path if path else "")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the session names none a temporary one is set, in local mode; on a cluster that is an error.
    """
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        there = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(there)
    return there.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends here.

    The files outlive the loss of any executor. Row groups are small, so writers hold little memory.
    """
    path = f"{shared_dir(df.sparkSession)}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def light(df: DataFrame, rows: int) -> DataFrame:
    """For a join: sent to all executors if its few columns have no more than ``LIGHT`` rows."""
    return F.broadcast(df) if rows <= LIGHT else df


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables made by :func:`store`, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/tessera/" in path:
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
