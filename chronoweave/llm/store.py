"""Where stages keep what must outlive an executor: the folder all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where that is unset (local tests)."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="chronoweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


_MADE: set[str] = set()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; ``clear`` deletes it once nothing reads it any more."""
    path = f"{shared_dir(spark).rstrip('/')}/chronoweave/{name}-{uuid.uuid4().hex}"
    _MADE.add(path)
    return path


def clear(spark: SparkSession) -> None:
    """Deletes the tables this process has written in the shared folder. Results that still read them must be written before."""
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Ends the lineage of a narrow table in the shared folder, so that no later stage computes it again."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes a table of blobs as Parquet in the shared folder and reads it back with the same schema."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
