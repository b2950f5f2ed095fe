"""The shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in spark.checkpoint.dir; only where it is unset (tests) take a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-checkpoint-"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and cut its lineage; the copy outlives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def temporary(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder; what is there goes when the application ends."""
    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}")
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{folder.toString()}/data"


def written(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict[str, object]]:
    """df from a Parquet copy in the shared checkpoint folder, and aggregates of it, observed in the run that writes it: one job, one reading."""
    path = temporary(df.sparkSession, "written")
    seen = Observation()
    (df.observe(seen, *[m.alias(name) for name, m in metrics.items()]) if metrics else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get if metrics else {}
