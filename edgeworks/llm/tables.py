"""Access to the corpus tables and to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgeworks.sources.checkpoint import checkpoint, ensure_checkpoint_dir, temporary
from edgeworks.sources.package import ship

__all__ = ["checkpoint", "ensure_checkpoint_dir", "read", "stored"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """df from a Parquet copy in the shared checkpoint folder: smaller than a checkpoint, but without its order of rows and partitions. It goes when the application ends."""
    path = temporary(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
