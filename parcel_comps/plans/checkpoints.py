"""Where long jobs cut their lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into Parquet in the shared folder, so lost executors cost nothing upstream.

    Unlike a checkpoint it keeps column pruning, pushdown and statistics.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
