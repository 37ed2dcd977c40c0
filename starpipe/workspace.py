"""Durable intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Of all tables the library writes: ids and amounts take much less room than with Spark's default.
CODEC = "zstd"

_RUN = uuid.uuid4().hex


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set as the context's checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")


def clear_run(spark: SparkSession) -> None:
    """Delete what this process wrote to the shared folder; its DataFrames can't be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/starpipe/{_RUN}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/starpipe/{_RUN}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, survives lost executors, stays columnar.

    The files outlive the session (a reader may still hold the DataFrame) until ``clear_run``.
    """
    path = new_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
