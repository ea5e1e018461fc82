"""Folders that jobs share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A path that is not taken yet, in the folder that all executors share."""
    set_checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def set_checkpoint_folder(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``.

    Where none is named, local mode gets a temporary folder and a cluster an error: its
    executors would each write to their own disk."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="checkpoints-")
        atexit.register(shutil.rmtree, named, True)
    sc.setCheckpointDir(named)


def materialized(df: DataFrame) -> DataFrame:
    """``df`` computed once, without its lineage, in the folder that executors share."""
    set_checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table of packed columns in the folder that executors share: a fraction of a checkpoint's bytes."""
    path = shared_path(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
