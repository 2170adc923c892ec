"""Cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder the cluster names in spark.checkpoint.dir. Only a local session, whose tasks share the driver's disk, may go without and gets a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="corpusloom-ckpt-"))


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fenced(df: DataFrame) -> DataFrame:
    """The same rows, with columns that are computed once where cut() can't be used, as in a stream. A filter isn't pushed through columns that
    aren't deterministic; else its condition holds all that they are computed from, once for each use, and the columns are computed again above it."""
    return df.withColumn("_fence", F.rand()).filter("_fence >= 0").drop("_fence")


class Scratch:
    """Tables of a loop, written to the shared folder. A checkpoint hands the partitioning and the constraints of its plan on, which
    grow with every round; a table that is read again has neither. free() deletes those that later rounds don't need."""

    def __init__(self, spark: SparkSession):
        ensure_checkpoint_dir(spark)
        self.spark, self.base, self.paths = spark, f"{spark.sparkContext.getCheckpointDir()}/loop-{uuid.uuid4().hex}", {}

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[len(self.paths)] = (out, path)
        return out

    def free(self, *tables: DataFrame) -> None:
        for out, path in self.paths.values():
            if any(out is t for t in tables):
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
