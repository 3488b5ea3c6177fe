"""The folder that the driver and all executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is the cluster's ``spark.checkpoint.dir``. Only where that is unset (tests,
    one machine) a temporary folder is made and set for the session.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.wayfold.shared.dir", None)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = "file://" + tempfile.mkdtemp(prefix="wayfold-")
        spark.conf.set("spark.wayfold.shared.dir", path)
        _delete_on_exit(spark, path)
    return path.rstrip("/")


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _delete_on_exit(spark, path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there.

    Unlike checkpoint() it runs the plan once, keeps columns prunable, and survives
    lost executors since no block lives on one machine only.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
