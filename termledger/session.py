"""Session helpers: the shared work folder and steps written to it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, which all executors share: the one the
    cluster names in ``spark.checkpoint.dir``, else one below the warehouse.

    A warehouse on a local disk is shared in local mode only; on a cluster the
    setting is then missing, which is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    on_disk = "://" not in warehouse or warehouse.startswith("file:")
    if on_disk and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{warehouse.rstrip('/')}/_steps"


class StepFolder:
    """A private folder under the work folder for the rounds of one iteration.

    A round is written as Parquet and read back, which cuts the lineage and
    survives the loss of executors. Once a round is committed nothing reads the
    one before it, so it is removed unless the caller keeps all rounds. What is
    left, results may still read; it is removed when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str, keep: bool = False):
        self._spark = spark
        self._keep = keep
        self._root = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._round = 0

    def write(self, df: DataFrame, free: bool = False) -> DataFrame:
        """``free``: shuffle files go at once, which else stay until the driver
        happens to collect its garbage."""
        self._round += 1
        path = f"{self._root}/round-{self._round:03d}"
        df.write.mode("error").parquet(path)
        if self._round == 1:
            remove_at_end(self._spark, self._root)
        if self._round > 1 and not self._keep:
            remove(self._spark, f"{self._root}/round-{self._round - 1:03d}")
        if free:
            self._spark._jvm.System.gc()
        return self._spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one folder this process wrote."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have one folder deleted when the driver ends."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
