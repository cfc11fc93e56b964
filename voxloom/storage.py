"""Written intermediate tables: the lineage cut used by the iterative and multi-pass operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session.

    Where it is unset (tests, a laptop) a local temporary folder is made and set, which is right
    for local mode only.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="voxloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lost executors lose none of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, kind: str, name: str) -> Callable[[str, list[str]], DataFrame]:
    """Write df as written() does, rows of each value of column kind in a folder of their own; gives these columns of the rows of one value."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(kind).parquet(path)

    def of(value: str, columns: list[str]) -> DataFrame:
        own, system = _folder(spark, f"{path}/{kind}={value}")
        system.mkdirs(own)  # a value without rows has none
        return spark.read.schema(df.select(*columns).schema).parquet(f"{path}/{kind}={value}")

    return of


def drop(df: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        folder, system = _folder(df.sparkSession, name)
        system.delete(folder, True)


def _folder(spark: SparkSession, name: str) -> tuple:
    """Hadoop's path of a folder, and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def scan_partitions(df: DataFrame) -> int:
    """Tasks that a plain scan of df takes; it grows with the input."""
    return max(1, df.rdd.getNumPartitions())
