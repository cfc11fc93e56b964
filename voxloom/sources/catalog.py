"""The catalogue of tables: creation, dropping, the chunk table, layout for lookups, versions written together, models."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TABLES


def create_tables(spark: SparkSession, database: str) -> list[str]:
    """Create a database with every table of the catalogue, empty; tables that exist stay as they are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        layout = "PARTITIONED BY (chunk_tag)" if "chunk_tag" in schema.fieldNames() else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {layout}")
    return sorted(TABLES)


def drop_tables(spark: SparkSession, database: str) -> None:
    """Drop the catalogue's tables and their database; what is not there is no error."""
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(f"DROP DATABASE IF EXISTS {database}")


def fill_chunks(grid: DataFrame, database: str) -> None:
    """Write a chunk grid (begin_*, end_*, chunk_tag) into the chunk table."""
    grid.select(*TABLES["chunks"].fieldNames()).write.insertInto(f"{database}.chunks", overwrite=True)


def write_bucketed(df: DataFrame, table: str, buckets: int, *columns: str) -> None:
    """A managed table bucketed and sorted by columns, which joins and lookups on them read without a shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(table)


def create_volume(spark: SparkSession, path: str, kind: str = "long") -> None:
    """An empty volume (x, y, z, val, chunk_tag), which write_volume() fills chunk by chunk."""
    empty = spark.createDataFrame([], f"x long, y long, z long, val {kind}, chunk_tag string")
    empty.write.mode("ignore").partitionBy("chunk_tag").parquet(path)


def grid_check(begins: DataFrame) -> DataFrame:
    """chunks, and whether distinct begins (begin_x, begin_y, begin_z) fill a grid."""
    axes = [F.count_distinct(f"begin_{a}").alias(f"n{a}") for a in "xyz"]
    seen = begins.agg(F.count_distinct("begin_x", "begin_y", "begin_z").alias("chunks"), *axes)
    return seen.select("chunks", *(f"n{a}" for a in "xyz"), (F.col("chunks") == F.col("nx") * F.col("ny") * F.col("nz")).alias("complete"))


def read_together(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the last version that write_together() completed; versions without a marker are not seen."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{root}/v-*/_committed/_SUCCESS")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place) or []
    done = sorted((f.getModificationTime(), f.getPath().getParent().getParent().toString()) for f in files)
    if not done:
        raise FileNotFoundError(f"no complete version in {root}")
    return spark.read.parquet(f"{done[-1][1]}/{name}")


def write_model(spark: SparkSession, model: Callable, path: str) -> None:
    """A scorer (any picklable callable) as one row of a Parquet table, on any file system."""
    spark.createDataFrame([(bytearray(pickle.dumps(model)),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)


def read_model(spark: SparkSession, path: str) -> Callable:
    """A scorer that write_model() wrote. Unpickling runs code: read only models that you wrote."""
    return pickle.loads(bytes(spark.read.parquet(path).first()["model"]))


def required_chunks(low: tuple[int, int, int], high: tuple[int, int, int], chunk: tuple[int, int, int], mips: int) -> list[tuple[int, int, int, int]]:
    """(mip, x, y, z) of the agglomeration chunks that a box touches; a chunk doubles with each mip."""
    out = []
    for mip in range(mips + 1):
        size = [c << mip for c in chunk]
        spans = [range(a // s, -(-b // s)) for a, b, s in zip(low, high, size, strict=True)]
        out += [(mip, x, y, z) for x in spans[0] for y in spans[1] for z in spans[2]]
    return out
