"""Readers and writers: typed tables, volumes by chunk, edge lists, histograms, agglomeration maps."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import parse_chunk_tag
from ..schema import TABLES


def read_table(spark: SparkSession, root: str, name: str, chunk_tag: str | None = None) -> DataFrame:
    """A table of the catalogue as Parquet with its fixed schema; an unwritten one is empty. A chunk tag prunes partitions."""
    path, jvm = f"{root}/{name}", spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        out = spark.createDataFrame([], TABLES[name])
    else:
        out = spark.read.schema(TABLES[name]).parquet(path)
    return out.where(F.col("chunk_tag") == chunk_tag) if chunk_tag is not None else out


def write_table(df: DataFrame, root: str, name: str, mode: str = "append") -> None:
    """Append, or overwrite; tables with a chunk tag are partitioned by it and only written chunks are replaced."""
    fields = TABLES[name].fieldNames()
    writer = df.select(*fields).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy("chunk_tag") if "chunk_tag" in fields else writer).parquet(f"{root}/{name}")


def write_together(frames: dict[str, DataFrame], root: str) -> str:
    """Several tables under one new version, visible only when all are written: the marker file comes last."""
    version = f"{root}/v-{uuid.uuid4().hex}"
    for name, df in frames.items():
        df.write.parquet(f"{version}/{name}")
    spark = next(iter(frames.values())).sparkSession
    spark.createDataFrame([(n,) for n in sorted(frames)], "name string").coalesce(1).write.parquet(f"{version}/_committed")
    return version


def read_csv(spark: SparkSession, paths: str | list[str], name: str) -> DataFrame:
    """One or many CSV files with a header, as one table of the catalogue."""
    return spark.read.schema(TABLES[name]).csv(paths, header=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def write_volume(voxels: DataFrame, path: str) -> None:
    """A sparse volume (x, y, z, val, chunk_tag), replacing the chunks that it has."""
    voxels.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk_tag").parquet(path)


def read_volume(spark: SparkSession, path: str, low=None, high=None) -> DataFrame:
    """A volume, or one box of it: whole chunks are pruned by their tags, then voxels by their coordinates. What is missing is background."""
    out = spark.read.parquet(path)
    if low is not None:
        b = parse_chunk_tag(F.col("chunk_tag"))
        for a, lo, hi in zip("xyz", low, high, strict=True):
            out = out.where((b["min"][a] < hi) & (b["max"][a] > lo)).where((F.col(a) >= lo) & (F.col(a) < hi))
    return out


def read_edge_csv(spark: SparkSession, path: str, only_confident: bool = False) -> DataFrame:
    """id;presyn;postsyn[;confident], where fields may be lists: a row for each combination."""
    raw = spark.read.schema("id string, presyn string, postsyn string, confident int").csv(path, sep=";")
    if only_confident:
        raw = raw.where("confident != 0")
    items = lambda c: F.from_json(F.when(F.trim(c).startswith("["), F.col(c)).otherwise(F.concat(F.lit("["), c, F.lit("]"))), "array<bigint>")
    out = raw.select(F.trim("id").cast("long").alias("id"), F.explode(items("presyn")).alias("presyn"), "postsyn")
    return out.select("id", "presyn", F.explode(items("postsyn")).alias("postsyn"))


def write_edge_csv(edges: DataFrame, path: str) -> None:
    edges.select("id", "presyn", "postsyn").write.csv(path, sep=";")


def read_histograms(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """z, level, n of JSON files named by z ({"levels": [...]}) for low <= z < high; a missing section has nulls."""
    raw = spark.read.schema("levels array<bigint>").json(path).select(F.regexp_extract(F.col("_metadata.file_path"), r"(\d+)[^/]*$", 1).cast("long").alias("z"), F.posexplode("levels").alias("level", "n"))
    return spark.range(low, high).withColumnRenamed("id", "z").join(raw, "z", "left")


def read_agglomeration(spark: SparkSession, path: str) -> DataFrame:
    """mip, src_id, dst_id of zstd files of unsigned 64-bit pairs; the mip is the number at the end of the file's name."""
    import zstandard

    raw = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"(\d+)[^/\d]*$", 1).cast("int").alias("mip"), "content")

    def parse(frames):
        for frame in frames:
            for mip, content in zip(frame["mip"], frame["content"], strict=True):
                pairs = np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(content), "<u8").reshape(-1, 2).astype("i8")
                yield pd.DataFrame({"mip": mip, "src_id": pairs[:, 0], "dst_id": pairs[:, 1]})

    return raw.mapInPandas(parse, "mip int, src_id long, dst_id long")


def agglomerate(voxels: DataFrame, maps: DataFrame, column: str, mips: int) -> DataFrame:
    """Voxel ids through the maps of each mip in order; the maps are composed before the voxels are touched."""
    from ..operators import idmaps

    whole = None
    for m in range(mips + 1):
        own = maps.where(F.col("mip") == m).select("src_id", "dst_id")
        if whole is None:
            whole = own
        else:  # ids that no earlier map has go through this one directly
            whole = idmaps.compose(whole, own, reused_ids=True).unionByName(own.join(whole.select("src_id"), "src_id", "left_anti"))
    return idmaps.apply(voxels, whole, column)


def log_timing(spark: SparkSession, root: str, task: str, tag: str, seconds: float) -> None:
    write_table(spark.createDataFrame([(task, tag, float(seconds))], TABLES["timing_log"]), root, "timing_log")


def parse_uri(uri: str) -> tuple[str, str, str]:
    """Scheme, bucket or host, and key; a plain path has empty scheme and host."""
    scheme, mark, rest = uri.partition("://")
    if not mark:
        return "", "", uri
    host, _, key = rest.partition("/")
    return scheme, host, key


def is_database(uri: str) -> bool:
    return parse_uri(uri)[0].split("+")[0] in {"postgresql", "postgres", "mysql", "sqlite", "oracle", "mssql", "jdbc"}
