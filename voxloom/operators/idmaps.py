"""Id maps (src_id, dst_id): apply, compose, expand, threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def apply(df: DataFrame, id_map: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """column mapped; unmapped values stay. keys: further columns that both have, such as a chunk tag."""
    on = [*(keys or []), column]
    named = id_map.withColumnRenamed("src_id", column).withColumnRenamed("dst_id", "__dst")
    return df.join(named, on, "left").withColumn(column, F.coalesce("__dst", column)).select(df.columns)


def apply_strict(df: DataFrame, id_map: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """column mapped; an unmapped value is an error."""
    on = [*(keys or []), column]
    named = id_map.withColumnRenamed("src_id", column).withColumnRenamed("dst_id", "__dst")
    found = F.when(F.col("__dst").isNotNull(), F.col("__dst")).otherwise(F.raise_error(F.lit("an id is not in the map")).cast("long"))
    return df.join(named, on, "left").withColumn(column, found).select(df.columns)


def apply_paired(df: DataFrame, pair_map: DataFrame, first: str, second: str, out: str) -> DataFrame:
    """out: the id that pair_map (first, second, dst_id) gives a pair; 0 if it has none."""
    return df.join(pair_map.withColumnRenamed("dst_id", out), [first, second], "left").withColumn(out, F.coalesce(out, F.lit(0)))


def compose(first: DataFrame, then: DataFrame, reused_ids: bool = False) -> DataFrame:
    """then after first. Unless ids are reused, rows of then whose source is no value of first are added; they win over first."""
    step = first.join(then.select(F.col("src_id").alias("dst_id"), F.col("dst_id").alias("__next")), "dst_id", "left").select("src_id", F.coalesce("__next", "dst_id").alias("dst_id"))
    if reused_ids:
        return step
    added = then.join(first.select(F.col("dst_id").alias("src_id")).distinct(), "src_id", "left_anti").select("src_id", "dst_id")
    return step.join(added, "src_id", "left_anti").unionByName(added)


def expand(id_map: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """A row for every id: the map's, or the id itself."""
    return ids.select(F.col(column).alias("src_id")).distinct().join(id_map, "src_id", "left").select("src_id", F.coalesce("dst_id", "src_id").alias("dst_id"))


def overlay(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the non-null cells of new."""
    rest = [c for c in old.columns if c != key]
    named = new.select(key, *(F.col(c).alias(f"__{c}") for c in rest if c in new.columns))
    return old.join(named, key, "left").select(key, *(F.coalesce(f"__{c}", c).alias(c) if c in new.columns else F.col(c) for c in rest))


def filtered(id_map: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the map whose source is a key."""
    return id_map.join(keys.select("src_id").distinct(), "src_id", "left_semi")


def by_size(segments: DataFrame, threshold: int, key: str = "cleft_segid") -> tuple[DataFrame, DataFrame]:
    """Segments of threshold voxels at least, and a map of the others to 0."""
    small = F.col("size") < threshold
    return segments.where(~small), segments.where(small).select(F.col(key).alias("src_id"), F.lit(0).cast("long").alias("dst_id"))


def serial_ids(df: DataFrame, chunk: list[str], key: str, out: str = "new_id") -> DataFrame:
    """Ids from 1 over chunks in order of chunk, and by key inside each.

    Counts by chunk are summed over the chunk table; rows are numbered inside their chunk, so only
    the chunk table meets in one task.
    """
    counts = df.groupBy(*chunk).count()
    before = counts.withColumn("__before", F.coalesce(F.sum("count").over(Window.orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    own = F.row_number().over(Window.partitionBy(*chunk).orderBy(key))
    return df.withColumn("__own", own).join(before, chunk).withColumn(out, F.col("__before") + F.col("__own")).drop("__before", "__own")


def dense_ids(df: DataFrame, key: list[str], out: str) -> DataFrame:
    """Ids from 1 in order of key over distinct keys, joined back. Ids are dealt by range, so that no task numbers all keys."""
    keys = df.select(*key).distinct().repartitionByRange(*key).sortWithinPartitions(*key).withColumn("__part", F.spark_partition_id())
    from ..storage import written

    keys = written(keys, "keys")
    ids = serial_ids(keys.withColumn("__key", F.struct(*key)), ["__part"], "__key", out).drop("__part", "__key")
    return df.join(ids, key)
