"""Overlap tables (row_id, col_id, vals): counting, consolidation, arg-max."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count(voxels: DataFrame, rows: str, cols: str, keys: list[str] | None = None) -> DataFrame:
    both = voxels.where((F.col(rows) != 0) & (F.col(cols) != 0))
    return both.groupBy(*(keys or []), F.col(rows).alias("row_id"), F.col(cols).alias("col_id")).agg(F.count("*").alias("vals"))


def consolidate(overlaps: DataFrame) -> DataFrame:
    return overlaps.groupBy("row_id", "col_id").agg(F.sum("vals").alias("vals"))


def largest(overlaps: DataFrame, by: str = "row_id", of: str = "col_id") -> DataFrame:
    """The column of the largest overlap of each row; the smallest id of equals. A partial aggregate, so no row's overlaps meet in memory."""
    best = F.max(F.struct(F.col("vals"), (-F.col(of)).alias("__less")))
    return overlaps.groupBy(by).agg(best.alias("b")).select(by, (-F.col("b.__less")).alias(of), F.col("b.vals").alias("vals"))


def attach(segments: DataFrame, best: DataFrame, key: str, out: str) -> DataFrame:
    """Segments with the id they overlap most; null without overlap."""
    return segments.join(best.select(F.col("row_id").alias(key), F.col("col_id").alias(out)), key, "left")
