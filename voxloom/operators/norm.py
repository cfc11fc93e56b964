"""Contrast: clamp levels of section histograms, and the lookup that they define."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clamps(histograms: DataFrame, low: float, high: float) -> DataFrame:
    """z, lo, hi: the level before that at which the cumulative share passes low and high. Level 0 counts nothing; an empty section gives (0, 0). histograms: z, level, n, without repeated levels."""
    h = histograms.withColumn("n", F.when(F.col("level") == 0, F.lit(0)).otherwise(F.col("n")))
    total = F.sum("n").over(Window.partitionBy("z"))
    run = F.sum("n").over(Window.partitionBy("z").orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    share = F.try_divide(run, total)
    first = lambda f: F.coalesce(F.min(F.when(F.col("share") > f, F.col("level"))) - 1, F.lit(0)).cast("long")
    return h.withColumn("share", share).groupBy("z").agg(first(low).alias("lo"), first(high).alias("hi"))


def lut(level: Column, lo: Column, hi: Column, least: int, most: int) -> Column:
    """level stretched to [least, most], clipped and rounded half to even; unchanged where hi and lo are equal."""
    scaled = F.try_divide((level - lo).cast("double"), (hi - lo).cast("double")) * most
    shown = F.bround(F.greatest(F.lit(least).cast("double"), F.least(F.lit(most).cast("double"), scaled))).cast("long")
    return F.when(scaled.isNull(), level.cast("long")).otherwise(shown)


def normalize(voxels: DataFrame, histograms: DataFrame, column: str, low: float, high: float, least: int = 1, most: int = 255) -> DataFrame:
    """Voxels with column replaced; sections are few, so their clamps join by z."""
    return voxels.join(clamps(histograms, low, high), "z", "left").withColumn(column, F.coalesce(lut(F.col(column), F.col("lo"), F.col("hi"), least, most), F.col(column).cast("long"))).drop("lo", "hi")
