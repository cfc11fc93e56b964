"""Plug-in scorers: patch locations, voxels near a cleft, scores by any Python callable."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import POST, PRE, SEGMENT
from . import edges as E
from .voxels import describe, diamond


def random_locations(voxels: DataFrame, column: str, k: int, seed: int = 0) -> DataFrame:
    """k voxels of each id in an order that only the seed and the coordinates decide."""
    order = Window.partitionBy(column).orderBy(F.xxhash64(F.lit(seed), "x", "y", "z"), "x", "y", "z")
    return voxels.where(F.col(column) != 0).withColumn("sample", F.row_number().over(order)).where(F.col("sample") <= k).select(column, "sample", "x", "y", "z")


def centroid_locations(voxels: DataFrame, column: str) -> DataFrame:
    """The rounded centroid of each id, as its one sample."""
    centre = describe(voxels, column)
    return centre.select(column, F.lit(1).alias("sample"), *(F.col(f"centroid_{a}").alias(a) for a in "xyz"))


def centre_locations(voxels: DataFrame, column: str, volume: tuple[int, int, int]) -> DataFrame:
    """The middle of the volume for each id."""
    ids = voxels.where(F.col(column) != 0).select(column).distinct()
    return ids.select(column, F.lit(1).alias("sample"), *(F.lit(v // 2).cast("long").alias(a) for a, v in zip("xyz", volume, strict=True)))


def covering_locations(voxels: DataFrame, column: str, shape: tuple[int, int, int], volume: tuple[int, int, int], seed: int = 0) -> DataFrame:
    """Samples of each id whose patches cover all its voxels; an id's voxels, those of one cleft in a chunk, meet in one task.

    Of the voxels not covered yet the next sample is the first in an order that only the seed and the
    coordinates decide. Patches lie in the volume, so a voxel outside it is an error.
    """
    size, whole = np.array(shape), np.array(volume)
    order = F.struct(F.xxhash64(F.lit(seed), "x", "y", "z"), "x", "y", "z")
    rows = voxels.where(F.col(column) != 0).groupBy(column).agg(F.sort_array(F.collect_list(order)).alias("__at"))
    rows = rows.select(column, *(F.col(f"__at.{a}").cast("array<long>").alias(a) for a in "xyz"))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for row in batch.to_pylist():
                points = np.array([row[a] for a in "xyz"]).T
                if (points < 0).any() or (points >= whole).any():
                    raise ValueError(f"{column} {row[column]} has a voxel outside the volume {volume}, which no patch can cover")
                sample = 0
                while len(points):
                    begin = points[0] - size // 2
                    begin = begin + np.maximum(0, -begin) - np.maximum(0, begin + size - whole)
                    sample += 1
                    ids.append(row[column])
                    found.append((sample, *points[0].tolist()))
                    points = points[~((points >= begin) & (points < begin + size)).all(1)]
            parts = zip(*found, strict=True) if found else ((),) * 4
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(parts, types, strict=True))], [column, "sample", "x", "y", "z"])

    return rows.mapInArrow(cover, f"{column} long, sample int, x long, y long, z long")


def locations(voxels: DataFrame, column: str, kind: str, shape: tuple[int, int, int], volume: tuple[int, int, int], samples: int = 1, seed: int = 0) -> DataFrame:
    """Samples of each id by kind: centroid, random, coverage or center."""
    if kind == "centroid":
        return centroid_locations(voxels, column)
    if kind == "random":
        return random_locations(voxels, column, samples, seed)
    if kind == "coverage":
        return covering_locations(voxels, column, shape, volume, seed)
    if kind == "center":
        return centre_locations(voxels, column, volume)
    raise ValueError(f"no such kind of location: {kind}")


def patches(where: DataFrame, voxels: DataFrame, shape: tuple[int, int, int], volume: tuple[int, int, int], key: str = SEGMENT) -> DataFrame:
    """Voxels of the box of that shape around each sample, moved into the volume: columns of voxels with the key and sample.

    The box meets the voxels by blocks of its shape, of which it touches eight at most.
    """
    box = where.select(key, "sample", *((F.col(a) - n // 2).alias(f"__b{a}") for a, n in zip("xyz", shape, strict=True)))
    for a, n, v in zip("xyz", shape, volume, strict=True):
        b = F.col(f"__b{a}")
        box = box.withColumn(f"__b{a}", (b + F.greatest(F.lit(0), -b) - F.greatest(F.lit(0), b + n - v)).cast("long"))
    for a, n in zip("xyz", shape, strict=True):
        box = box.withColumn(f"__k{a}", F.explode(F.sequence(F.floor(F.col(f"__b{a}") / n).cast("long"), F.floor((F.col(f"__b{a}") + n - 1) / n).cast("long"))))
    keyed = voxels.select("*", *(F.floor(F.col(a) / n).cast("long").alias(f"__k{a}") for a, n in zip("xyz", shape, strict=True)))
    out = box.join(keyed, [f"__k{a}" for a in "xyz"])
    for a, n in zip("xyz", shape, strict=True):
        out = out.where((F.col(a) >= F.col(f"__b{a}")) & (F.col(a) < F.col(f"__b{a}") + n))
    return out.select(key, "sample", *voxels.columns)


def close_in_patches(found: DataFrame, k: int, key: str = SEGMENT) -> DataFrame:
    """Distinct (key, sample, segid) with a voxel in the patch within the diamond of radius k over three sections around a voxel of the key's cleft. found: patches() with cleft and segid."""
    move = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(z).alias("z")) for x, y, _ in diamond(k) for z in (-1, 0, 1)]))
    grown = found.where(F.col("cleft") == F.col(key)).select(key, "sample", "x", "y", "z", move.alias("m"))
    grown = grown.select(key, "sample", *((F.col(a) + F.col(f"m.{a}")).alias(a) for a in "xyz")).distinct()
    return found.where("segid != 0").join(grown, [key, "sample", "x", "y", "z"]).select(key, "sample", "segid").distinct()


def infer_patches(found: DataFrame, network: Callable[[pd.DataFrame], tuple[pd.Series, pd.Series]], key: str = SEGMENT) -> DataFrame:
    """found with pre and post, a network's output for each voxel of a patch (rows in order of z, y, x; val is divided by 255, cleft is whether the voxel is the key's)."""
    schema = f"{key} long, sample int, x long, y long, z long, segid long, pre double, post double"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["z", "y", "x"])
        pre, post = network(rows.assign(val=rows["val"] / 255.0, cleft=rows["cleft"] == rows[key]))
        return rows.assign(pre=pre.astype(float), post=post.astype(float))[[key, "sample", "x", "y", "z", "segid", "pre", "post"]]

    return found.groupBy(key, "sample").applyInPandas(run, schema)


def infer_weights(voxels: DataFrame, where: DataFrame, network: Callable, shape: tuple[int, int, int], volume: tuple[int, int, int], k: int = 5, key: str = SEGMENT) -> DataFrame:
    """Sums of a network's output over samples: key, segid, pre, post, sz, pre_mean, post_mean, loc.

    voxels: x, y, z, val, cleft, segid. where: locations(). A segment counts in a patch where it
    comes close to the cleft; loc is its first voxel (by x, y, z) in the last such patch. A cleft
    without a close segment has no row.
    """
    found = patches(where, voxels, shape, volume, key)
    output = infer_patches(found, network, key).join(close_in_patches(found, k, key), [key, "sample", "segid"])
    by_patch = output.groupBy(key, "sample", "segid").agg(F.sum("pre").alias("pre"), F.sum("post").alias("post"), F.count("*").alias("sz"), F.min(F.struct("x", "y", "z")).alias("at"))
    return accumulate(by_patch.select(key, "segid", "sample", "pre", "post", "sz", "at.*"))


def side_scores(weights: DataFrame, kind: str = "avg", alpha: float = 1.0, pre_kind: str | None = None, post_kind: str | None = None, key: str = SEGMENT) -> DataFrame:
    """weights with pre_score and post_score: avg, sum, sum mix (alpha of the mean, the rest of the sum) or size mix (the rest of the segment's share of voxels)."""
    share = F.col("sz") / F.sum("sz").over(Window.partitionBy(key))
    out = weights
    for side, own in (("pre", pre_kind or kind), ("post", post_kind or kind)):
        mean, total = F.col(f"{side}_mean"), F.col(side)
        kinds = {"avg": mean, "sum": total, "sum mix": E.mix(mean, total, alpha), "size mix": E.mix(mean, share, alpha)}
        if own not in kinds:
            raise ValueError(f"no such kind of score: {own}")
        out = out.withColumn(f"{side}_score", kinds[own])
    return out


def infer_edges(weights: DataFrame, assign: str = "max", threshold: float | None = None, threshold2: float | None = None, kind: str = "avg", alpha: float = 1.0, pre_kind: str | None = None, post_kind: str | None = None, key: str = SEGMENT, roots: DataFrame | None = None) -> DataFrame:
    """Edge records of infer_weights(): key, partners, their places, scores and sizes, and with roots (x, y, z, root) the root ids there.

    assign: max (the best of each side), thresh (all pairs over threshold; the pre side falls back to
    its best) or double thresh (threshold2 for the post side).
    """
    scored = side_scores(weights, kind, alpha, pre_kind, post_kind, key)
    if assign == "max":
        pairs = E.assign_by_max(scored, "pre_score", "post_score", key)
    elif assign in ("thresh", "double thresh"):
        pairs = E.assign_by_threshold(scored, threshold, threshold2 if assign == "double thresh" else None, "pre_score", "post_score", key)
    else:
        raise ValueError(f"no such assignment: {assign}")
    out = pairs
    for side, partner in (("pre", PRE), ("post", POST)):
        own = scored.select(key, F.col("segid").alias(partner), *(F.col(f"loc.{a}").alias(f"{side}syn_{a}") for a in "xyz"), F.col(f"{side}_score").alias(f"{side}syn_wt"), F.col("sz").alias(f"{side}syn_sz"))
        out = out.join(own, [key, partner])
        if roots is not None:
            out = out.join(roots.select(*(F.col(a).alias(f"{side}syn_{a}") for a in "xyz"), F.col("root").alias(f"{side}syn_basin")), [f"{side}syn_{a}" for a in "xyz"], "left")
    order = [key, PRE, POST, *(f"{s}syn_{a}" for s in ("pre", "post") for a in "xyz"), "presyn_wt", "postsyn_wt", "presyn_sz", "postsyn_sz"]
    return out.select(*order, *(["presyn_basin", "postsyn_basin"] if roots is not None else []))


def max_candidates(scored: DataFrame, key: str = SEGMENT) -> DataFrame:
    """The candidate of the greatest score of each key; of equals the one with the least partners."""
    best = F.min(F.struct((-F.col("score")).alias("s"), PRE, POST))
    return scored.groupBy(key).agg(best.alias("b")).select(key, f"b.{PRE}", f"b.{POST}", (-F.col("b.s")).alias("score"))


def close_segments(clefts: DataFrame, segments: DataFrame, k: int) -> DataFrame:
    """Distinct (cleft_segid, segid) where the segment has a voxel within the diamond of radius k over three sections around a cleft voxel."""
    offsets = F.explode(F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy"), F.lit(z).alias("dz")) for x, y, _ in diamond(k) for z in (-1, 0, 1)]))
    grown = clefts.select("cleft_segid", "x", "y", "z", offsets.alias("o")).select("cleft_segid", (F.col("x") + F.col("o.dx")).alias("x"), (F.col("y") + F.col("o.dy")).alias("y"), (F.col("z") + F.col("o.dz")).alias("z")).distinct()
    return grown.join(segments.where("segid != 0"), ["x", "y", "z"]).select("cleft_segid", "segid").distinct()


def score(rows: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series], out: str = "score") -> DataFrame:
    """rows with a column of scores by a callable on Arrow batches."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + f", {out} double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{out: scorer(batch).astype(float)})

    return rows.mapInPandas(run, schema)


def prune(candidates: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series], threshold: float) -> DataFrame:
    return score(candidates, scorer).where(F.col("score") > threshold)


def accumulate(samples: DataFrame) -> DataFrame:
    """Sums over samples: cleft_segid, segid, pre, post, sz, mean weights, and the last sample's place."""
    last = F.max_by(F.struct("x", "y", "z"), F.col("sample"))
    return samples.groupBy("cleft_segid", "segid").agg(F.sum("pre").alias("pre"), F.sum("post").alias("post"), F.sum("sz").alias("sz"), (F.sum("pre") / F.sum("sz")).alias("pre_mean"), (F.sum("post") / F.sum("sz")).alias("post_mean"), last.alias("loc"))
