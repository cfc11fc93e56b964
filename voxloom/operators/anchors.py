"""Anchor points: for each cleft a place on each partner, near the cleft and well inside the partner."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import POST, PRE, SEGMENT

NO_PARTNER, NOT_FOUND = -1, -2


def _nearest(points: np.ndarray, to, scale: np.ndarray) -> np.ndarray:
    """The point nearest to a place; the first of equals."""
    return points[np.argmin((((points - np.asarray(to, float)) * scale) ** 2).sum(1))]


def place(cleft: np.ndarray, partner: np.ndarray, low: np.ndarray, high: np.ndarray, width: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A point of partner. All points are rows in order of x, y, z; low and high bound the box that they come from.

    The nearest points of the two are sought in turn until neither moves; then the partner's voxels
    in a box of that width around the point give a centroid, and the voxel next to it is the anchor.
    """
    here, there = cleft[0], partner[0]
    while True:
        to = _nearest(partner, here, scale)
        back = _nearest(cleft, to, scale)
        if (to == there).all() and (back == here).all():
            break
        here, there = back, to
    begin = there - width // 2
    begin = begin + np.maximum(0, low - begin) - np.maximum(0, begin + width - high)
    local = partner[((partner >= np.maximum(begin, low)) & (partner < begin + width)).all(1)]
    return _nearest(local, local.mean(0), scale)


def place_anchors(clefts: DataFrame, segments: DataFrame, edges: DataFrame, volume: tuple[int, int, int], width: tuple[int, int, int] = (100, 100, 5), resolution=(4, 4, 40)) -> DataFrame:
    """cleft_segid, presyn_x .. postsyn_z; -1 for a null partner, -2 for one without a voxel in the cleft's grown box.

    clefts: x, y, z, cleft_segid. segments: x, y, z, segid. edges: cleft_segid, presyn_segid,
    postsyn_segid. The box is the cleft's grown by width on each side, moved and cut to the volume; a
    cleft meets the voxels of its two partners inside it, no others.
    """
    box = clefts.where(F.col(SEGMENT) != 0).groupBy(SEGMENT).agg(F.sort_array(F.collect_list(F.struct("x", "y", "z"))).alias("points"), *(f(a).alias(f"{n}{a}") for n, f in (("lo", F.min), ("hi", F.max)) for a in "xyz"))
    for a, w, v in zip("xyz", width, volume, strict=True):
        up = F.greatest(F.lit(0), w - F.col(f"lo{a}"))
        down = F.greatest(F.lit(0), F.col(f"hi{a}") + 1 + w - v)
        box = box.withColumns({f"lo{a}": F.greatest(F.lit(0), F.col(f"lo{a}") - w + up - down), f"hi{a}": F.least(F.lit(v), F.col(f"hi{a}") + 1 + w + up - down)})
    wanted = edges.select(SEGMENT, PRE, POST).join(box, SEGMENT)
    sides = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(c).alias("segid")) for s, c in (("pre", PRE), ("post", POST)))))
    near = wanted.select(SEGMENT, *(f"{n}{a}" for n in ("lo", "hi") for a in "xyz"), sides.alias("s")).select("*", "s.side", "s.segid").drop("s").join(segments, "segid")
    for a in "xyz":
        near = near.where((F.col(a) >= F.col(f"lo{a}")) & (F.col(a) < F.col(f"hi{a}")))
    near = near.groupBy(F.col(SEGMENT).alias("near_id"), "side").agg(F.sort_array(F.collect_list(F.struct("x", "y", "z"))).alias("voxels"))
    both = near.groupBy("near_id").agg(*(F.max(F.when(F.col("side") == s, F.col("voxels"))).alias(s) for s in ("pre", "post")))
    rows = wanted.join(both, F.col(SEGMENT) == F.col("near_id"), "left")
    scale, size = np.array(resolution, float), np.array(width)
    names = [f"{s}_{a}" for s in ("presyn", "postsyn") for a in "xyz"]

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                own = np.array([tuple(p.values()) for p in row.points])
                low, high = (np.array([getattr(row, f"{n}{a}") for a in "xyz"]) for n in ("lo", "hi"))
                at = [int(getattr(row, SEGMENT))]
                for partner, points in ((getattr(row, PRE), row.pre), (getattr(row, POST), row.post)):
                    if pd.isna(partner):
                        at += [NO_PARTNER] * 3
                    elif points is None:
                        at += [NOT_FOUND] * 3
                    else:
                        at += [int(v) for v in place(own, np.array([tuple(p.values()) for p in points]), low, high, size, scale)]
                out.append(at)
            yield pd.DataFrame(out, columns=[SEGMENT, *names])

    return rows.select(SEGMENT, PRE, POST, "points", *(f"{n}{a}" for n in ("lo", "hi") for a in "xyz"), "pre", "post").mapInPandas(run, f"{SEGMENT} long, " + ", ".join(f"{n} long" for n in names))


def offset_record(anchors: DataFrame, offset: tuple[int, int, int]) -> DataFrame:
    """Anchors moved by an offset; codes below 0 stay."""
    moved = {f"{s}_{a}": F.when(F.col(f"{s}_{a}") >= 0, F.col(f"{s}_{a}") + o).otherwise(F.col(f"{s}_{a}")) for s in ("presyn", "postsyn") for a, o in zip("xyz", offset, strict=True)}
    return anchors.withColumns(moved)


def merge_anchors(anchors: DataFrame) -> DataFrame:
    """One anchor row a cleft: of rows with both partners found, the one with the least coordinates; else of all rows."""
    rest = [c for c in anchors.columns if c != SEGMENT]
    valid = F.least(*(F.col(c) for c in rest if c.endswith("_x"))) >= 0
    best = F.min(F.struct((~valid).alias("__bad"), *rest))
    return anchors.groupBy(SEGMENT).agg(best.alias("b")).select(SEGMENT, *(F.col(f"b.{c}").alias(c) for c in rest))


def to_edges(edges: DataFrame, anchors: DataFrame) -> DataFrame:
    """Edges with their anchors in place of earlier ones."""
    placed = merge_anchors(anchors)
    return edges.drop(*(c for c in placed.columns if c != SEGMENT)).join(placed, SEGMENT)
