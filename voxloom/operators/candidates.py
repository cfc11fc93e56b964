"""Candidate partners: terminals, nearest voxels, overlapping pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import scaled_distance2
from ..schema import POST, PRE
from . import overlap, voxels
from .edges import NEIGHBOURS


def filter_terminals(overlaps: DataFrame, least: int) -> DataFrame:
    """Terminal to segment: the largest overlap, if the segment isn't 0 and the overlap has least voxels at least."""
    from .overlap import largest

    return largest(overlaps).where((F.col("col_id") != 0) & (F.col("vals") >= least))


def two_sets_within(one: DataFrame, two: DataFrame, distance: float, resolution=(4, 4, 40)) -> DataFrame:
    """(id1, id2) of points (id, x, y, z) of two sets nearer than distance, by cells of that width."""
    cells = [F.floor(F.col(c) * r / F.lit(distance)).cast("long").alias(f"c{c}") for c, r in zip("xyz", resolution, strict=True)]
    a = one.select(F.col("id").alias("id1"), *(F.col(c).alias(f"a{c}") for c in "xyz"), *cells)
    move = F.explode(F.array(*[F.struct(*(F.lit(v).alias(f"d{k}") for k, v in zip("xyz", m, strict=True))) for m in NEIGHBOURS]))
    b = two.select(F.col("id").alias("id2"), *(F.col(c).alias(f"b{c}") for c in "xyz"), *cells, move.alias("m"))
    b = b.select("id2", "bx", "by", "bz", *((F.col(f"c{k}") + F.col(f"m.d{k}")).alias(f"c{k}") for k in "xyz"))
    near = scaled_distance2([F.col(f"a{k}") for k in "xyz"], [F.col(f"b{k}") for k in "xyz"], resolution) < distance * distance
    return a.join(b, ["cx", "cy", "cz"]).where(near).select("id1", "id2")


def by_separation(pairs: DataFrame | None, pre: DataFrame, post: DataFrame, separation: float, resolution=(4, 4, 40)) -> DataFrame:
    """Pairs (id1, id2) whose voxels come nearer than separation, with the pre voxel nearest to post (least distance, then x, y, z).

    pairs: those that count; None for all pairs. Voxels meet by cells of that width, so the work goes
    with the voxels that are near and not with the number of pairs.
    """
    a = pre.select(F.col("id").alias("id1"), *(F.col(c).alias(f"a{c}") for c in "xyz"))
    cells = lambda p: [F.floor(F.col(f"{p}{c}") * r / F.lit(separation)).cast("long").alias(f"c{c}") for c, r in zip("xyz", resolution, strict=True)]
    a = a.select("*", *cells("a"))
    b = post.select(F.col("id").alias("id2"), *(F.col(c).alias(f"b{c}") for c in "xyz"))
    move = F.explode(F.array(*[F.struct(*(F.lit(v).alias(f"d{k}") for k, v in zip("xyz", m, strict=True))) for m in NEIGHBOURS]))
    b = b.select("*", *cells("b"), move.alias("m")).select("id2", "bx", "by", "bz", *((F.col(f"c{k}") + F.col(f"m.d{k}")).alias(f"c{k}") for k in "xyz"))
    d2 = scaled_distance2([F.col(f"a{k}") for k in "xyz"], [F.col(f"b{k}") for k in "xyz"], resolution)
    near = a.join(b, ["cx", "cy", "cz"]) if pairs is None else pairs.join(a, "id1").join(b, ["id2", "cx", "cy", "cz"])
    near = near.withColumn("d2", d2).where(F.col("d2") < separation * separation)
    best = F.min(F.struct("d2", F.col("ax").alias("x"), F.col("ay").alias("y"), F.col("az").alias("z")))
    return near.groupBy("id1", "id2").agg(best.alias("b")).select("id1", "id2", F.col("b.x").alias("x"), F.col("b.y").alias("y"), F.col("b.z").alias("z"))


def overlapping_pairs(overlaps: DataFrame, above: int, same: bool = True) -> DataFrame:
    """Ordered pairs of segments that a cleft (row_id) overlaps by more than above voxels; same: with itself too."""
    o = overlaps.where(F.col("vals") > above)
    a = o.select("row_id", F.col("col_id").alias("pre"))
    b = o.select("row_id", F.col("col_id").alias("post"))
    out = a.join(b, "row_id")
    return out if same else out.where("pre != post")


def label_candidates(clefts: DataFrame, segments: DataFrame, k: int, above: int, low: tuple[int, int], high: tuple[int, int], same: bool = True) -> DataFrame:
    """overlapping_pairs() of clefts (x, y, z, cleft) grown by k with segments (x, y, z, segid)."""
    grown = voxels.dilate(clefts, "cleft", k, low, high) if k else clefts
    both = grown.select("x", "y", "z", "cleft").join(segments, ["x", "y", "z"])
    return overlapping_pairs(overlap.count(both, "cleft", "segid"), above, same)


def terminal_segments(terminals: DataFrame, segments: DataFrame, least: int) -> DataFrame:
    """terminal, segid: the segment under each terminal's last voxel (by x, y, z), if it is not 0 and has least voxels at least."""
    size = voxels.sizes(segments, "segid").where(F.col("size") >= least).select("segid")
    own = terminals.where("terminal != 0").join(segments, ["x", "y", "z"]).groupBy("terminal").agg(F.max_by("segid", F.struct("x", "y", "z")).alias("segid"))
    return own.where("segid != 0").join(size, "segid", "left_semi")


def terminal_candidates(pre: DataFrame, post: DataFrame, segments: DataFrame, least: int, distance: float, separation: float, resolution=(4, 4, 40), same: bool = False) -> DataFrame:
    """Pairs of terminals that may be a synapse: pre_terminal, post_terminal, their segments, and the pre voxel nearest to the other.

    pre, post: x, y, z, terminal. Terminals on small segments go; centroids must be nearer than
    distance and voxels nearer than separation; pairs on one segment go unless same.
    """
    sides = []
    for terminals in (pre, post):
        found = terminal_segments(terminals, segments, least)
        sides.append((found, terminals.join(found, "terminal").select("x", "y", "z", F.col("terminal").alias("id"))))
    centres = [voxels.describe(v, "id").select("id", *(F.col(f"centroid_{a}").alias(a) for a in "xyz")) for _, v in sides]
    pairs = two_sets_within(*centres, distance, resolution)
    near = by_separation(pairs, sides[0][1], sides[1][1], separation, resolution)
    out = near.withColumnsRenamed({"id1": "pre_terminal", "id2": "post_terminal"})
    for (found, _), side, partner in zip(sides, ("pre", "post"), (PRE, POST), strict=True):
        out = out.join(found.select(F.col("terminal").alias(f"{side}_terminal"), F.col("segid").alias(partner)), f"{side}_terminal")
    out = out.select("pre_terminal", "post_terminal", PRE, POST, "x", "y", "z")
    return out if same else out.where(F.col(PRE) != F.col(POST))
