"""Sparse voxel volumes (x, y, z, id columns; background is an absent row or id 0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import connected_components


def box_scan(voxels: DataFrame, low: tuple[int, int, int], high: tuple[int, int, int]) -> DataFrame:
    """Voxels of a half-open box; the conditions reach the scan."""
    for a, b, e in zip("xyz", low, high, strict=True):
        voxels = voxels.where((F.col(a) >= b) & (F.col(a) < e))
    return voxels


def threshold(voxels: DataFrame, above: float, column: str = "val") -> DataFrame:
    return voxels.where(F.col(column) > above)


def nonzero_ids(voxels: DataFrame, column: str) -> DataFrame:
    return voxels.where(F.col(column) != 0).select(column).distinct()


def sizes(voxels: DataFrame, column: str) -> DataFrame:
    return voxels.where(F.col(column) != 0).groupBy(column).agg(F.count("*").alias("size"))


def describe(voxels: DataFrame, column: str, offset: tuple[int, int, int] = (0, 0, 0)) -> DataFrame:
    """Size, centroid (rounded half away from zero) and box of each id in one pass."""
    stats = [F.count("*").alias("size")]
    for a, o in zip("xyz", offset, strict=True):
        stats += [(F.round(F.sum(a) / F.count("*")).cast("long") + o).alias(f"centroid_{a}"), (F.min(a) + o).cast("long").alias(f"bbox_b{a}"), (F.max(a) + 1 + o).cast("long").alias(f"bbox_e{a}")]
    return voxels.where(F.col(column) != 0).groupBy(column).agg(*stats)


def filter_by_size(voxels: DataFrame, column: str, least: int, ignored: DataFrame | None = None) -> DataFrame:
    """Voxels of ids of least voxels at least, or ignored (kept at any size)."""
    kept = sizes(voxels, column).where(F.col("size") >= least).select(column)
    if ignored is not None:
        kept = kept.unionByName(ignored.select(column)).distinct()
    return voxels.join(kept, column, "left_semi")


def filter_by_id(voxels: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    return voxels.join(gone.select(column).distinct(), column, "left_anti")


def apply_mask(voxels: DataFrame, mask: DataFrame) -> DataFrame:
    return voxels.join(mask.select("x", "y", "z"), ["x", "y", "z"], "left_semi")


def pull_ids(places: DataFrame, voxels: DataFrame, column: str, at: list[str], out: str) -> DataFrame:
    """places with the id at their coordinates, as out; places without a voxel go."""
    return places.join(voxels.select(*(F.col(a).alias(c) for a, c in zip("xyz", at, strict=True)), F.col(column).alias(out)), at)


def components(voxels: DataFrame, base: str | None = None, chunk: list[str] | None = None) -> DataFrame:
    """6-connected components: voxels with label, the least (z, y, x)-linear index of the component.

    base: neighbours must also agree in this id. chunk: components don't cross chunks. Three shifted
    equi-joins make the graph.
    """
    from ..storage import written

    keys = [*([base] if base else []), *(chunk or [])]
    span = 1 << 20
    index = (F.col("z").cast("long") * span + F.col("y")) * span + F.col("x")
    own = written(voxels.withColumn("__i", index), "voxels")
    pairs = None
    for a in "xyz":
        other = own.select(*[(F.col(k) - int(k == a)).alias(k) for k in "xyz"], *keys, F.col("__i").alias("__j"))
        met = own.select("x", "y", "z", *keys, "__i").join(other, ["x", "y", "z", *keys]).select("__i", "__j")
        pairs = met if pairs is None else pairs.unionByName(met)
    labels = connected_components(pairs, "__i", "__j").select(F.col("id").alias("__i"), F.col("component").alias("label"))
    return own.join(labels, "__i", "left").withColumn("label", F.coalesce("label", "__i")).drop("__i")


def linear_index(label: Column, shape: tuple[int, int, int]) -> Column:
    """A label of components() as x + X * (y + Y * z)."""
    span = 1 << 20
    x, y, z = label % span, F.floor(label / span) % span, F.floor(label / (span * span))
    return (x + shape[0] * (y + shape[1] * z)).cast("long")


def diamond(k: int) -> list[tuple[int, int, int]]:
    return [(dx, dy, abs(dx) + abs(dy)) for dx in range(-k, k + 1) for dy in range(-k, k + 1) if abs(dx) + abs(dy) <= k]


def dilate(voxels: DataFrame, column: str, k: int, low: tuple[int, int], high: tuple[int, int]) -> DataFrame:
    """Labels grown by Manhattan distance k within each z section and the volume; the nearest label wins, then the smallest."""
    move = F.explode(F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy"), F.lit(d).alias("d")) for x, y, d in diamond(k)]))
    moved = voxels.where(F.col(column) != 0).select("x", "y", "z", column, move.alias("m")).select((F.col("x") + F.col("m.dx")).alias("x"), (F.col("y") + F.col("m.dy")).alias("y"), "z", F.struct(F.col("m.d").alias("d"), F.col(column).alias("id")).alias("best"))
    inside = moved.where((F.col("x") >= low[0]) & (F.col("x") < high[0]) & (F.col("y") >= low[1]) & (F.col("y") < high[1]))
    return inside.groupBy("x", "y", "z").agg(F.min("best").alias("best")).select("x", "y", "z", F.col("best.id").alias(column), F.col("best.d").cast("long").alias("dist"))


def dilated_components(voxels: DataFrame, k: int, low: tuple[int, int], high: tuple[int, int]) -> DataFrame:
    """Components of the mask dilated by k, on the mask's own voxels."""
    if not k:
        return components(voxels)
    grown = dilate(voxels.withColumn("__one", F.lit(1)), "__one", k, low, high).select("x", "y", "z")
    return voxels.join(components(grown), ["x", "y", "z"])


def countless(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Mode of 2 by 2: a if it equals b or c, else b if it equals c, else d."""
    return F.when((a == b) | (a == c), a).when(b == c, b).otherwise(d)


def downsample(voxels: DataFrame, column: str, mips: int = 1) -> DataFrame:
    for _ in range(mips):
        at = lambda x, y: F.coalesce(F.max(F.when((F.pmod("x", F.lit(2)) == x) & (F.pmod("y", F.lit(2)) == y), F.col(column))), F.lit(0))
        half = voxels.groupBy(F.floor(F.col("x") / 2).cast("long").alias("hx"), F.floor(F.col("y") / 2).cast("long").alias("hy"), "z").agg(countless(at(0, 0), at(1, 0), at(0, 1), at(1, 1)).alias(column))
        voxels = half.select(F.col("hx").alias("x"), F.col("hy").alias("y"), "z", column).where(F.col(column) != 0)
    return voxels


def upsample(voxels: DataFrame, column: str) -> DataFrame:
    move = F.explode(F.array(*[F.struct(F.lit(x).alias("dx"), F.lit(y).alias("dy")) for x in (0, 1) for y in (0, 1)]))
    return voxels.select("x", "y", "z", column, move.alias("m")).select((F.col("x") * 2 + F.col("m.dx")).cast("long").alias("x"), (F.col("y") * 2 + F.col("m.dy")).cast("long").alias("y"), "z", column)


def surfaces(voxels: DataFrame, column: str, axes: str = "xyz", volume: tuple[tuple[int, int, int], tuple[int, int, int]] | None = None) -> DataFrame:
    """Voxels whose id differs from a neighbour's along an axis; an absent neighbour is background.

    volume: low and high corner of the volume, beyond which there is no neighbour; by default the
    hull of the voxels given (id 0 included).
    """
    if volume is None:
        ends = voxels.agg(*(f(a) for a in "xyz" for f in (F.min, F.max))).first()
        volume = (tuple(ends[0::2]), tuple(1 + (v if v is not None else -1) for v in ends[1::2]))
    steps = [F.struct(*(F.lit(d if k == a else 0).alias(f"d{k}") for k in "xyz")) for a in axes for d in (-1, 1)]
    own = voxels.where(F.col(column) != 0)
    move = own.select("x", "y", "z", column, F.explode(F.array(*steps)).alias("s"))
    there = move.select("x", "y", "z", column, *((F.col(k) + F.col(f"s.d{k}")).alias(f"__{k}") for k in "xyz"))
    for k, low, high in zip("xyz", *volume, strict=True):
        there = there.where((F.col(f"__{k}") >= low) & (F.col(f"__{k}") < high))
    other = own.select(*(F.col(k).alias(f"__{k}") for k in "xyz"), F.col(column).alias("__id"))
    edge = there.join(other, ["__x", "__y", "__z"], "left").where(F.coalesce("__id", F.lit(0)) != F.col(column))
    return voxels.join(edge.select("x", "y", "z").distinct(), ["x", "y", "z"], "left_semi").select(voxels.columns)


def faces(voxels: DataFrame, column: str, chunk: tuple[int, int, int]) -> DataFrame:
    """Voxels on chunk faces: face key (fx, fy, fz, axis), whether it is the high face, the two other coordinates, the id.

    Both sides of a face have one key: the corner where the chunks meet.
    """
    size = dict(zip("xyz", chunk, strict=True))
    rows = voxels.where(F.col(column) != 0)
    kinds = []
    for axis, a in enumerate("xyz"):
        i, j = (k for k in "xyz" if k != a)
        for hi in (True, False):
            corner = {k: (F.floor(F.col(k) / size[k]) * size[k]).cast("long") for k in "xyz"}
            on = F.pmod(F.col(a), F.lit(size[a])) == (size[a] - 1 if hi else 0)
            if hi:
                corner[a] = corner[a] + size[a]
            face = F.struct(*(corner[k].alias(f"f{k}") for k in "xyz"), F.lit(axis).alias("axis"), F.lit(hi).alias("hi_face"), F.col(i).cast("long").alias("i"), F.col(j).cast("long").alias("j"))
            kinds.append(F.when(on, face))
    found = rows.select(F.col(column).alias("segid"), F.explode(F.filter(F.array(*kinds), lambda k: k.isNotNull())).alias("f"))
    return found.select("f.*", "segid")


def match_faces(found: DataFrame) -> DataFrame:
    """Distinct (graph_id1, graph_id2) of segments that touch across a face: high side, low side."""
    on = ["fx", "fy", "fz", "axis", "i", "j"]
    high = found.where("hi_face").select(*on, F.col("segid").alias("graph_id1"))
    low = found.where("not hi_face").select(*on, F.col("segid").alias("graph_id2"))
    return high.join(low, on).select("graph_id1", "graph_id2").distinct()
