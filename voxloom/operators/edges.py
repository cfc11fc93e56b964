"""Edges between segments: scores, assignment, the largest fragment's edge, duplicates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import scaled_distance2
from ..schema import CENTROID, POST, PRE, SEGMENT
from ..storage import written
from . import idmaps, segments
from .graph import connected_components

RESOLUTION = (4, 4, 40)
NEIGHBOURS = [(x, y, z) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1)]


def pick_largest(edges: DataFrame, key: str = SEGMENT) -> DataFrame:
    """One edge a segment: that of the largest fragment; ties by all other columns in order."""
    rest = [c for c in edges.columns if c not in (key, "size")]
    best = F.min(F.struct((-F.col("size")).alias("__s"), *(F.struct(F.col(c).isNotNull(), F.col(c)).alias(c) for c in rest)))
    out = edges.groupBy(key).agg(best.alias("b"))
    return out.select(*(F.col(key) if c == key else (-F.col("b.__s")).alias(c) if c == "size" else F.col(f"b.{c}.{c}").alias(c) for c in edges.columns))


def to_segments(segs: DataFrame, edges: DataFrame, key: str = SEGMENT) -> DataFrame:
    """Segments with their edge; the segment's size counts."""
    return segs.join(edges.drop("size"), key)


def near_pairs(rows: DataFrame, distance: float, group: list[str], key: str = SEGMENT, at: list[str] | None = None, resolution=RESOLUTION, inclusive: bool = False) -> DataFrame:
    """Pairs (id1 < id2) of one group nearer than distance (or, inclusive, at most that far).

    Positions are hashed to cells of that width; one side is given to the 27 cells around, so the
    join is on group and cell and a large group spreads over its cells.
    """
    at = at or CENTROID
    cells = [F.floor(F.col(c) * r / F.lit(distance)).cast("long") for c, r in zip(at, resolution, strict=True)]
    rows = rows.where(" and ".join(f"{g} is not null" for g in group)) if group else rows
    one = rows.select(F.col(key).alias("id1"), *group, *(F.col(c).alias(f"__a{k}") for k, c in enumerate(at)), *(c.alias(f"__c{k}") for k, c in enumerate(cells)))
    move = F.explode(F.array(*[F.struct(*(F.lit(v).alias(f"d{k}") for k, v in enumerate(m))) for m in NEIGHBOURS]))
    two = rows.select(F.col(key).alias("id2"), *group, *(F.col(c).alias(f"__b{k}") for k, c in enumerate(at)), *(c.alias(f"__e{k}") for k, c in enumerate(cells)), move.alias("m"))
    two = two.select("id2", *group, "__b0", "__b1", "__b2", *((F.col(f"__e{k}") + F.col(f"m.d{k}")).alias(f"__c{k}") for k in range(3)))
    far = scaled_distance2([F.col(f"__a{k}") for k in range(3)], [F.col(f"__b{k}") for k in range(3)], resolution)
    near = far <= distance * distance if inclusive else far < distance * distance
    return one.join(two, [*group, "__c0", "__c1", "__c2"]).where((F.col("id1") < F.col("id2")) & near).select("id1", "id2")


TILE = 40  # distances along a side of the box of positions that one task takes
FINE = 1.8  # cells along a distance: over the root of three, so that all of a cell is near
REACH = [(x, y, z) for x in range(-2, 3) for y in range(-2, 3) for z in range(-2, 3) if (x, y, z) > (0, 0, 0)]
FEW = 200  # positions that are all compared
COMPARED = 1 << 20  # comparisons at once


def _clusters(at: np.ndarray, distance: float, resolution) -> np.ndarray:
    """For each position a number of its cluster: positions linked over any chain of ways shorter than distance.

    Positions of one cell are linked. Two cells are compared unless they are in one cluster already,
    and then by the positions that come near to the other cell's box, up to the first pair.
    """
    scale, limit = np.array(resolution), distance * distance
    near = lambda p, q: np.square((p[:, None] - q[None]) * scale).sum(2) < limit
    if len(at) <= FEW:
        linked, label, last = near(at, at), np.arange(len(at)), None
        while last is None or (label != last).any():
            last, label = label, np.where(linked, label, len(at)).min(1)
        return label
    cell = np.floor(at * (scale * (FINE / distance))).astype(np.int64)
    cell -= cell.min(0) - 2
    span = cell.max(0) + 3
    cells, of = np.unique((cell[:, 0] * span[1] + cell[:, 1]) * span[2] + cell[:, 2], return_inverse=True)
    order = np.argsort(of, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(cells)))])
    points = at[order]
    low, high = (f.reduceat(points, first[:-1], axis=0) for f in (np.minimum, np.maximum))
    gap = lambda x, k: np.square(np.maximum(0, np.maximum(low[k] - x, x - high[k])) * scale).sum(1)
    up = list(range(len(cells)))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def meet(i: int, j: int) -> bool:
        p, q = points[first[i] : first[i + 1]], points[first[j] : first[j + 1]]
        p, q = p[gap(p, j) < limit], q[gap(q, i) < limit]
        step = max(1, COMPARED // max(1, len(q)))
        return any(near(p[k : k + step], q).any() for k in range(0, len(p), step))

    for x, y, z in sorted(REACH, key=lambda m: sum(abs(v) for v in m)):
        want = cells + (x * span[1] + y) * span[2] + z
        to = np.minimum(np.searchsorted(cells, want), len(cells) - 1)
        hit = np.flatnonzero(cells[to] == want)
        for i, j in zip(hit.tolist(), to[hit].tolist(), strict=True):
            u, v = top(i), top(j)
            if u != v and meet(i, j):
                up[max(u, v)] = min(u, v)
    return np.array([top(i) for i in range(len(cells))], np.int64)[of]


def _tiles(rows: DataFrame, distance: float, group: list[str], key: str, at: list[str], resolution, *more: str) -> tuple[DataFrame, list[str]]:
    """Rows with id, position (__a), own tile (__o) and tile (__t), once for each tile that takes them; and what names a task."""
    rows = rows.where(" and ".join(f"{c} is not null" for c in (key, *group, *at)))
    near = rows.select(F.col(key).alias("id"), *group, *more, *(F.col(c).cast("double").alias(f"__a{k}") for k, c in enumerate(at)))
    for k, r in enumerate(resolution):
        tile = lambda margin, k=k, r=r: F.floor((F.col(f"__a{k}") * r - margin) / (TILE * distance) + 0.5).cast("long")
        near = near.withColumn(f"__o{k}", tile(0)).withColumn(f"__t{k}", F.explode(F.array_distinct(F.array(tile(distance), tile(0)))))
    return near, [*group, "__t0", "__t1", "__t2"]


def near_components(rows: DataFrame, distance: float, group: list[str], key: str = SEGMENT, at: list[str] | None = None, resolution=RESOLUTION) -> DataFrame:
    """(id, component) of the ids that near_pairs() links, over any chain, without its pairs; component is the least id.

    Positions go by group and tile of TILE distances, with a margin of one distance on the high
    sides, so that the tile of the low corner sees both ends of every link. A task gives each id the least id of its
    cluster there; ids with several of those join them.
    """
    near, named = _tiles(rows, distance, group, key, at or CENTROID, resolution)
    near = near.drop("__o0", "__o1", "__o2")
    kind = rows.schema[key].dataType.simpleString()

    def settle(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        cluster = _clusters(np.stack([table.column(f"__a{k}").to_numpy() for k in range(3)], axis=1), distance, resolution)
        order = np.lexsort((ids, cluster))
        ids, cluster = ids[order], cluster[order]
        begin = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1]]))
        n = np.diff(np.append(begin, len(ids)))
        linked = np.repeat(ids[begin] != ids[begin + n - 1], n)
        type_ = table.schema.field("id").type
        return pa.table({"id": pa.array(ids[linked], type_), "root": pa.array(np.repeat(ids[begin], n)[linked], type_)})

    roots = near.groupBy(*named).applyInArrow(settle, f"id {kind}, root {kind}")
    roots = written(roots.groupBy("id").agg(F.sort_array(F.collect_set("root")).alias("roots")), "roots")
    several = roots.where(F.size("roots") > 1).select(F.col("roots")[0].alias("u"), F.explode("roots").alias("v"))
    joined = connected_components(several, "u", "v").select(F.col("id").alias("root"), F.col("component").alias("least"))
    own = roots.select("id", F.col("roots")[0].alias("root"))
    return own.join(joined, "root", "left").select("id", F.coalesce("least", "root").alias("component"))


def split_pairs(rows: DataFrame, label: str, distance: float, group: list[str], key: str = SEGMENT, at: list[str] | None = None, resolution=RESOLUTION) -> DataFrame:
    """The pairs of near_pairs() whose ends differ in label, without the others: only cells with different labels are compared."""
    near, named = _tiles(rows, distance, group, key, at or CENTROID, resolution, label)
    kind, scale, limit = rows.schema[key].dataType.simpleString(), np.array(resolution), distance * distance

    def compare(table: pa.Table) -> pa.Table:
        ids, names = table.column("id").to_numpy(), np.unique(table.column(label).to_numpy(), return_inverse=True)[1]
        at, own = (np.stack([table.column(f"__{c}{k}").to_numpy() for k in range(3)], axis=1) for c in "ao")
        own = own == np.array([table.column(f"__t{k}")[0].as_py() for k in range(3)])
        found = [np.zeros((0, 2), np.int64)]
        if len(names) and names.max():
            cell = np.floor(at * (scale * (FINE / distance))).astype(np.int64)
            where: dict[tuple, list[int]] = {}
            for i, c in enumerate(map(tuple, cell.tolist())):
                where.setdefault(c, []).append(i)
            held = {c: np.array(rows) for c, rows in where.items()}
            one = {c: set(names[rows].tolist()) for c, rows in held.items()}
            for c, p in held.items():
                for move in [(0, 0, 0), *REACH]:
                    to = tuple(u + v for u, v in zip(c, move, strict=True))
                    q = held.get(to)
                    if q is None or len(one[c] | one[to]) == 1:
                        continue
                    step = max(1, COMPARED // len(q))
                    for k in range(0, len(p), step):
                        part = p[k : k + step]
                        hit = np.square((at[part][:, None] - at[q][None]) * scale).sum(2) < limit
                        hit &= names[part][:, None] != names[q][None]
                        i, j = np.nonzero(hit)
                        i, j = part[i], q[j]
                        good = (own[i] | own[j]).all(1) & (ids[i] != ids[j])  # the tile of the low corner gives a pair
                        good &= (i < j) if to == c else True
                        found.append(np.stack([i[good], j[good]], axis=1))
        i, j = np.concatenate(found).T
        less, type_ = ids[i] < ids[j], table.schema.field("id").type
        return pa.table({"id1": pa.array(np.where(less, ids[i], ids[j]), type_), "id2": pa.array(np.where(less, ids[j], ids[i]), type_)})

    return near.groupBy(*named).applyInArrow(compare, f"id1 {kind}, id2 {kind}")


def duplicate_map(full: DataFrame, distance: float, group: tuple[str, ...] = (PRE, POST), resolution=RESOLUTION) -> DataFrame:
    """(src_id, dst_id) of segments with a duplicate: same partners, nearer than distance, over any chain. Null partners have none."""
    return near_components(full, distance, list(group), resolution=resolution).select(F.col("id").alias("src_id"), F.col("component").alias("dst_id"))


def merge_duplicates(segs: DataFrame, edges: DataFrame, distance: float, least: int = 0, resolution=RESOLUTION) -> tuple[DataFrame, DataFrame]:
    """Full rows with duplicates merged and small ones dropped, and the id map of both steps."""
    full = written(to_segments(segs, edges), "full")  # read for the pairs and for the merge
    found = duplicate_map(full, distance, resolution=resolution)
    merged = segments.merge(full, found, truncate=False, others=[c for c in edges.columns if c not in (SEGMENT, "size")])
    kept, dropped = idmaps.by_size(merged, least)
    return kept, idmaps.compose(found, dropped)


def flag_over(scores: DataFrame, score: str, threshold: float, fallback: bool, key: str = SEGMENT, seg: str = "segid") -> DataFrame:
    """Rows over the threshold; with fallback the best row of a segment that has none over it (smallest id of equals)."""
    over = F.col(score) > threshold
    if not fallback:
        return scores.where(over)
    best = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), seg)) == 1
    flagged = scores.withColumn("__best", best).withColumn("__any", F.max(over).over(Window.partitionBy(key)))
    return flagged.where(over | (F.col("__best") & ~F.col("__any"))).drop("__best", "__any")


def assign_by_max(scores: DataFrame, pre: str = "pre", post: str = "post", key: str = SEGMENT, seg: str = "segid") -> DataFrame:
    """One edge a segment: best pre and best post partner, smallest id of equals."""
    top = lambda c: (-F.max(F.struct(F.col(c), (-F.col(seg)).alias("less")))["less"])
    return scores.groupBy(key).agg(top(pre).alias(PRE), top(post).alias(POST))


def assign_by_threshold(scores: DataFrame, threshold: float, post_threshold: float | None = None, pre: str = "pre", post: str = "post", key: str = SEGMENT, seg: str = "segid") -> DataFrame:
    """All pairs of pre partners (over the threshold, else the best) and post partners (over theirs)."""
    a = flag_over(scores, pre, threshold, True, key, seg).select(key, F.col(seg).alias(PRE))
    b = flag_over(scores, post, threshold if post_threshold is None else post_threshold, False, key, seg).select(key, F.col(seg).alias(POST))
    return a.join(b, key).select(key, PRE, POST)


def normalize(scores: DataFrame, column: str, key: str = SEGMENT) -> DataFrame:
    return scores.withColumn(column, F.try_divide(F.col(column), F.sum(column).over(Window.partitionBy(key))))


def mix(a, b, share: float):
    return a * share + b * (1 - share)


def self_loops(edges: DataFrame) -> DataFrame:
    return edges.where(F.col(PRE) == F.col(POST))


def far_apart(edges: DataFrame, a: list[str], b: list[str], distance: float, resolution=RESOLUTION) -> DataFrame:
    return edges.where(scaled_distance2([F.col(c) for c in a], [F.col(c) for c in b], resolution) > distance * distance)


def upsample(edges: DataFrame, columns: list[str], mip: int) -> DataFrame:
    """x and y coordinates times 2 to the mip; z stays."""
    return edges.withColumns({c: F.col(c) * (1 << mip) for c in columns if not c.endswith("_z")})
