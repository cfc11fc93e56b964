"""Distance transforms of dense boxes of voxels, and partner-signed proximity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import scaled_distance2
from . import idmaps, voxels


def manhattan(dense: DataFrame, column: str, axes: str = "xy") -> DataFrame:
    """x, y, z, id, dist: the nearest non-zero id of each voxel along these axes, in steps; the least id of equals, nulls without any.

    dense: a row for every voxel of the box. One axis after the other, the least of distance plus
    steps so far is a running minimum each way, so a task holds one line of voxels. Both ways run from
    the line's start in their order: a frame that ends with the line is summed anew for every row.
    """
    out = dense.select("x", "y", "z", F.when(F.col(column) != 0, F.struct(F.lit(0).cast("long").alias("dist"), F.col(column).alias("id"))).alias("best"))
    for a in axes:
        line = Window.partitionBy(*(k for k in "xyz" if k != a))
        there = lambda sign: F.when(F.col("best").isNotNull(), F.struct((F.col("best.dist") + sign * F.col(a)).alias("dist"), F.col("best.id").alias("id")))  # noqa: B023, E731
        back = F.min(there(-1)).over(line.orderBy(a).rangeBetween(Window.unboundedPreceding, Window.currentRow))
        ahead = F.min(there(1)).over(line.orderBy(F.desc(a)).rangeBetween(Window.unboundedPreceding, Window.currentRow))
        here = lambda m, sign: F.struct((m["dist"] + sign * F.col(a)).alias("dist"), m["id"].alias("id"))  # noqa: B023, E731
        out = out.select("*", back.alias("b"), ahead.alias("f"))
        out = out.select("x", "y", "z", F.least(F.when(F.col("b").isNotNull(), here(F.col("b"), 1)), F.when(F.col("f").isNotNull(), here(F.col("f"), -1))).alias("best"))
    return out.select("x", "y", "z", F.col("best.id").alias("id"), F.col("best.dist").alias("dist"))


def _nearest(line: np.ndarray, at: np.ndarray, value: np.ndarray, known: np.ndarray, scale) -> tuple[np.ndarray, np.ndarray]:
    """For rows in order of line and at, the least value plus scale times squared way over the known rows of the line; and whether there is any.

    The place of the least moves with at, never back, so the middle row of a run halves its work: all
    lines take one halving at a time.
    """
    seed = np.flatnonzero(known)
    to, base = at[seed], value[seed]
    low, high = (np.searchsorted(line[seed], line, side) for side in ("left", "right"))
    found, out = high > low, np.zeros(len(line), np.result_type(value, at, type(scale)))
    begin = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]) & found) if len(line) else np.zeros(0, np.int64)
    q0, q1 = begin, np.searchsorted(line, line[begin], "right") - 1
    s0, s1 = low[begin], high[begin] - 1
    while len(q0):
        mid, n = (q0 + q1) // 2, s1 - s0 + 1
        start = np.cumsum(n) - n
        s = np.repeat(s0 - start, n) + np.arange(n.sum())
        way = np.repeat(at[mid], n) - to[s]
        cost = base[s] + way * way * scale
        out[mid] = least = np.minimum.reduceat(cost, start)
        best = np.minimum.reduceat(np.where(cost == np.repeat(least, n), s, len(seed)), start)
        q0, q1, s0, s1 = (np.concatenate(x) for x in ((q0, mid + 1), (mid - 1, q1), (s0, best), (best, s1)))
        left = q0 <= q1
        q0, q1, s0, s1 = q0[left], q1[left], s0[left], s1[left]
    return out, found


def euclidean2(dense: DataFrame, target: Column, out: str, resolution=(4, 4, 40), keys: tuple[str, ...] = ()) -> DataFrame:
    """dense with out: the squared distance to the nearest voxel where target holds; null without any.

    dense: a row for every voxel of the box, or of each box named by keys. One axis after the other,
    a task takes whole lines of voxels, sorted, and every voxel the least of value plus squared way
    over its line; the work is a line's length times its logarithm.
    """
    rows = dense.select(*(c for c in dense.columns if c != out), F.when(target, F.lit(0).cast("long")).alias(out))
    for a, r in zip("xyz", resolution, strict=True):
        on = [*keys, *(k for k in "xyz" if k != a)]

        def solve(table: pa.Table, a=a, r=r, on=on) -> pa.Table:
            new = np.zeros(len(table), bool)
            for c in on:
                code = table.column(c).combine_chunks().dictionary_encode("encode").indices.to_numpy()
                new[1:] |= code[1:] != code[:-1]
            at, value = table.column(a), table.column(out)
            valid = np.flatnonzero(at.is_valid().to_numpy())
            here = at.fill_null(0).to_numpy()[valid]
            here = here.astype(np.int64) if here.dtype.kind in "iu" else here.astype(float)
            least, found = _nearest(np.cumsum(new)[valid], here, value.fill_null(0).to_numpy()[valid], value.is_valid().to_numpy()[valid], r * r)
            full, none = np.zeros(len(table), np.int64), np.ones(len(table), bool)
            full[valid], none[valid] = least.astype(np.int64), ~found
            return table.set_column(table.column_names.index(out), out, pa.array(full, mask=none))

        def lines(batches: Iterator[pa.RecordBatch], on=on, solve=solve) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []  # the last line may go on in the next batch
            for batch in batches:
                if not len(batch):
                    continue
                last = [batch.column(c)[len(batch) - 1] for c in on]
                cut = len(batch)
                ends = held[0] if held else None
                while cut and all(batch.column(c)[cut - 1].as_py() == v.as_py() for c, v in zip(on, last, strict=True)):
                    cut -= 1
                if cut or ends is not None and any(ends.column(c)[0].as_py() != v.as_py() for c, v in zip(on, last, strict=True)):
                    yield from solve(pa.Table.from_batches([*held, batch.slice(0, cut)])).to_batches()
                    held.clear()
                held.append(batch.slice(cut))
            if held:
                yield from solve(pa.Table.from_batches(held)).to_batches()

        rows = rows.repartition(*on).sortWithinPartitions(*on, a).mapInArrow(lines, rows.schema)
    return rows


def parag_transform(dist: Column, sigma: float = 50.0, alpha: float = 5.0) -> Column:
    """A signed distance as proximity between -1 and 1."""
    return F.exp(-(dist * dist) / (2 * sigma * sigma)) * (F.lit(2.0) / (F.lit(1.0) + F.exp(-alpha * dist)) - 1)


def signed_distance(segments: DataFrame, clefts: DataFrame, edges: DataFrame, radius: tuple[int, int, int], resolution=(4, 4, 40)) -> DataFrame:
    """x, y, z, dist of voxels of partners near their cleft: positive on the presynaptic side, negative on the other.

    segments: x, y, z, segid. clefts: x, y, z, cleft_segid. edges: cleft_segid, presyn_segid,
    postsyn_segid. Only voxels in the cleft's box grown by radius count. The nearest cleft decides, of
    equals the least id, and of one cleft's two sides the postsynaptic one. A cleft's voxels travel as
    an array to the voxels of its partners in its box.
    """
    own = clefts.where("cleft_segid != 0").groupBy("cleft_segid").agg(F.collect_list(F.struct("x", "y", "z")).alias("__at"), *(f(a).alias(f"{n}{a}") for n, f in (("lo", F.min), ("hi", F.max)) for a in "xyz"))
    sides = F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("presyn_segid").alias("segid")), F.struct(F.lit(-1).alias("sign"), F.col("postsyn_segid").alias("segid"))))
    wanted = edges.select("cleft_segid", sides.alias("s")).select("cleft_segid", "s.sign", "s.segid").join(own, "cleft_segid")
    near = segments.where("segid != 0").join(wanted, "segid")
    for a, r in zip("xyz", radius, strict=True):
        near = near.where((F.col(a) >= F.col(f"lo{a}") - r) & (F.col(a) <= F.col(f"hi{a}") + r))
    least = F.array_min(F.transform("__at", lambda p: scaled_distance2([p[a] for a in "xyz"], [F.col(a) for a in "xyz"], resolution)))
    best = F.min(F.struct(least.alias("d2"), "cleft_segid", "sign"))
    return near.groupBy("x", "y", "z").agg(best.alias("b")).select("x", "y", "z", (F.sqrt("b.d2") * F.col("b.sign") + F.lit(0.0)).alias("dist"))


def prox_terminals(prox: DataFrame, above: float, least_size: int = 0, base: str | None = None, below: bool = False) -> DataFrame:
    """x, y, z, terminal (ids from 1): components of proximity above (or below) a threshold, split by base id, without base 0 and small ones."""
    mask = prox.where(F.col("val") < above if below else F.col("val") > above)
    found = voxels.components(mask)
    if base is not None:
        found = found.where(F.col(base) != 0)
    out = idmaps.dense_ids(found, [*([base] if base else []), "label"], "terminal").select("x", "y", "z", F.col("terminal").cast("long").alias("terminal"))
    return voxels.filter_by_size(out, "terminal", least_size) if least_size else out


def split_components(labelled: DataFrame, component: str, base: str, out: str) -> DataFrame:
    """Components split by the id they lie on (0 too), numbered from 1 in order of that id and the component."""
    return idmaps.dense_ids(labelled.where(F.col(component) != 0), [base, component], out)
