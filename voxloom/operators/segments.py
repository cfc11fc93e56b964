"""Merging segment tables under an id map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import bucket, partner_bucket
from ..schema import BOX_BEGIN, BOX_END, CENTROID, POST, PRE, SEGMENT
from .graph import connected_components
from .voxels import describe, sizes


def merge(segments: DataFrame, id_map: DataFrame, truncate: bool = True, others: list[str] | None = None, keep: str = "smallest", key: str = SEGMENT) -> DataFrame:
    """Rows of one new id become one: size summed, box hull, centroid weighted by size.

    truncate: towards zero, for merged rows; rows without a new id keep their own id and centroid.
    others: further columns, from the smallest (or largest) row; ties by id.
    """
    rows = segments.join(id_map.select(F.col("src_id").alias(key), F.col("dst_id").alias("__new")), key, "left")
    rows = rows.withColumn("__alone", F.col("__new").isNull()).withColumn("__id", F.coalesce("__new", key))
    centre = []
    for c in CENTROID:
        mean = F.sum(F.col(c) * F.col("size")) / F.sum("size")
        centre.append((mean.cast("long").cast("double") if truncate else mean).alias(c))
    pick = F.min_by if keep == "smallest" else F.max_by
    extra = [pick(F.col(c), F.struct("size", key)).alias(c) for c in others or []]
    out = rows.groupBy("__id", "__alone").agg(F.sum("size").alias("size"), *centre, *(F.min(c).alias(c) for c in BOX_BEGIN), *(F.max(c).alias(c) for c in BOX_END), *(F.first(c).cast("double").alias(f"__{c}") for c in CENTROID), *extra)
    own = [F.when(F.col("__alone"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in CENTROID]
    return out.select(F.col("__id").alias(key), "size", *own, *BOX_BEGIN, *BOX_END, *(others or []))


def merge_with(df: DataFrame, id_map: DataFrame, key: str, aggregates: dict[str, str]) -> DataFrame:
    """Fold rows along a map with named aggregates (size: sum, box: min or max, ...); the registry of per-column merges."""
    named = df.join(id_map.select(F.col("src_id").alias(key), "dst_id"), key, "left").withColumn(key, F.coalesce("dst_id", key))
    return named.groupBy(key).agg(*(F.expr(f"{f}({c})").alias(c) for c, f in aggregates.items()))


def merge_map(graph: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """(src_id, dst_id) of all ids: the least id of their component in a graph (graph_id1, graph_id2)."""
    found = connected_components(graph, "graph_id1", "graph_id2")
    return ids.select(F.col(key).alias("src_id")).distinct().join(found.select(F.col("id").alias("src_id"), F.col("component").alias("dst_id")), "src_id", "left").select("src_id", F.coalesce("dst_id", "src_id").alias("dst_id"))


def same_base(graph: DataFrame, base: DataFrame) -> DataFrame:
    """Graph edges whose ends overlap one base segment most. base: row_id, col_id."""
    for k in (1, 2):
        graph = graph.join(base.select(F.col("row_id").alias(f"graph_id{k}"), F.col("col_id").alias(f"__b{k}")), f"graph_id{k}")
    return graph.where("__b1 = __b2").select("graph_id1", "graph_id2")


def mapped_by_hash(segs: DataFrame, id_map: DataFrame, buckets: int, which: int, key: str = SEGMENT) -> DataFrame:
    """Segments with their new id, of one bucket of new ids."""
    named = id_map.where(bucket([F.col("dst_id")], buckets) == which).select(F.col("src_id").alias(key), "dst_id")
    return segs.join(named, key)


def chunk_map(chunk_segs: DataFrame, id_map: DataFrame, key: str = SEGMENT) -> DataFrame:
    """The map of each chunk's own segments: chunk_tag, src_id, dst_id."""
    return chunk_segs.select("chunk_tag", F.col(key).alias("src_id")).join(id_map, "src_id").select("chunk_tag", "src_id", "dst_id")


def of_partner_bucket(segs: DataFrame, edges: DataFrame, buckets: int, which: int, key: str = SEGMENT) -> DataFrame:
    """Segments with an edge whose partners hash to a bucket, each once."""
    wanted = edges.where(partner_bucket([F.col(PRE), F.col(POST)], buckets) == which)
    return segs.join(wanted.select(key).distinct(), key, "left_semi")


def add_locations(edges: DataFrame, voxels: DataFrame, column: str, key: str = SEGMENT) -> DataFrame:
    """Edges with the centroid of their segment; edges of segments without a voxel go."""
    centre = describe(voxels, column).select(F.col(column).alias(key), *CENTROID)
    return edges.join(centre, key)


def add_sizes(edges: DataFrame, voxels: DataFrame, column: str, key: str = SEGMENT) -> DataFrame:
    """Edges with the size of their segment; a segment without a voxel is an error."""
    found = edges.join(sizes(voxels, column).withColumnRenamed(column, key), key, "left")
    return found.withColumn("size", F.coalesce("size", F.raise_error(F.lit("an edge's segment has no voxel")).cast("long")))


def keep_least(rows: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """One row for each value of keys: that of the least row id. Nulls are equal here."""
    rest = [c for c in rows.columns if c not in (row_id, *keys)]
    best = F.min(F.struct(row_id, *rest))
    return rows.groupBy(*keys).agg(best.alias("__b")).select(*(F.col(c) if c in keys else F.col(f"__b.{c}").alias(c) for c in rows.columns))


def merge_by(df: DataFrame, id_map: DataFrame, key: str, fold, schema: str) -> DataFrame:
    """Fold the rows of each new id with a function from a pandas frame to a frame of one row. A group, the fragments of one segment, is in one task."""
    named = df.join(id_map.select(F.col("src_id").alias(key), "dst_id"), key, "left").withColumn(key, F.coalesce("dst_id", key)).drop("dst_id")

    def run(rows):
        out = fold(rows)
        out.insert(0, key, rows[key].iloc[0])
        return out

    return named.groupBy(key).applyInPandas(run, f"{key} {named.schema[key].dataType.simpleString()}, {schema}")
