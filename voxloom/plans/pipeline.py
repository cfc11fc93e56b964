"""The fixed multi-stage plans: components by chunk, merging across chunks, edges, remapping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import chunk_tag
from ..functions.hashing import bucket, partner_bucket
from ..operators import edges as E
from ..operators import anchors, idmaps, inference, overlap, segments
from ..operators import voxels as V
from ..schema import POST, PRE, SEGMENT


@dataclass(frozen=True)
class Settings:
    """Parsed settings of a run; shapes are checked as they are set: positive, chunks of whole blocks, patches within chunks."""

    volume: tuple[int, int, int]
    chunk: tuple[int, int, int]
    offset: tuple[int, int, int] = (0, 0, 0)
    resolution: tuple[int, int, int] = (4, 4, 40)
    threshold: float = 0.5
    size_threshold: int = 0
    duplicate_distance: float = 1000.0
    buckets: int = 1
    block: tuple[int, int, int] = (1, 1, 1)
    patch: tuple[int, int, int] = (1, 1, 1)
    storage: str = ""

    def __post_init__(self):
        if any(c <= 0 or v <= 0 for c, v in zip(self.chunk, self.volume, strict=True)):
            raise ValueError("shapes must be positive")
        if any(c % b for c, b in zip(self.chunk, self.block, strict=True)):
            raise ValueError("a chunk must be whole storage blocks")
        if any(p > c for p, c in zip(self.patch, self.chunk, strict=True)):
            raise ValueError("a patch must fit into a chunk")

    @classmethod
    def read(cls, text: str) -> Settings:
        """From an INI text: one section or several, shapes as comma-separated numbers."""
        import configparser

        parser = configparser.ConfigParser()
        parser.read_string(text)
        flat = {k: v for s in parser.sections() for k, v in parser[s].items()}
        shape = lambda k: tuple(int(x) for x in flat[k].split(","))
        kinds = {"volume": shape, "chunk": shape, "offset": shape, "resolution": shape, "threshold": lambda k: float(flat[k]), "size_threshold": lambda k: int(flat[k]), "duplicate_distance": lambda k: float(flat[k]), "buckets": lambda k: int(flat[k]), "block": shape, "patch": shape, "storage": lambda k: flat[k]}
        return cls(**{k: f(k) for k, f in kinds.items() if k in flat})


def tagged(voxels: DataFrame, chunk: tuple[int, int, int]) -> DataFrame:
    """Voxels with the tag of their chunk."""
    begin = [(F.floor(F.col(a) / n) * n).cast("long") for a, n in zip("xyz", chunk, strict=True)]
    return voxels.withColumn("chunk_tag", chunk_tag(begin, [b + n for b, n in zip(begin, chunk, strict=True)]))


def chunk_components(voxels: DataFrame, s: Settings, base: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per chunk: labelled voxels, face voxels, segment table. Segments that touch a face are kept at any size.

    Labels are the components' plus one: 0 is no segment.
    """
    mask = tagged(V.threshold(voxels, s.threshold), s.chunk)
    labelled = V.components(mask, base=base, chunk=["chunk_tag"]).withColumn("label", F.col("label") + 1)
    faces = V.faces(labelled, "label", s.chunk)
    info = V.describe(labelled, "label")
    touching = faces.select(F.col("segid").alias("label")).distinct()
    small = info.where(F.col("size") < s.size_threshold).join(touching, "label", "left_anti").select("label")
    return labelled.join(small, "label", "left_anti"), faces, info.join(small, "label", "left_anti").withColumnRenamed("label", SEGMENT)


def merge_components(faces: DataFrame, info: DataFrame, s: Settings, base: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Across chunks: merged segment table, and the id map with small segments sent to 0."""
    graph = V.match_faces(faces)
    if base is not None:
        graph = segments.same_base(graph, base)
    id_map = segments.merge_map(graph, info, SEGMENT)
    merged = segments.merge(info, id_map)
    kept, dropped = idmaps.by_size(merged, s.size_threshold)
    return kept, idmaps.compose(id_map, dropped, reused_ids=True)


def hashed_edges(edges: DataFrame, buckets: int) -> DataFrame:
    return edges.withColumn("partnerhash", partner_bucket([F.col(PRE), F.col(POST)], buckets)).withColumn("clefthash", bucket([F.col(SEGMENT)], buckets))


def merge_edges(chunk_edges: DataFrame, segs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The largest fragment's edge of each segment, joined to it; duplicates merged, small ones dropped: final table and id map."""
    return E.merge_duplicates(segs, E.pick_largest(chunk_edges), s.duplicate_distance, s.size_threshold, s.resolution)


def merge_overlaps(chunk_overlaps: DataFrame) -> DataFrame:
    return overlap.largest(overlap.consolidate(chunk_overlaps))


def remap(labelled: DataFrame, maps: list[DataFrame], column: str) -> DataFrame:
    """Voxel ids through maps in order, composed first so that the voxels are read once; id 0 goes."""
    whole = maps[0]
    for m in maps[1:]:
        whole = idmaps.compose(whole, m, reused_ids=True)
    return idmaps.apply(labelled, whole, column).where(F.col(column) != 0)


def edge_task(voxels: DataFrame, id_map: DataFrame | None, network, shape: tuple[int, int, int], volume: tuple[int, int, int], k: int, buckets: int, kind: str = "centroid", **options) -> DataFrame:
    """Edges of the clefts of a chunk: records with cleft size, partner hash and cleft hash.

    voxels: x, y, z, val, cleft, segid. id_map: of segment ids, applied first. network, shape, k: as in
    inference.infer_weights(). options: as in inference.infer_edges().
    """
    own = idmaps.apply(voxels, id_map.select("src_id", "dst_id"), "segid") if id_map is not None else voxels
    where = inference.locations(own, "cleft", kind, shape, volume).withColumnRenamed("cleft", SEGMENT)
    found = inference.infer_edges(inference.infer_weights(own, where, network, shape, volume, k), **options)
    return hashed_edges(segments.add_sizes(found, own, "cleft"), buckets)


def anchor_task(clefts: DataFrame, segs: DataFrame, edges: DataFrame, volume: tuple[int, int, int], offset: tuple[int, int, int] = (0, 0, 0), **options) -> DataFrame:
    """Anchors of the clefts of a chunk, moved by its offset."""
    return anchors.offset_record(anchors.place_anchors(clefts, segs, edges, volume, **options), offset)
