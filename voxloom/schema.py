"""Table schemas and column groups."""

from pyspark.sql import types as T

AXES = ("x", "y", "z")
SEGMENT, PRE, POST = "cleft_segid", "presyn_segid", "postsyn_segid"
CENTROID = [f"centroid_{a}" for a in AXES]
BOX_BEGIN, BOX_END = [f"bbox_b{a}" for a in AXES], [f"bbox_e{a}" for a in AXES]
PRE_AT, POST_AT = [f"presyn_{a}" for a in AXES], [f"postsyn_{a}" for a in AXES]


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def _double(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


CHUNK_TAG = T.StructField("chunk_tag", T.StringType())
VOXELS = T.StructType([*_long(*AXES), T.StructField("val", T.DoubleType()), CHUNK_TAG])
SEGMENTS = T.StructType([*_long(SEGMENT, "size"), *_double(*CENTROID), *_long(*BOX_BEGIN, *BOX_END)])
CHUNK_SEGMENTS = T.StructType([*SEGMENTS.fields, CHUNK_TAG])
EDGES = T.StructType([*_long(SEGMENT, PRE, POST, "size", *PRE_AT, *POST_AT)])
CHUNK_EDGES = T.StructType([*EDGES.fields, *_long("clefthash", "partnerhash"), CHUNK_TAG])
ID_MAP = T.StructType(_long("src_id", "dst_id"))
OVERLAPS = T.StructType(_long("row_id", "col_id", "vals"))
CONTINUATION_GRAPH = T.StructType(_long("graph_id1", "graph_id2"))
TIMINGS = T.StructType([T.StructField("task_name", T.StringType()), T.StructField("timing_tag", T.StringType()), *_double("duration")])

FACES = T.StructType([CHUNK_TAG, *_long("fx", "fy", "fz"), T.StructField("axis", T.IntegerType()), T.StructField("hi_face", T.BooleanType()), *_long("i", "j", "segid")])
FULL = T.StructType([*SEGMENTS.fields, *_long(PRE, POST, *PRE_AT, *POST_AT)])
CHUNKS = T.StructType([*_long(*(f"{n}_{a}" for n in ("begin", "end") for a in AXES)), CHUNK_TAG])
CHUNK_ID_MAP = T.StructType([*ID_MAP.fields, T.StructField("dst_id_hash", T.LongType()), CHUNK_TAG])

TABLES = {
    "chunks": CHUNKS, "contin_faces": FACES, "full_info": FULL, "chunked_seg_merge_map": CHUNK_ID_MAP,
    "chunk_segs": CHUNK_SEGMENTS, "merged_segs": SEGMENTS, "chunk_edges": CHUNK_EDGES, "merged_edges": EDGES, "seg_merge_map": ID_MAP,
    "dup_merge_map": ID_MAP, "chunk_overlaps": T.StructType([*OVERLAPS.fields, CHUNK_TAG]), "max_overlaps": OVERLAPS, "contin_graph": CONTINUATION_GRAPH, "timing_log": TIMINGS,
}
