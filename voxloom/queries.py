"""Registered queries of the volume, segment and edge operators, each with its SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry as G
from .functions.hashing import FACTOR, PRIME, SHIFT, partner_bucket
from .operators import candidates, edges, evaluate, idmaps, norm, overlap, segments, voxels
from .operators.graph import connected_components
from .plans.fixtures import table, with_tables
from .schema import BOX_BEGIN, BOX_END, CENTROID, POST, POST_AT, PRE, PRE_AT, SEGMENT
from .storage import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
DISTANCE = 200  # of duplicates, in physical units
CHUNK = (10, 10, 10)


def _query(needs: str, sql: str | None, recursive: bool = False):
    """Register a query over derived tables, given to it in order, and its SQL."""

    def add(f: Callable[..., DataFrame]):
        names = needs.split()
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(table(spark, sf_dir, n) for n in names))
        if sql is not None:
            ORACLE_SQL[f.__name__] = with_tables(names, sql, recursive)
        return f

    return add


_CHUNK_TAG = "concat(10*CAST(floor(x/10) AS BIGINT), '_', 10*CAST(floor(y/10) AS BIGINT), '_', 10*CAST(floor(z/10) AS BIGINT), '-', 10*CAST(floor(x/10) AS BIGINT)+10, '_', 10*CAST(floor(y/10) AS BIGINT)+10, '_', 10*CAST(floor(z/10) AS BIGINT)+10)"
_COUNTS = "WITH o AS (SELECT seg_id AS row_id, gt_id AS col_id, count(*) AS vals FROM voxels WHERE seg_id <> 0 AND gt_id <> 0 GROUP BY 1, 2)"


@_query("voxels", f"SELECT {_CHUNK_TAG} AS chunk_tag, seg_id AS row_id, gt_id AS col_id, count(*) AS vals FROM voxels WHERE seg_id <> 0 AND gt_id <> 0 GROUP BY 1, 2, 3")
def overlap_counts(v):
    from .plans.pipeline import tagged

    return overlap.count(tagged(v, CHUNK), "seg_id", "gt_id", ["chunk_tag"])


@_query("voxels", f"{_COUNTS} SELECT * FROM o")
def overlap_consolidate(v):
    return overlap.consolidate(overlap_counts(v))


_LARGEST = "SELECT row_id, col_id, vals FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY vals DESC, col_id) AS r FROM o) WHERE r = 1"


@_query("voxels", f"{_COUNTS} {_LARGEST}")
def overlap_argmax(v):
    return overlap.largest(overlap_consolidate(v))


@_query("voxels", "SELECT seg_id, count(*) AS size FROM voxels WHERE seg_id <> 0 GROUP BY 1")
def seg_sizes(v):
    return voxels.sizes(v, "seg_id")


_STATS = "count(*) AS size, " + ", ".join(f"CAST(round(sum({a})/count(*)) AS BIGINT) AS centroid_{a}, CAST(min({a}) AS BIGINT) AS bbox_b{a}, CAST(max({a}) + 1 AS BIGINT) AS bbox_e{a}" for a in "xyz")


@_query("voxels", f"SELECT seg_id, {_STATS} FROM voxels WHERE seg_id <> 0 GROUP BY 1")
def seg_describe(v):
    return voxels.describe(v, "seg_id")


@_query("voxels", "SELECT DISTINCT seg_id FROM voxels WHERE seg_id <> 0")
def nonzero_unique_ids(v):
    return voxels.nonzero_ids(v, "seg_id")


@_query("voxels", "SELECT x, y, z, seg_id FROM voxels WHERE seg_id IN (SELECT seg_id FROM voxels WHERE seg_id <> 0 GROUP BY 1 HAVING count(*) >= 64 OR seg_id % 10 = 0)")
def filter_by_size(v):
    return voxels.filter_by_size(v.select("x", "y", "z", "seg_id"), "seg_id", 64, v.where("seg_id != 0 and seg_id % 10 = 0").select("seg_id").distinct())


@_query("voxels", "SELECT x, y, z, seg_id FROM voxels WHERE seg_id <> 0 AND seg_id % 3 <> 0")
def filter_by_id(v):
    return voxels.filter_by_id(v.where("seg_id != 0").select("x", "y", "z", "seg_id"), "seg_id", v.where("seg_id % 3 = 0").select("seg_id"))


@_query("voxels", "SELECT x, y, z, val FROM voxels WHERE val > 80 AND x >= 3 AND x < 12 AND y >= 0 AND y < 7 AND z >= 2 AND z < 9")
def box_threshold(v):
    return voxels.threshold(voxels.box_scan(v, (3, 0, 2), (12, 7, 9)), 80).select("x", "y", "z", "val")


@_query("voxels", "SELECT v.x, v.y, v.z, v.seg_id FROM voxels v WHERE base_id <> 0 AND seg_id <> 0")
def mask_apply(v):
    return voxels.apply_mask(v.where("seg_id != 0").select("x", "y", "z", "seg_id"), v.where("base_id != 0"))


def _merged_sql(centre: str) -> str:
    alone = ", ".join(f"CAST(min({c}) AS DOUBLE) AS {c}" for c in CENTROID)
    mean = ", ".join(f"{centre.format(c=c)} AS {c}" for c in CENTROID)
    box = ", ".join([f"CAST(min({c}) AS BIGINT) AS {c}" for c in BOX_BEGIN] + [f"CAST(max({c}) AS BIGINT) AS {c}" for c in BOX_END])
    return f"""SELECT dst_id AS cleft_segid, CAST(sum(size) AS BIGINT) AS size, {mean}, {box} FROM seg_info WHERE dst_id IS NOT NULL GROUP BY dst_id
UNION ALL SELECT cleft_segid, CAST(sum(size) AS BIGINT) AS size, {alone}, {box} FROM seg_info WHERE dst_id IS NULL GROUP BY cleft_segid"""


@_query("seg_info", _merged_sql("trunc(sum({c} * size)::DOUBLE / sum(size)::DOUBLE)"))
def merge_seginfo(s):
    return segments.merge(s, s.where("dst_id is not null").select(F.col(SEGMENT).alias("src_id"), "dst_id"))


@_query("seg_info", "SELECT cleft_segid AS src_id, CAST(0 AS BIGINT) AS dst_id FROM seg_info WHERE size < 100")
def size_threshold_map(s):
    return idmaps.by_size(s, 100)[1]


@_query("seg_info", "SELECT cleft_segid, size FROM seg_info WHERE size >= 100")
def size_threshold_keep(s):
    return idmaps.by_size(s, 100)[0].select(SEGMENT, "size")


@_query("voxels id_map", "SELECT x, y, z, coalesce(dst_id, seg_id) AS seg_id FROM voxels LEFT JOIN id_map ON seg_id = src_id")
def idmap_apply(v, m):
    return idmaps.apply(v.select("x", "y", "z", "seg_id"), m, "seg_id")


@_query("voxels", "SELECT x, y, z, seg_id, base_id, CASE WHEN base_id < 4 AND seg_id <> 0 THEN seg_id * 8 + base_id ELSE 0 END AS paired FROM voxels")
def idmap_apply_paired(v):
    pairs = v.where("base_id < 4 and seg_id != 0").select("seg_id", "base_id").distinct().withColumn("dst_id", F.col("seg_id") * 8 + F.col("base_id"))
    return idmaps.apply_paired(v.select("x", "y", "z", "seg_id", "base_id"), pairs, "seg_id", "base_id", "paired")


_COMPOSE = """WITH nx AS (SELECT dst_id AS src_id, min(src_id) + 100000 AS dst_id FROM id_map WHERE dst_id % 3 = 1 GROUP BY 1 UNION ALL SELECT cleft_segid + 50000, cleft_segid FROM seg_info WHERE cleft_segid % 7 = 0),
a AS (SELECT m.src_id, coalesce(n.dst_id, m.dst_id) AS dst_id FROM id_map m LEFT JOIN nx n ON m.dst_id = n.src_id)"""


def _next_map(m, s):
    one = m.where("dst_id % 3 = 1").groupBy(F.col("dst_id").alias("src_id")).agg((F.min("src_id") + 100000).alias("to")).select("src_id", F.col("to").alias("dst_id"))
    return one.unionByName(s.where("cleft_segid % 7 = 0").select((F.col(SEGMENT) + 50000).alias("src_id"), F.col(SEGMENT).alias("dst_id")))


@_query("id_map seg_info", f"{_COMPOSE}, b AS (SELECT * FROM nx WHERE src_id NOT IN (SELECT dst_id FROM id_map)) SELECT * FROM a WHERE src_id NOT IN (SELECT src_id FROM b) UNION ALL SELECT * FROM b")
def idmap_compose(m, s):
    return idmaps.compose(m, _next_map(m, s))


@_query("id_map seg_info", f"{_COMPOSE} SELECT * FROM a")
def idmap_compose_reused(m, s):
    return idmaps.compose(m, _next_map(m, s), reused_ids=True)


@_query("id_map seg_info", "SELECT cleft_segid AS src_id, coalesce(m.dst_id, cleft_segid) AS dst_id FROM seg_info s LEFT JOIN id_map m ON cleft_segid = src_id")
def idmap_expand(m, s):
    return idmaps.expand(m, s, SEGMENT)


@_query("id_map seg_info", "SELECT m.* FROM id_map m WHERE src_id IN (SELECT cleft_segid FROM seg_info WHERE size < 50)")
def idmap_filtered(m, s):
    return idmaps.filtered(m, s.where("size < 50").select(F.col(SEGMENT).alias("src_id")))


@_query("seg_info id_map", "SELECT cleft_segid, coalesce(m.dst_id, s.dst_id) AS dst_id, size FROM seg_info s LEFT JOIN id_map m ON cleft_segid = src_id")
def idmap_overlay(s, m):
    return idmaps.overlay(s.select(SEGMENT, "dst_id", "size"), m.withColumnRenamed("src_id", SEGMENT), SEGMENT)


@_query("seg_info", "SELECT cleft_segid, chunk_tag, row_number() OVER (ORDER BY chunk_tag, cleft_segid) AS new_id FROM seg_info")
def unique_ids(s):
    return idmaps.serial_ids(s.select(SEGMENT, "chunk_tag"), ["chunk_tag"], SEGMENT).withColumn("new_id", F.col("new_id").cast("long")).select(SEGMENT, "chunk_tag", "new_id")


@_query("voxels", "SELECT x, y, z, dense_rank() OVER (ORDER BY seg_id) AS new_id FROM voxels WHERE seg_id <> 0")
def relabel_1n(v):
    return idmaps.dense_ids(v.where("seg_id != 0").select("x", "y", "z", "seg_id"), ["seg_id"], "new_id").select("x", "y", "z", F.col("new_id").cast("long").alias("new_id"))


@_query("voxels", "SELECT x, y, z, dense_rank() OVER (ORDER BY gt_id, seg_id) AS new_id FROM voxels WHERE seg_id <> 0 AND gt_id <> 0")
def split_by_overlap(v):
    return idmaps.dense_ids(v.where("seg_id != 0 and gt_id != 0").select("x", "y", "z", "seg_id", "gt_id"), ["gt_id", "seg_id"], "new_id").select("x", "y", "z", F.col("new_id").cast("long").alias("new_id"))


def _faces_sql() -> str:
    parts = []
    for k, a in enumerate("xyz"):
        i, j = (c for c in "xyz" if c != a)
        for hi in (True, False):
            corner = ", ".join(f"10*CAST(floor({c}/10) AS BIGINT){' + 10' if hi and c == a else ''} AS f{c}" for c in "xyz")
            parts.append(f"SELECT {corner}, {k} AS axis, {'true' if hi else 'false'} AS hi_face, CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, seg_id AS segid FROM voxels WHERE seg_id <> 0 AND {a} % 10 = {9 if hi else 0}")
    return " UNION ALL ".join(parts)


@_query("voxels", _faces_sql())
def faces(v):
    return voxels.faces(v, "seg_id", CHUNK)


@_query("voxels", f"WITH f AS ({_faces_sql()}) SELECT DISTINCT a.segid AS graph_id1, b.segid AS graph_id2 FROM f a JOIN f b USING (fx, fy, fz, axis, i, j) WHERE a.hi_face AND NOT b.hi_face")
def face_match(v):
    return voxels.match_faces(voxels.faces(v, "seg_id", CHUNK))


@_query("voxels", f"""{_COUNTS}, f AS ({_faces_sql()}), b AS ({_LARGEST}), g AS (SELECT DISTINCT a.segid AS graph_id1, b.segid AS graph_id2 FROM f a JOIN f b USING (fx, fy, fz, axis, i, j) WHERE a.hi_face AND NOT b.hi_face)
SELECT graph_id1, graph_id2 FROM g JOIN b p ON graph_id1 = p.row_id JOIN b q ON graph_id2 = q.row_id WHERE p.col_id = q.col_id""")
def face_match_same_base(v):
    return segments.same_base(face_match(v), overlap_argmax(v))


@_query("contin_graph", """WITH n AS (SELECT graph_id1, graph_id1 - row_number() OVER (ORDER BY graph_id1) AS g FROM contin_graph)
SELECT graph_id1 AS id, min(graph_id1) OVER (PARTITION BY g) AS component FROM n UNION ALL SELECT max(graph_id1) + 1, min(graph_id1) FROM n GROUP BY g""")
def graph_cc(g):
    return connected_components(g, "graph_id1", "graph_id2")


@_query("contin_graph seg_info", """WITH n AS (SELECT graph_id1, graph_id1 - row_number() OVER (ORDER BY graph_id1) AS g FROM contin_graph),
c AS (SELECT graph_id1 AS id, min(graph_id1) OVER (PARTITION BY g) AS component FROM n UNION ALL SELECT max(graph_id1) + 1, min(graph_id1) FROM n GROUP BY g)
SELECT cleft_segid AS src_id, coalesce(component, cleft_segid) AS dst_id FROM seg_info LEFT JOIN c ON cleft_segid = id""")
def seg_merge_map(g, s):
    return segments.merge_map(g, s, SEGMENT)


@_query("voxels", """, m AS MATERIALIZED (SELECT x + 20*y + 400*z AS id, x, y, z FROM voxels WHERE val > 80),
e AS MATERIALIZED (SELECT a.id s, b.id d FROM m a JOIN m b ON abs(a.x-b.x)+abs(a.y-b.y)+abs(a.z-b.z) = 1 AND b.x BETWEEN a.x-1 AND a.x+1),
r(id, lab) AS (SELECT id, id FROM m UNION SELECT e.d, r.lab FROM r JOIN e ON e.s = r.id)
SELECT x, y, z, CAST(min(lab) AS BIGINT) AS label FROM r JOIN m USING (id) GROUP BY x, y, z""".replace(", m AS", "WITH m AS", 1), recursive=True)
def voxel_components(v):
    found = voxels.components(voxels.threshold(v, 80).select("x", "y", "z"))
    return found.select("x", "y", "z", voxels.linear_index(F.col("label"), (20, 20, 1)).alias("label"))


_PICK = "WITH p AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY cleft_segid ORDER BY size DESC, presyn_segid NULLS FIRST, postsyn_segid, presyn_x, presyn_y, presyn_z, postsyn_x, postsyn_y, postsyn_z, chunk_tag) AS r FROM chunk_edges) WHERE r = 1)"


@_query("chunk_edges", f"{_PICK} SELECT * FROM p")
def pick_largest_edge(e):
    return edges.pick_largest(e)


_FULL = f"{_PICK}, f AS MATERIALIZED (SELECT cleft_segid, s.size, {', '.join([*CENTROID, *BOX_BEGIN, *BOX_END])}, presyn_segid, postsyn_segid FROM seg_info s JOIN p USING (cleft_segid))"


def _full(s, e):
    return edges.to_segments(s.drop("dst_id", "chunk_tag"), edges.pick_largest(e.select(SEGMENT, PRE, POST, "size")))  # partners decide first of equal sizes


@_query("seg_info chunk_edges", f"{_FULL} SELECT * FROM f")
def edges_to_segments(s, e):
    return _full(s, e)


_NEAR = f"pow((a.centroid_x - b.centroid_x) * 4, 2) + pow((a.centroid_y - b.centroid_y) * 4, 2) + pow((a.centroid_z - b.centroid_z) * 40, 2) < {DISTANCE * DISTANCE}"
_PAIRS = f"{_FULL}, d AS MATERIALIZED (SELECT a.cleft_segid AS id1, b.cleft_segid AS id2 FROM f a JOIN f b ON a.presyn_segid = b.presyn_segid AND a.postsyn_segid = b.postsyn_segid AND a.cleft_segid < b.cleft_segid AND {_NEAR})"


@_query("seg_info chunk_edges", f"{_PAIRS} SELECT * FROM d")
def duplicate_pairs(s, e):
    return edges.near_pairs(_full(s, e), DISTANCE, [PRE, POST])


_CC = f"{_PAIRS}, b AS (SELECT id1 AS s, id2 AS t FROM d UNION ALL SELECT id2, id1 FROM d), r(id, lab) AS (SELECT DISTINCT s, s FROM b UNION SELECT b.t, r.lab FROM r JOIN b ON b.s = r.id), c AS (SELECT id AS src_id, min(lab) AS dst_id FROM r GROUP BY id)"


@_query("seg_info chunk_edges", f"{_CC} SELECT src_id, dst_id FROM c", recursive=True)
def duplicate_map(s, e):
    return edges.duplicate_map(_full(s, e), DISTANCE)


_MERGED = f"""{_CC}, m AS (SELECT coalesce(dst_id, cleft_segid) AS id, f.* FROM f LEFT JOIN c ON cleft_segid = src_id)
SELECT id AS cleft_segid, CAST(sum(size) AS BIGINT) AS size, {", ".join(f"sum({c} * size)::DOUBLE / sum(size)::DOUBLE AS {c}" for c in CENTROID)}, {", ".join([f"CAST(min({c}) AS BIGINT) AS {c}" for c in BOX_BEGIN] + [f"CAST(max({c}) AS BIGINT) AS {c}" for c in BOX_END])},
  arg_min(coalesce(presyn_segid, -1), size * 1000000 + cleft_segid) AS presyn_segid, arg_min(postsyn_segid, size * 1000000 + cleft_segid) AS postsyn_segid FROM m GROUP BY id HAVING sum(size) >= 100"""


@_query("seg_info chunk_edges", _MERGED, recursive=True)
def merge_duplicates(s, e):
    kept, _ = edges.merge_duplicates(s.drop("dst_id", "chunk_tag"), edges.pick_largest(e).select(SEGMENT, PRE, POST, "size"), DISTANCE, 100)
    return kept.withColumn(PRE, F.coalesce(PRE, F.lit(-1)))


@_query("chunk_edges", "SELECT cleft_segid, presyn_segid, postsyn_segid FROM chunk_edges WHERE presyn_segid = postsyn_segid")
def self_loops(e):
    return edges.self_loops(e).select(SEGMENT, PRE, POST)


@_query("chunk_edges", "SELECT cleft_segid, presyn_x, postsyn_x FROM chunk_edges WHERE pow((presyn_x-postsyn_x)*4, 2) + pow((presyn_y-postsyn_y)*4, 2) + pow((presyn_z-postsyn_z)*40, 2) > 250000")
def far_anchors(e):
    return edges.far_apart(e, PRE_AT, POST_AT, 500).select(SEGMENT, "presyn_x", "postsyn_x")


@_query("chunk_edges", f"""WITH k AS (SELECT DISTINCT presyn_segid, postsyn_segid, presyn_segid || ',' || postsyn_segid AS p FROM chunk_edges)
SELECT presyn_segid, postsyn_segid, CASE WHEN p IS NULL THEN -1 ELSE CAST(({FACTOR}::HUGEINT * list_reduce(list_concat([0::HUGEINT], list_transform(generate_series(length(p), 1, -1), lambda i: ascii(substr(p, i, 1))::HUGEINT)), lambda acc, v: (acc*256 + v) % {PRIME}) + {SHIFT}) % {PRIME} % 1000 AS BIGINT) END AS partnerhash FROM k""")
def partner_hash(e):
    return e.select(PRE, POST).distinct().withColumn("partnerhash", partner_bucket([F.col(PRE), F.col(POST)], 1000))


@_query("seg_scores", "SELECT cleft_segid, (SELECT segid FROM seg_scores b WHERE b.cleft_segid = a.cleft_segid ORDER BY pre DESC, segid LIMIT 1) AS presyn_segid, (SELECT segid FROM seg_scores b WHERE b.cleft_segid = a.cleft_segid ORDER BY post DESC, segid LIMIT 1) AS postsyn_segid FROM (SELECT DISTINCT cleft_segid FROM seg_scores) a")
def assign_max(s):
    return edges.assign_by_max(s)


@_query("seg_scores", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY cleft_segid ORDER BY pre DESC, segid) AS k, max(pre) OVER (PARTITION BY cleft_segid) AS top FROM seg_scores)
SELECT a.cleft_segid, a.segid AS presyn_segid, b.segid AS postsyn_segid FROM r a JOIN seg_scores b USING (cleft_segid) WHERE (a.pre > 95 OR (a.k = 1 AND a.top <= 95)) AND b.post > 180""")
def assign_threshold(s):
    return edges.assign_by_threshold(s, 95, 180)


@_query("seg_scores", "SELECT cleft_segid, segid, pre::DOUBLE / (sum(pre) OVER (PARTITION BY cleft_segid))::DOUBLE AS pre FROM seg_scores")
def normalized_scores(s):
    return edges.normalize(s.select(SEGMENT, "segid", "pre"), "pre")


@_query("seg_scores", "SELECT cleft_segid, segid, pre * 0.25::DOUBLE + post * 0.75::DOUBLE AS mixed FROM seg_scores")
def mixed_scores(s):
    return s.select(SEGMENT, "segid", edges.mix(F.col("pre"), F.col("post"), 0.25).alias("mixed"))


@_query("chunk_edges", "SELECT presyn_segid, count(DISTINCT cleft_segid) AS clefts, CAST(sum(DISTINCT cleft_segid) AS BIGINT) AS total FROM chunk_edges WHERE presyn_segid IS NOT NULL GROUP BY 1")
def polyad_groups(e):
    return e.where(F.col(PRE).isNotNull()).groupBy(PRE).agg(F.count_distinct(SEGMENT).alias("clefts"), F.sum_distinct(F.col(SEGMENT)).alias("total"))


@_query("voxels", """WITH h AS (SELECT CAST(floor(x/2) AS BIGINT) AS x, CAST(floor(y/2) AS BIGINT) AS y, z, coalesce(max(seg_id) FILTER (x%2=0 AND y%2=0), 0) AS a, coalesce(max(seg_id) FILTER (x%2=1 AND y%2=0), 0) AS b, coalesce(max(seg_id) FILTER (x%2=0 AND y%2=1), 0) AS c, coalesce(max(seg_id) FILTER (x%2=1 AND y%2=1), 0) AS d FROM voxels GROUP BY 1, 2, 3),
m AS (SELECT x, y, z, CASE WHEN a = b OR a = c THEN a WHEN b = c THEN b ELSE d END AS seg_id FROM h) SELECT * FROM m WHERE seg_id <> 0""")
def countless_downsample(v):
    return voxels.downsample(v.select("x", "y", "z", "seg_id"), "seg_id")


@_query("voxels", "SELECT CAST(2*x + dx AS BIGINT) AS x, CAST(2*y + dy AS BIGINT) AS y, z, seg_id FROM voxels, (VALUES (0), (1)) p(dx), (VALUES (0), (1)) q(dy) WHERE seg_id <> 0")
def upsample2d(v):
    return voxels.upsample(v.where("seg_id != 0"), "seg_id")


def _surface_sql(axes: str) -> str:
    steps = ", ".join(f"({', '.join(str(d) if k == a else '0' for k in 'xyz')})" for a in axes for d in (-1, 1))
    return f"""SELECT DISTINCT v.x, v.y, v.z, v.seg_id FROM voxels v CROSS JOIN (VALUES {steps}) s(dx, dy, dz) LEFT JOIN voxels n ON n.x = v.x + dx AND n.y = v.y + dy AND n.z = v.z + dz
WHERE v.seg_id <> 0 AND v.x + dx BETWEEN 0 AND 19 AND v.y + dy BETWEEN 0 AND 19 AND v.z + dz BETWEEN 0 AND (SELECT max(z) FROM voxels) AND coalesce(n.seg_id, 0) <> v.seg_id"""


_EXTENT = lambda v: ((0, 0, 0), (20, 20, v.agg(F.max("z")).first()[0] + 1))


@_query("voxels", _surface_sql("xyz"))
def surfaces3d(v):
    return voxels.surfaces(v.where("seg_id != 0").select("x", "y", "z", "seg_id"), "seg_id", volume=_EXTENT(v))


@_query("voxels", _surface_sql("xy"))
def surfaces2d(v):
    return voxels.surfaces(v.where("seg_id != 0").select("x", "y", "z", "seg_id"), "seg_id", "xy", _EXTENT(v))


@_query("voxels", """WITH m AS (SELECT x, y, z, seg_id FROM voxels WHERE val > 80 AND seg_id <> 0), o AS (SELECT dx, dy, abs(dx) + abs(dy) AS d FROM (SELECT unnest(range(-2, 3)) AS dx), (SELECT unnest(range(-2, 3)) AS dy) WHERE abs(dx) + abs(dy) <= 2),
g AS (SELECT x + dx AS x, y + dy AS y, z, seg_id, d FROM m, o WHERE x + dx BETWEEN 0 AND 19 AND y + dy BETWEEN 0 AND 19)
SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, z, seg_id, CAST(d AS BIGINT) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY d, seg_id) AS r FROM g) WHERE r = 1""")
def dilate_k(v):
    return voxels.dilate(v.where("val > 80").select("x", "y", "z", "seg_id"), "seg_id", 2, (0, 0), (20, 20))


QUERIES["chunk_grid"] = lambda spark, sf_dir: G.chunk_grid(spark, (50, 40, 21), (16, 16, 10), (3, -5, 0))
ORACLE_SQL["chunk_grid"] = """WITH g AS (SELECT 3 + 16*a AS bx, -5 + 16*b AS by_, 10*c AS bz, least(3 + 16*a + 16, 53) AS ex, least(-5 + 16*b + 16, 35) AS ey, least(10*c + 10, 21) AS ez
  FROM (SELECT unnest(range(0, 4)) AS a), (SELECT unnest(range(0, 3)) AS b), (SELECT unnest(range(0, 3)) AS c))
SELECT bx AS begin_x, ex AS end_x, by_ AS begin_y, ey AS end_y, bz AS begin_z, ez AS end_z, concat(bx, '_', by_, '_', bz, '-', ex, '_', ey, '_', ez) AS chunk_tag FROM g"""


@_query("seg_info", "SELECT cleft_segid, concat(bbox_bx, '_', bbox_by, '_', bbox_bz, '-', bbox_ex, '_', bbox_ey, '_', bbox_ez) AS tag, bbox_bx, bbox_ez FROM seg_info")
def tag_codec(s):
    tagged = s.select(SEGMENT, G.chunk_tag([F.col(c) for c in BOX_BEGIN], [F.col(c) for c in BOX_END]).alias("tag")).withColumn("b", G.parse_chunk_tag(F.col("tag")))
    return tagged.select(SEGMENT, "tag", F.col("b.min.x").alias("bbox_bx"), F.col("b.max.z").alias("bbox_ez"))


@_query("seg_info", "SELECT cleft_segid, (2::BIGINT << 56) | (centroid_x << 46) | (centroid_y << 36) | (centroid_z << 26) AS chunk_id, centroid_y AS y FROM seg_info")
def pcg_chunk_ids(s):
    packed = s.select(SEGMENT, G.pcg_chunk_id(F.lit(2), *(F.col(c) for c in CENTROID), 10).alias("chunk_id"))
    return packed.withColumn("y", G.pcg_unpack(F.col("chunk_id"), 10)["y"])


_MULTI = """WITH p AS (SELECT cleft_segid, presyn_segid, postsyn_segid, count(*) AS n FROM edge_preds GROUP BY ALL), t AS (SELECT cleft_segid, presyn_segid, postsyn_segid, count(*) AS m FROM edge_labels GROUP BY ALL)"""


@_query("edge_preds edge_labels", f"""{_MULTI}, c AS (SELECT CAST((SELECT sum(least(n, m)) FROM p JOIN t USING (cleft_segid, presyn_segid, postsyn_segid)) AS BIGINT) AS tp, CAST((SELECT sum(n) FROM p) AS BIGINT) AS n_pred, CAST((SELECT sum(m) FROM t) AS BIGINT) AS n_label),
s AS (SELECT *, tp::DOUBLE / n_pred AS precision, tp::DOUBLE / n_label AS recall FROM c) SELECT *, 2.0::DOUBLE * precision * recall / (1.0::DOUBLE * precision + recall) AS fscore FROM s""")
def multiset_scores(p, t):
    return evaluate.scores(evaluate.multiset_counts(p, t, [SEGMENT, PRE, POST]))


@_query("edge_preds edge_labels", f"{_MULTI} SELECT cleft_segid, presyn_segid, postsyn_segid, n - coalesce(m, 0) AS n FROM p LEFT JOIN t USING (cleft_segid, presyn_segid, postsyn_segid) WHERE n > coalesce(m, 0)")
def false_positives(p, t):
    return evaluate.unmatched(p, t, [SEGMENT, PRE, POST])


_ONE = "one AS (SELECT row_id, col_id, vals FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY vals DESC, col_id) AS r FROM o) WHERE r = 1), two AS (SELECT row_id, col_id FROM (SELECT *, row_number() OVER (PARTITION BY col_id ORDER BY vals DESC, row_id) AS q FROM one) WHERE q = 1)"


def _overlap_scores_sql(used: str) -> str:
    return f"""{_COUNTS}, {_ONE}, c AS (SELECT (SELECT count(DISTINCT row_id) FROM {used}) AS m_row_id, (SELECT count(DISTINCT seg_id) FROM voxels WHERE seg_id <> 0) AS n_row_id, (SELECT count(DISTINCT col_id) FROM {used}) AS m_col_id, (SELECT count(DISTINCT gt_id) FROM voxels WHERE gt_id <> 0) AS n_col_id)
SELECT *, m_row_id::DOUBLE / n_row_id AS precision, m_col_id::DOUBLE / n_col_id AS recall FROM c"""


def _overlap_scores(v, mode):
    ids = lambda c, k: v.where(F.col(c) != 0).select(F.col(c).alias(k))
    return evaluate.overlap_scores(overlap_consolidate(v), ids("seg_id", "row_id"), ids("gt_id", "col_id"), mode)


@_query("voxels", _overlap_scores_sql("two"))
def overlap_scores_conservative(v):
    return _overlap_scores(v, "conservative")


@_query("voxels", _overlap_scores_sql("one"))
def overlap_scores_liberal(v):
    return _overlap_scores(v, "liberal")


@_query("voxels", f"{_COUNTS}, {_ONE}, g AS (SELECT row_id FROM one WHERE col_id % 7 = 0) SELECT * FROM o WHERE row_id NOT IN (SELECT row_id FROM g) AND col_id % 7 <> 0")
def overlap_ignore(v):
    o = overlap_consolidate(v)
    return evaluate.ignore(o, o.where("col_id % 7 = 0"))[0]


@_query("voxels", """WITH b AS (SELECT CAST(floor(val) AS BIGINT) AS s, gt_id <> 0 AND base_id <> 0 AS hit FROM voxels),
g AS (SELECT s, count(*) FILTER (hit) AS h, count(*) AS c FROM b GROUP BY 1) SELECT s AS score, CAST(sum(h) OVER w AS BIGINT) AS tp, CAST(sum(c) OVER w - sum(h) OVER w AS BIGINT) AS fp, CAST((SELECT count(*) FROM voxels WHERE gt_id <> 0) - sum(h) OVER w AS BIGINT) AS fn FROM g WINDOW w AS (ORDER BY s DESC)""")
def score_curve(v):
    return evaluate.curve(v.select(F.floor("val").cast("long").alias("score"), ((F.col("gt_id") != 0) & (F.col("base_id") != 0)).alias("hit")), v.where("gt_id != 0"))


@_query("voxels", """WITH b AS (SELECT base_id AS a, seg_id % 11 AS b, gt_id <> 0 AS hit FROM voxels), u AS (SELECT DISTINCT a FROM b), w AS (SELECT DISTINCT b FROM b)
SELECT u.a, w.b, count(*) FILTER (x.hit) AS tp, count(x.a) FILTER (NOT x.hit) AS fp FROM u CROSS JOIN w LEFT JOIN b x ON x.a >= u.a AND x.b >= w.b GROUP BY 1, 2""")
def score_curve2d(v):
    return evaluate.curve2d(v.select(F.col("base_id").alias("a"), (F.col("seg_id") % 11).alias("b"), (F.col("gt_id") != 0).alias("hit")), "a", "b")


@_query("voxels", """WITH h AS (SELECT CAST(least(floor((val - 0) * 20 / 200), 19) AS BIGINT) AS bin, count(*) FILTER (gt_id % 2 = 1) AS p, count(*) FILTER (gt_id % 2 = 0) AS n FROM voxels WHERE val >= 0 AND val <= 200 GROUP BY 1)
SELECT bin, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp, CAST(sum(p) OVER () - sum(p) OVER w AS BIGINT) AS fn FROM h WINDOW w AS (ORDER BY bin DESC)""")
def voxel_threshold_curve(v):
    return evaluate.threshold_counts(v.select("val", (F.col("gt_id") % 2 == 1).alias("l")), "val", "l", 20, 0, 200)


@_query("voxels", """WITH s AS (SELECT seg_id AS row_id, count(*) AS size FROM voxels WHERE seg_id <> 0 GROUP BY 1), o AS (SELECT seg_id AS row_id, gt_id AS col_id, count(*) AS vals FROM voxels WHERE seg_id <> 0 AND gt_id <> 0 GROUP BY 1, 2 HAVING count(*) >= 20), t(threshold) AS (VALUES (20), (40), (60))
SELECT CAST(threshold AS BIGINT) AS threshold, count(DISTINCT s.row_id) AS n_pred, count(DISTINCT s.row_id) FILTER (col_id IS NOT NULL) AS tp_pred, count(DISTINCT col_id) AS tp_label, (SELECT count(DISTINCT gt_id) FROM voxels WHERE gt_id <> 0) AS n_label FROM t JOIN s ON size >= threshold LEFT JOIN o ON s.row_id = o.row_id GROUP BY 1""")
def size_threshold_tuning(v):
    hits = overlap.count(v, "seg_id", "gt_id").where("vals >= 20").select("row_id", "col_id")
    sizes = voxels.sizes(v, "seg_id").withColumnRenamed("seg_id", "row_id")
    return evaluate.size_tuning(sizes, hits, [20, 40, 60], v.where("gt_id != 0").select("gt_id").distinct())


_CLAMP = """WITH h AS (SELECT z, level, CASE WHEN level = 0 THEN 0 ELSE n END AS n FROM histograms), c AS (SELECT z, level, (sum(n) OVER (PARTITION BY z ORDER BY level))::DOUBLE / nullif(sum(n) OVER (PARTITION BY z), 0)::DOUBLE AS f FROM h),
k AS (SELECT z, CAST(coalesce(min(level) FILTER (f > 0.05::DOUBLE) - 1, 0) AS BIGINT) AS lo, CAST(coalesce(min(level) FILTER (f > 0.95::DOUBLE) - 1, 0) AS BIGINT) AS hi FROM c GROUP BY z)"""


@_query("histograms", f"{_CLAMP} SELECT * FROM k")
def histogram_clamp(h):
    return norm.clamps(h, 0.05, 0.95)


@_query("voxels histograms", f"{_CLAMP} SELECT x, y, z, coalesce(CAST(round_even(greatest(1, least(255, (lv - lo)::DOUBLE / nullif(hi - lo, 0)::DOUBLE * 255)), 0) AS BIGINT), lv) AS level FROM (SELECT x, y, z, CAST(least(255, floor(val)) AS BIGINT) AS lv FROM voxels) JOIN k USING (z)")
def lut_apply(v, h):
    return norm.normalize(v.select("x", "y", "z", F.least(F.lit(255), F.floor("val")).cast("long").alias("level")), h, "level", 0.05, 0.95).select("x", "y", "z", "level")


@_query("voxels", f"{_COUNTS}, {_ONE} SELECT row_id, col_id, vals FROM one WHERE vals >= 20")
def filter_terminals(v):
    return candidates.filter_terminals(overlap_consolidate(v), 20)


@_query("seg_info", """WITH p AS (SELECT cleft_segid AS id, centroid_x AS x, centroid_y AS y, centroid_z AS z FROM seg_info WHERE cleft_segid % 10 = 0), q AS (SELECT cleft_segid AS id, centroid_x AS x, centroid_y AS y, centroid_z AS z FROM seg_info WHERE cleft_segid % 10 = 1)
SELECT p.id AS id1, q.id AS id2 FROM p JOIN q ON pow((p.x-q.x)*4, 2) + pow((p.y-q.y)*4, 2) + pow((p.z-q.z)*40, 2) < 3600""")
def pairs_within_distance(s):
    pts = s.select(F.col(SEGMENT).alias("id"), *(F.col(c).alias(a) for a, c in zip("xyz", CENTROID, strict=True)))
    return candidates.two_sets_within(pts.where("id % 10 = 0"), pts.where("id % 10 = 1"), 60)


@_query("voxels", f"{_COUNTS}, b AS (SELECT * FROM o WHERE vals > 5) SELECT row_id, p.col_id AS pre, q.col_id AS post FROM b p JOIN b q USING (row_id)")
def overlapping_pairs(v):
    return candidates.overlapping_pairs(overlap_consolidate(v), 5)


@_query("voxels", """WITH a AS (SELECT x, y, z, seg_id AS id1 FROM voxels WHERE val > 120 AND seg_id <> 0), b AS (SELECT x, y, z, gt_id AS id2 FROM voxels WHERE val > 120 AND gt_id <> 0),
n AS (SELECT id1, id2, a.x, a.y, a.z, pow((a.x-b.x)*4, 2) + pow((a.y-b.y)*4, 2) + pow((a.z-b.z)*40, 2) AS d FROM a JOIN b ON abs(a.z - b.z) <= 1 AND abs(a.x - b.x) <= 10 AND abs(a.y - b.y) <= 10)
SELECT id1, id2, x, y, z FROM (SELECT *, row_number() OVER (PARTITION BY id1, id2 ORDER BY d, x, y, z) AS r FROM n WHERE d < 400) WHERE r = 1""")
def separation_filter(v):
    pre, post = v.where("val > 120 and seg_id != 0").select(F.col("seg_id").alias("id"), "x", "y", "z"), v.where("val > 120 and gt_id != 0").select(F.col("gt_id").alias("id"), "x", "y", "z")
    return candidates.by_separation(None, pre, post, 20)


@_query("voxels", """WITH p AS (SELECT x, y, z FROM voxels WHERE val > 120), l AS (SELECT x, y, z FROM voxels WHERE val > 100 AND base_id < 3),
near AS (SELECT p.x, p.y, p.z, l.x AS lx, l.y AS ly, l.z AS lz FROM p JOIN l ON abs(p.z - l.z) <= 1 AND pow((p.x-l.x)*4, 2) + pow((p.y-l.y)*4, 2) + pow((p.z-l.z)*40, 2) <= 144),
a AS (SELECT count(DISTINCT (x, y, z)) AS p, count(DISTINCT (lx, ly, lz)) AS l FROM near) SELECT (SELECT count(*) FROM p) - a.p AS fp, (SELECT count(*) FROM l) - a.l AS fn, a.p AS tp FROM a""")
def distance_score(v):
    return evaluate.distance_score(v.where("val > 120"), v.where("val > 100 and base_id < 3"), 12)


@_query("voxels", """WITH m AS (SELECT x, y, z, (CAST(z AS BIGINT) * 1048576 + y) * 1048576 + x AS id FROM voxels WHERE val > 80), e AS (SELECT a.id AS s, b.id AS t FROM m a JOIN m b ON abs(a.x-b.x) + abs(a.y-b.y) + abs(a.z-b.z) = 1 AND b.x BETWEEN a.x-1 AND a.x+1),
r(id, lab) AS (SELECT id, id FROM m UNION SELECT e.t, r.lab FROM r JOIN e ON e.s = r.id), l AS (SELECT id, min(lab) AS lab FROM r GROUP BY id)
SELECT x, y, z, lab + 1 AS label FROM l JOIN m USING (id) WHERE lab IN (SELECT lab FROM l GROUP BY 1 HAVING count(*) >= 2)""", recursive=True)
def chunked_components(v):
    """The whole plan over chunks: label by chunk, match faces, merge; its result is the unchunked one."""
    from .plans.pipeline import Settings, chunk_components, merge_components, remap

    s = Settings((20, 20, 25), CHUNK, threshold=80, size_threshold=2)
    labelled, found, info = chunk_components(v.select("x", "y", "z", "val"), s)
    labelled, found, info = written(labelled, "labelled"), written(found, "faces"), written(info, "info")
    return remap(labelled.select("x", "y", "z", "label"), [merge_components(found, info, s)[1]], "label")


from . import queries_more  # noqa: E402, F401  registers the rest
