"""Further registered queries: segment joins, inference with a plug-in network, anchors, proximity, evaluation, boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import geometry as G
from .functions.hashing import FACTOR, PRIME, SHIFT, bucket, partner_bucket
from .operators import anchors, candidates, edges, evaluate, idmaps, inference, overlap, proximity, segments, voxels
from .queries import _COUNTS, _MULTI, _ONE, _query, overlap_consolidate
from .schema import CENTROID, POST, PRE, SEGMENT
from .storage import written

RES = "({0} * 4) * ({0} * 4)", "({0} * 4) * ({0} * 4)", "({0} * 40) * ({0} * 40)"
VOLUME = (20, 20, 25)


def _bucket_sql(text: str, buckets: int) -> str:
    """The bucket hash of comma-joined integers in SQL."""
    return f"CAST(({FACTOR}::HUGEINT * list_reduce(list_concat([0::HUGEINT], list_transform(generate_series(length({text}), 1, -1), lambda i: ascii(substr({text}, i, 1))::HUGEINT)), lambda acc, v: (acc*256 + v) % {PRIME}) + {SHIFT}) % {PRIME} % {buckets} AS BIGINT)"


# Joins and picks over segments and edges


@_query("seg_info", f"SELECT cleft_segid, dst_id, size FROM seg_info WHERE dst_id IS NOT NULL AND {_bucket_sql('CAST(dst_id AS VARCHAR)', 10)} = 3")
def mapped_segs_by_hash(s):
    m = s.where("dst_id is not null").select(F.col(SEGMENT).alias("src_id"), "dst_id")
    return segments.mapped_by_hash(s.select(SEGMENT, "size"), m, 10, 3).select(SEGMENT, "dst_id", "size")


@_query("seg_info id_map", "SELECT chunk_tag, src_id, m.dst_id FROM id_map m JOIN seg_info ON cleft_segid = src_id")
def chunk_seg_map(s, m):
    return segments.chunk_map(s, m)


@_query("seg_info chunk_edges", f"SELECT cleft_segid, size FROM seg_info WHERE cleft_segid IN (SELECT cleft_segid FROM chunk_edges WHERE presyn_segid IS NOT NULL AND {_bucket_sql('concat(presyn_segid, chr(44), postsyn_segid)', 8)} = 5)")
def merged_segs_by_partners(s, e):
    return segments.of_partner_bucket(s, e, 8, 5).select(SEGMENT, "size")


@_query("voxels chunk_edges", "WITH c AS (SELECT seg_id, CAST(round(sum(x)/count(*)) AS BIGINT) AS centroid_x, CAST(round(sum(y)/count(*)) AS BIGINT) AS centroid_y, CAST(round(sum(z)/count(*)) AS BIGINT) AS centroid_z FROM voxels WHERE seg_id <> 0 GROUP BY 1) SELECT cleft_segid, presyn_segid, postsyn_segid, centroid_x, centroid_y, centroid_z FROM chunk_edges JOIN c ON seg_id = cleft_segid")
def add_cleft_locs(v, e):
    return segments.add_locations(e.select(SEGMENT, PRE, POST), v, "seg_id")


@_query("voxels chunk_edges", "WITH c AS (SELECT seg_id, count(*) AS n FROM voxels WHERE seg_id <> 0 GROUP BY 1) SELECT cleft_segid, presyn_segid, postsyn_segid, n AS size FROM chunk_edges JOIN c ON seg_id = cleft_segid")
def add_cleft_sizes(v, e):
    known = e.select(SEGMENT, PRE, POST).join(v.where("seg_id != 0").select(F.col("seg_id").alias(SEGMENT)).distinct(), SEGMENT, "left_semi")
    return segments.add_sizes(known, v, "seg_id")


@_query("chunk_edges", "SELECT presyn_segid, postsyn_segid, chunk_tag, min(cleft_segid) AS id FROM chunk_edges GROUP BY ALL")
def dedup_chunk_segs(e):
    return segments.keep_least(e.select(F.col(SEGMENT).alias("id"), PRE, POST, "chunk_tag"), "id", [PRE, POST, "chunk_tag"])


@_query("chunk_edges", "SELECT * EXCLUDE r FROM (SELECT cleft_segid, presyn_segid, postsyn_segid, size AS n, row_number() OVER (PARTITION BY cleft_segid ORDER BY size DESC, presyn_segid NULLS FIRST, postsyn_segid) AS r FROM chunk_edges) WHERE r = 1")
def max_n_edge(e):
    return edges.pick_largest(e.select(SEGMENT, PRE, POST, "size")).withColumnRenamed("size", "n")


@_query("voxels", "SELECT x, y, z, dense_rank() OVER (ORDER BY base_id, seg_id) AS new_id FROM voxels WHERE seg_id <> 0")
def split_ccs_by_overlap(v):
    out = proximity.split_components(v.select("x", "y", "z", "seg_id", "base_id"), "seg_id", "base_id", "new_id")
    return out.select("x", "y", "z", F.col("new_id").cast("long").alias("new_id"))


@_query("voxels seg_info", f"{_COUNTS}, {_ONE} SELECT cleft_segid, size, col_id AS gt_id FROM seg_info LEFT JOIN one ON row_id = cleft_segid")
def overlap_attach(v, s):
    return overlap.attach(s.select(SEGMENT, "size"), overlap.largest(overlap_consolidate(v)), SEGMENT, "gt_id")


@_query("seg_info", "SELECT coalesce(dst_id, cleft_segid) AS cleft_segid, CAST(sum(size) AS BIGINT) AS size, min(bbox_bx) AS bbox_bx, max(bbox_ex) AS bbox_ex FROM seg_info GROUP BY 1")
def merge_with_registry(s):
    m = s.where("dst_id is not null").select(F.col(SEGMENT).alias("src_id"), "dst_id")
    return segments.merge_with(s.drop("dst_id"), m, SEGMENT, {"size": "sum", "bbox_bx": "min", "bbox_ex": "max"})


@_query("seg_info", "SELECT coalesce(dst_id, cleft_segid) AS cleft_segid, CAST(sum(size) AS BIGINT) AS size, CAST(max(size) - min(size) AS BIGINT) AS spread FROM seg_info GROUP BY 1")
def merge_with_function(s):
    """A user's merge function over the rows of each new id."""
    import pandas as pd

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"size": [rows["size"].sum()], "spread": [rows["size"].max() - rows["size"].min()]})

    m = s.where("dst_id is not null").select(F.col(SEGMENT).alias("src_id"), "dst_id")
    return segments.merge_by(s.select(SEGMENT, "size"), m, SEGMENT, fold, "size long, spread long")


@_query("chunk_edges", "SELECT cleft_segid, presyn_x * 4 AS presyn_x, presyn_y * 4 AS presyn_y, presyn_z, postsyn_x * 4 AS postsyn_x FROM chunk_edges")
def upsample_edges(e):
    return edges.upsample(e.select(SEGMENT, "presyn_x", "presyn_y", "presyn_z", "postsyn_x"), ["presyn_x", "presyn_y", "presyn_z", "postsyn_x"], 2)


@_query("seg_info chunk_edges", "SELECT CAST(0 AS BIGINT) AS pairs")
def surviving_duplicates(s, e):
    """Duplicate pairs that are left after merging: none at the same distance over merged ids of one row each."""
    full = written(edges.to_segments(s.drop("dst_id", "chunk_tag"), edges.pick_largest(e).select(SEGMENT, PRE, POST, "size")).select(SEGMENT, PRE, POST, *CENTROID), "full")
    found = edges.duplicate_map(full, 200).select(F.col("src_id").alias(SEGMENT), "dst_id")
    named = full.join(found, SEGMENT, "left").withColumn("merged", F.coalesce("dst_id", SEGMENT))
    return edges.split_pairs(named, "merged", 200, [PRE, POST]).agg(F.count("*").alias("pairs"))


# Inference with a plug-in network: pre = val / 255 on the cleft, post = 1 - val / 255


def _network(rows):
    return rows["val"] * rows["cleft"], 1 - rows["val"]


SHAPE = (6, 6, 3)
_LOCS = "loc AS (SELECT seg_id AS cleft_segid, CAST(round(sum(x)/count(*)) AS BIGINT) AS lx, CAST(round(sum(y)/count(*)) AS BIGINT) AS ly, CAST(round(sum(z)/count(*)) AS BIGINT) AS lz FROM voxels WHERE seg_id <> 0 GROUP BY 1)"
_BOXES = "box AS (SELECT cleft_segid, " + ", ".join(f"l{a} - {n // 2} + greatest(0, {n // 2} - l{a}) - greatest(0, l{a} - {n // 2} + {n} - {v}) AS b_{a}" for a, n, v in zip("xyz", SHAPE, VOLUME, strict=True)) + " FROM loc)"
_PATCH = "p AS (SELECT cleft_segid, x, y, z, round(val) / 255 AS val, seg_id AS cleft, gt_id AS segid FROM box JOIN voxels ON " + " AND ".join(f"{a} >= b_{a} AND {a} < b_{a} + {n}" for a, n in zip("xyz", SHAPE, strict=True)) + ")"
_CLOSE = "near AS (SELECT DISTINCT a.cleft_segid, b.segid FROM p a JOIN p b ON a.cleft_segid = b.cleft_segid AND a.cleft = a.cleft_segid AND b.segid <> 0 AND abs(a.x - b.x) + abs(a.y - b.y) <= 2 AND abs(a.z - b.z) <= 1)"
_WEIGHTS = f"WITH {_LOCS}, {_BOXES}, {_PATCH}, {_CLOSE}, w AS (SELECT cleft_segid, segid, sum(CASE WHEN cleft = cleft_segid THEN val ELSE 0 END) AS pre, sum(1 - val) AS post, count(*) AS sz, min((CAST(x AS BIGINT), CAST(y AS BIGINT), CAST(z AS BIGINT))) AS loc FROM p JOIN near USING (cleft_segid, segid) GROUP BY 1, 2)"


def _patch_voxels(v):
    return v.select(*(F.col(a).cast("long").alias(a) for a in "xyz"), F.round("val").alias("val"), F.col("seg_id").alias("cleft"), F.col("gt_id").alias("segid"))


def _weights(v):
    where = inference.locations(v, "seg_id", "centroid", SHAPE, VOLUME).withColumnRenamed("seg_id", SEGMENT)
    return inference.infer_weights(_patch_voxels(v), where, _network, SHAPE, VOLUME, 2)


@_query("voxels", f"WITH {_LOCS}, {_BOXES}, {_PATCH} SELECT cleft_segid, count(*) AS voxels, count(DISTINCT segid) AS ids, CAST(sum(x + 100 * y + 10000 * z) AS BIGINT) AS places FROM p GROUP BY 1")
def patch_extraction(v):
    where = inference.centroid_locations(v, "seg_id").withColumnRenamed("seg_id", SEGMENT)
    found = inference.patches(where, _patch_voxels(v), SHAPE, VOLUME)
    return found.groupBy(SEGMENT).agg(F.count("*").alias("voxels"), F.count_distinct("segid").alias("ids"), F.sum(F.col("x") + 100 * F.col("y") + 10000 * F.col("z")).alias("places"))


@_query("voxels", f"WITH {_LOCS}, {_BOXES}, {_PATCH}, {_CLOSE} SELECT * FROM near")
def close_segments_in_patches(v):
    where = inference.centroid_locations(v, "seg_id").withColumnRenamed("seg_id", SEGMENT)
    return inference.close_in_patches(inference.patches(where, _patch_voxels(v), SHAPE, VOLUME), 2).select(SEGMENT, "segid")


@_query("voxels", "WITH m AS (SELECT x, y, z, seg_id AS cleft_segid FROM voxels WHERE val > 90 AND seg_id <> 0) SELECT DISTINCT cleft_segid, gt_id AS segid FROM m JOIN voxels v ON abs(m.x - v.x) + abs(m.y - v.y) <= 2 AND abs(m.z - v.z) <= 1 WHERE gt_id <> 0")
def close_segments(v):
    c = v.where("val > 90 and seg_id != 0").select("x", "y", "z", F.col("seg_id").alias(SEGMENT))
    return inference.close_segments(c, v.select("x", "y", "z", F.col("gt_id").alias("segid")), 2)


@_query("voxels", f"{_WEIGHTS} SELECT cleft_segid, segid, round(pre, 6) AS pre, round(post, 6) AS post, sz, round(pre / sz, 6) AS pre_mean FROM w")
def infer_weights(v):
    r = lambda c: F.round(c, 6).alias(c)
    return _weights(v).select(SEGMENT, "segid", r("pre"), r("post"), "sz", r("pre_mean"))


@_query("voxels", _WEIGHTS + ", s AS (SELECT *, round(post / sz, 6) AS b, sum(sz) OVER (PARTITION BY cleft_segid) AS whole FROM w), r AS (SELECT *, row_number() OVER (PARTITION BY cleft_segid ORDER BY sz DESC, segid) AS i, row_number() OVER (PARTITION BY cleft_segid ORDER BY b DESC, segid) AS j FROM s) SELECT p.cleft_segid, p.segid AS presyn_segid, q.segid AS postsyn_segid, p.loc[1] AS presyn_x, p.loc[2] AS presyn_y, p.loc[3] AS presyn_z, q.loc[1] AS postsyn_x, p.sz AS presyn_sz, q.sz AS postsyn_sz FROM r p JOIN r q ON p.cleft_segid = q.cleft_segid AND p.i = 1 AND q.j = 1")
def infer_edges(v):
    w = _weights(v).withColumn("pre", F.col("sz").cast("double")).withColumn("post_mean", F.round("post_mean", 6))
    return inference.infer_edges(w, pre_kind="sum", post_kind="avg").select(SEGMENT, PRE, POST, "presyn_x", "presyn_y", "presyn_z", "postsyn_x", "presyn_sz", "postsyn_sz")


@_query("seg_scores", "SELECT cleft_segid, segid, pre::DOUBLE / sz AS pre_score, 0.25::DOUBLE * (post::DOUBLE / sz) + (1 - 0.25::DOUBLE) * (sz::DOUBLE / sum(sz) OVER (PARTITION BY cleft_segid)) AS post_score FROM seg_scores")
def side_scores(s):
    w = s.withColumn("pre_mean", F.col("pre") / F.col("sz")).withColumn("post_mean", F.col("post") / F.col("sz"))
    return inference.side_scores(w, alpha=0.25, post_kind="size mix").select(SEGMENT, "segid", "pre_score", "post_score")


@_query("seg_scores", "SELECT cleft_segid, segid, CAST(sum(pre) AS BIGINT) AS pre, CAST(sum(sz) AS BIGINT) AS sz, sum(post)::DOUBLE / sum(sz)::DOUBLE AS post_mean, arg_max(x, sample) AS x FROM (SELECT cleft_segid % 100 AS cleft_segid, segid, cleft_segid AS sample, pre, post, sz, pre AS x FROM seg_scores) GROUP BY 1, 2")
def accumulate_samples(s):
    rows = s.select((F.col(SEGMENT) % 100).alias(SEGMENT), "segid", F.col(SEGMENT).alias("sample"), "pre", "post", "sz", F.col("pre").alias("x"), F.col("pre").alias("y"), F.col("pre").alias("z"))
    return inference.accumulate(rows).select(SEGMENT, "segid", "pre", "sz", "post_mean", F.col("loc.x").alias("x"))


@_query("seg_scores", "SELECT cleft_segid, segid AS presyn_segid, other AS postsyn_segid, CAST(score AS DOUBLE) AS score FROM (SELECT *, row_number() OVER (PARTITION BY cleft_segid ORDER BY score DESC, segid, other) AS r FROM (SELECT cleft_segid, segid, segid % 7 AS other, pre * 3 + post AS score FROM seg_scores)) WHERE r = 1")
def max_candidates(s):
    rows = s.select(SEGMENT, F.col("segid").alias(PRE), (F.col("segid") % 7).alias(POST), "pre", "post")
    return inference.max_candidates(inference.score(rows, lambda r: r["pre"] * 3 + r["post"])).select(SEGMENT, PRE, POST, "score")


@_query("seg_scores", "SELECT cleft_segid, segid, CAST(pre * 3 + post AS DOUBLE) AS score FROM seg_scores WHERE pre * 3 + post > 300")
def prune_candidates(s):
    return inference.prune(s.select(SEGMENT, "segid", "pre", "post"), lambda r: r["pre"] * 3 + r["post"], 300).select(SEGMENT, "segid", "score")


@_query("voxels", "SELECT DISTINCT seg_id AS cleft_segid, CAST(1 AS INT) AS sample, CAST(10 AS BIGINT) AS x, CAST(10 AS BIGINT) AS y, CAST(12 AS BIGINT) AS z FROM voxels WHERE seg_id <> 0")
def centre_locations(v):
    return inference.locations(v, "seg_id", "center", SHAPE, VOLUME).withColumnRenamed("seg_id", SEGMENT)


@_query("voxels", "SELECT seg_id, count(*) AS voxels, true AS covered FROM voxels WHERE seg_id <> 0 GROUP BY 1")
def covering_locations(v):
    """Every voxel of an id lies in the patch of one of its samples."""
    own = v.where("seg_id != 0").select(*(F.col(a).cast("long").alias(a) for a in "xyz"), "seg_id")
    volume = (*VOLUME[:2], max(VOLUME[2], 1 + (own.agg(F.max("z")).first()[0] or 0)))  # sections go on with the table
    where = inference.locations(own, "seg_id", "coverage", (3, 3, 2), volume)
    found = inference.patches(where, own.withColumnRenamed("seg_id", "own"), (3, 3, 2), volume, "seg_id").where("own = seg_id")
    return found.select("seg_id", "x", "y", "z").distinct().groupBy("seg_id").agg(F.count("*").alias("voxels")).join(own.groupBy("seg_id").agg(F.count("*").alias("n")), "seg_id").select("seg_id", "voxels", (F.col("voxels") == F.col("n")).alias("covered"))


@_query("voxels", "SELECT seg_id, count(*) FILTER (val > 0 OR val <= 0) AS taken FROM (SELECT *, row_number() OVER (PARTITION BY seg_id ORDER BY x, y, z) AS r FROM voxels WHERE seg_id <> 0) WHERE r <= 3 GROUP BY 1")
def random_locations(v):
    """Three voxels of each id, or all that it has; which ones, the seed decides."""
    return inference.random_locations(v, "seg_id", 3).join(v.select("x", "y", "z", F.col("seg_id").alias("own")), ["x", "y", "z"]).where("own = seg_id").groupBy("seg_id").agg(F.count("*").alias("taken"))


@_query("voxels chunk_edges", "SELECT cleft_segid, presyn_x, presyn_y, presyn_z, base_id AS basin FROM chunk_edges JOIN voxels ON x = presyn_x AND y = presyn_y AND z = presyn_z")
def pull_roots(v, e):
    return voxels.pull_ids(e.select(SEGMENT, "presyn_x", "presyn_y", "presyn_z"), v, "base_id", ["presyn_x", "presyn_y", "presyn_z"], "basin")


# Anchors


def _anchor_inputs(v, e):
    clefts = v.where("seg_id != 0 and val > 60").select("x", "y", "z", F.col("seg_id").alias(SEGMENT))
    owned = v.where("gt_id != 0").select("x", "y", "z", F.col("gt_id").alias("segid"))
    return clefts, owned, edges.pick_largest(e).select(SEGMENT, F.when(F.col(SEGMENT) % 5 != 0, (F.col(SEGMENT) % 60) + 1).alias(PRE), (F.col(SEGMENT) % 45 + 1).alias(POST))


@_query("voxels chunk_edges", None)
def anchor_points(v, e):
    """Closest-point search has no SQL form; a test holds it against a search over arrays."""
    clefts, owned, pairs = _anchor_inputs(v, e)
    return anchors.place_anchors(clefts, owned, pairs, VOLUME, (6, 6, 2))


@_query("chunk_edges", "SELECT cleft_segid, CASE WHEN presyn_x >= 0 THEN presyn_x + 7 ELSE presyn_x END AS presyn_x, CASE WHEN postsyn_z >= 0 THEN postsyn_z - 1 ELSE postsyn_z END AS postsyn_z FROM (SELECT cleft_segid, CASE WHEN presyn_x < 50 THEN -1 ELSE presyn_x END AS presyn_x, CASE WHEN presyn_x < 50 THEN -2 ELSE postsyn_z END AS postsyn_z FROM chunk_edges)")
def anchor_records(e):
    rows = e.select(SEGMENT, *(F.when(F.col("presyn_x") < 50, F.lit(code)).otherwise(F.col(f"{s}_{a}")).alias(f"{s}_{a}") for s, code in (("presyn", -1), ("postsyn", -2)) for a in "xyz"))
    return anchors.offset_record(rows, (7, 0, -1)).select(SEGMENT, "presyn_x", "postsyn_z")


@_query("chunk_edges", "WITH a AS (SELECT cleft_segid, presyn_x - 20 AS presyn_x, postsyn_x - 20 AS postsyn_x FROM chunk_edges), m AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY cleft_segid ORDER BY least(presyn_x, postsyn_x) < 0, presyn_x, postsyn_x) AS r FROM a) WHERE r = 1) SELECT e.cleft_segid, e.presyn_segid, e.postsyn_segid, m.presyn_x, m.postsyn_x FROM chunk_edges e JOIN m USING (cleft_segid)")
def anchors_to_edges(e):
    placed = e.select(SEGMENT, (F.col("presyn_x") - 20).alias("presyn_x"), (F.col("postsyn_x") - 20).alias("postsyn_x"))
    return anchors.to_edges(e.select(SEGMENT, PRE, POST, "presyn_x", "postsyn_x"), placed)


# Distances and proximity

_SEEDS = "SELECT x, y, z, CASE WHEN val > 95 THEN seg_id ELSE 0 END AS id FROM voxels"


def _seeds(v):
    return v.select("x", "y", "z", F.when(F.col("val") > 95, F.col("seg_id")).otherwise(0).alias("id"))


@_query("voxels", f"WITH s AS ({_SEEDS}), d AS (SELECT a.x, a.y, a.z, b.id, CAST(abs(a.x - b.x) + abs(a.y - b.y) AS BIGINT) AS dist FROM s a JOIN s b ON a.z = b.z AND b.id <> 0) SELECT x, y, z, id, dist FROM (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY dist, id) AS r FROM d) WHERE r = 1")
def manhattan2d(v):
    return proximity.manhattan(_seeds(v), "id").where("id is not null")


@_query("voxels", f"WITH s AS ({_SEEDS}), d AS (SELECT a.x, a.y, a.z, min(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z)) AS dist FROM s a JOIN s b ON b.id <> 0 GROUP BY 1, 2, 3) SELECT dist, count(*) AS voxels FROM d GROUP BY 1")
def manhattan3d(v):
    return proximity.manhattan(_seeds(v), "id", "xyz").where("id is not null").groupBy("dist").agg(F.count("*").alias("voxels"))


_D2 = " + ".join(r.format(f"(a.{k} - b.{k})") for k, r in zip("xyz", RES, strict=True))


@_query("voxels", f"WITH s AS ({_SEEDS}) SELECT a.x, a.y, a.z, CAST(min({_D2}) AS BIGINT) AS d2 FROM s a JOIN s b ON b.id <> 0 GROUP BY 1, 2, 3")
def euclidean_distance(v):
    return proximity.euclidean2(_seeds(v), F.col("id") != 0, "d2").select("x", "y", "z", "d2").where("d2 is not null")


_CREMI = f"WITH v AS (SELECT x, y, z, val > 90 AS p, val > 85 AND base_id < 3 AS l FROM voxels), tp AS (SELECT a.x, a.y, a.z, min({_D2}) AS d FROM v a JOIN v b ON a.l AND b.p GROUP BY 1, 2, 3), tl AS (SELECT a.x, a.y, a.z, min({_D2}) AS d FROM v a JOIN v b ON a.p AND b.l GROUP BY 1, 2, 3)"


@_query("voxels", f"{_CREMI}, c AS (SELECT (SELECT count(*) FROM tl WHERE d <= 144) AS tp, (SELECT count(*) FROM tl WHERE d > 144) AS fp, (SELECT count(*) FROM tp WHERE d > 144) AS fn, (SELECT coalesce(sum(sqrt(d)), 0) FROM tp WHERE d > 144) AS dgt, (SELECT coalesce(sum(sqrt(d)), 0) FROM tl WHERE d > 144) AS df) SELECT tp, fp, fn, round(dgt, 6) AS dgt, round(df, 6) AS df, round(1 - 2.0::DOUBLE * tp / (2 * tp + fp + fn), 9) AS score FROM c")
def cremi_score(v):
    rows = v.select("x", "y", "z", (F.col("val") > 90).cast("int").alias("p"), ((F.col("val") > 85) & (F.col("base_id") < 3)).cast("int").alias("l"))
    return evaluate.cremi_score(rows, "p", "l", 12).select("tp", "fp", "fn", F.round("dgt", 6).alias("dgt"), F.round("df", 6).alias("df"), F.round("score", 9).alias("score"))


@_query("voxels", "SELECT x, y, z, round(exp(-(val * val) / 5000) * (2.0 / (1.0 + exp(-5.0 * val)) - 1), 9) AS proximity FROM voxels")
def parag_transform(v):
    return v.select("x", "y", "z", F.round(proximity.parag_transform(F.col("val")), 9).alias("proximity"))


_SIGNED = f"""WITH c AS (SELECT seg_id AS cleft_segid, x, y, z FROM voxels WHERE val > 95 AND seg_id <> 0), b AS (SELECT cleft_segid, min(x) - 4 AS lx, max(x) + 4 AS hx, min(y) - 4 AS ly, max(y) + 4 AS hy, min(z) - 1 AS lz, max(z) + 1 AS hz FROM c GROUP BY 1),
e AS (SELECT cleft_segid, 1 AS sign, 1 + cleft_segid % 60 AS segid FROM b UNION ALL SELECT cleft_segid, -1, 1 + cleft_segid % 45 FROM b),
n AS (SELECT v.x, v.y, v.z, cleft_segid, sign FROM e JOIN b USING (cleft_segid) JOIN voxels v ON v.gt_id = e.segid AND v.x BETWEEN lx AND hx AND v.y BETWEEN ly AND hy AND v.z BETWEEN lz AND hz),
d AS (SELECT a.x, a.y, a.z, a.cleft_segid, sign, min({_D2}) AS d FROM n a JOIN c b ON a.cleft_segid = b.cleft_segid GROUP BY ALL)
SELECT x, y, z, round(sqrt(d) * sign + 0.0::DOUBLE, 9) + 0.0::DOUBLE AS dist FROM (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY d, cleft_segid, sign) AS r FROM d) WHERE r = 1"""


@_query("voxels", _SIGNED)
def signed_distance(v):
    clefts = v.where("val > 95 and seg_id != 0").select("x", "y", "z", F.col("seg_id").alias(SEGMENT))
    pairs = clefts.select(SEGMENT).distinct().select(SEGMENT, (1 + F.col(SEGMENT) % 60).alias(PRE), (1 + F.col(SEGMENT) % 45).alias(POST))
    out = proximity.signed_distance(v.select("x", "y", "z", F.col("gt_id").alias("segid")), clefts, pairs, (4, 4, 1))
    return out.select("x", "y", "z", F.round("dist", 9).alias("dist"))


_TERMINALS = """m AS (SELECT x + 20*y + 400*z AS id, x, y, z, base_id FROM voxels WHERE val > 85), e AS (SELECT a.id AS s, b.id AS t FROM m a JOIN m b ON abs(a.x-b.x) + abs(a.y-b.y) + abs(a.z-b.z) = 1 AND b.x BETWEEN a.x-1 AND a.x+1),
r(id, lab) AS (SELECT id, id FROM m UNION SELECT e.t, r.lab FROM r JOIN e ON e.s = r.id), l AS (SELECT id, min(lab) AS lab FROM r GROUP BY id),
t AS (SELECT x, y, z, dense_rank() OVER (ORDER BY base_id, lab) AS terminal FROM l JOIN m USING (id) WHERE base_id <> 0)"""


@_query("voxels", f"WITH {_TERMINALS} SELECT * FROM t WHERE terminal IN (SELECT terminal FROM t GROUP BY 1 HAVING count(*) >= 2)", recursive=True)
def prox_terminals(v):
    return proximity.prox_terminals(v.select("x", "y", "z", "val", "base_id"), 85, 2, "base_id")


@_query("voxels", "WITH m AS (SELECT x, y, z, seg_id FROM voxels WHERE val > 90 AND seg_id <> 0), g AS (SELECT DISTINCT ON (x, y, z) v.x, v.y, v.z, m.seg_id, gt_id FROM voxels v JOIN m ON v.z = m.z AND abs(v.x - m.x) + abs(v.y - m.y) <= 2 ORDER BY x, y, z, abs(v.x - m.x) + abs(v.y - m.y), m.seg_id), o AS (SELECT seg_id AS row_id, gt_id AS col_id, count(*) AS n FROM g WHERE gt_id <> 0 GROUP BY 1, 2 HAVING count(*) > 3) SELECT a.row_id, a.col_id AS pre, b.col_id AS post FROM o a JOIN o b ON a.row_id = b.row_id AND a.col_id <> b.col_id")
def label_candidates(v):
    return candidates.label_candidates(v.where("val > 90").select("x", "y", "z", F.col("seg_id").alias("cleft")), v.select("x", "y", "z", F.col("gt_id").alias("segid")), 2, 3, (0, 0), (20, 20), same=False)


@_query("voxels", None)
def terminal_candidates(v):
    """The composition of parts that have SQL each; a test holds it against loops over arrays."""
    own = v.where("val > 85 and base_id != 0")
    pre = own.where("base_id < 4").select("x", "y", "z", F.col("seg_id").alias("terminal")).where("terminal != 0")
    post = own.where("base_id >= 4").select("x", "y", "z", F.col("seg_id").alias("terminal")).where("terminal != 0")
    return candidates.terminal_candidates(pre, post, v.select("x", "y", "z", F.col("gt_id").alias("segid")), 3, 60, 30)


# Evaluation


@_query("voxels edge_preds edge_labels", f"""WITH o AS (SELECT seg_id AS row_id, gt_id AS col_id, count(*) AS vals FROM voxels WHERE seg_id <> 0 AND gt_id <> 0 GROUP BY 1, 2), one AS (SELECT row_id, col_id FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY vals DESC, col_id) AS r FROM o) WHERE r = 1),
m AS (SELECT s.seg_id AS cleft_segid, coalesce(col_id, (SELECT min(gt_id) FROM voxels WHERE gt_id <> 0)) AS id FROM (SELECT DISTINCT seg_id FROM voxels WHERE seg_id <> 0) s LEFT JOIN one ON row_id = seg_id),
a AS (SELECT id AS cleft_segid, presyn_segid, postsyn_segid FROM edge_preds JOIN m USING (cleft_segid)), p AS (SELECT cleft_segid, presyn_segid, postsyn_segid, count(*) AS n FROM a GROUP BY ALL), t AS (SELECT cleft_segid, presyn_segid, postsyn_segid, count(*) AS m FROM edge_labels GROUP BY ALL),
c AS (SELECT CAST(coalesce((SELECT sum(least(n, m)) FROM p JOIN t USING (cleft_segid, presyn_segid, postsyn_segid)), 0) AS BIGINT) AS tp, CAST((SELECT sum(n) FROM p) AS BIGINT) AS n_pred, CAST((SELECT sum(m) FROM t) AS BIGINT) AS n_label) SELECT tp, n_pred, n_label, round(tp::DOUBLE / n_pred, 9) AS precision FROM c""")
def score_segmented_edges(v, p, t):
    ids = lambda c, k: v.where(F.col(c) != 0).select(F.col(c).alias(k)).distinct()
    known = p.join(ids("seg_id", SEGMENT), SEGMENT, "left_semi")
    out = evaluate.segmented_edge_scores(overlap_consolidate(v), ids("seg_id", "row_id"), ids("gt_id", "col_id"), known, t)
    return out.select("tp", "n_pred", "n_label", F.round("precision", 9).alias("precision"))


@_query("edge_preds edge_labels", """WITH p AS (SELECT *, cleft_segid * 7 % 50 AS score, row_number() OVER (PARTITION BY cleft_segid, presyn_segid, postsyn_segid ORDER BY cleft_segid) AS k FROM edge_preds), t AS (SELECT cleft_segid, presyn_segid, postsyn_segid, count(*) AS n FROM edge_labels GROUP BY ALL),
h AS (SELECT score, k <= coalesce(n, 0) AS hit FROM p LEFT JOIN t USING (cleft_segid, presyn_segid, postsyn_segid)), g AS (SELECT score, count(*) FILTER (hit) AS h, count(*) AS c FROM h GROUP BY 1),
w AS (SELECT score, CAST(sum(h) OVER (ORDER BY score DESC) AS BIGINT) AS tp, CAST(sum(c) OVER (ORDER BY score DESC) AS BIGINT) AS kept FROM g) SELECT score, tp, kept - tp AS fp, (SELECT count(*) FROM edge_labels) - tp AS fn, tp::DOUBLE / kept AS precision, tp::DOUBLE / (SELECT count(*) FROM edge_labels) AS recall FROM w""")
def edge_prec_rec_curve(p, t):
    return evaluate.edge_curve(p.withColumn("score", F.col(SEGMENT) * 7 % 50), t, [SEGMENT, PRE, POST])


_CURVE2D = "WITH s AS (SELECT base_id AS a, seg_id % 11 AS b, gt_id <> 0 AS hit FROM voxels), u AS (SELECT DISTINCT a FROM s), w AS (SELECT DISTINCT b FROM s)"


def _scored(v):
    return v.select(F.col("base_id").alias("a"), (F.col("seg_id") % 11).alias("b"), (F.col("gt_id") != 0).alias("hit"))


@_query("voxels", f"{_CURVE2D}, g AS (SELECT u.a, w.b, count(*) FILTER (x.hit) AS tp, count(x.a) FILTER (NOT x.hit) AS fp FROM u CROSS JOIN w LEFT JOIN s x ON x.a >= u.a AND x.b >= w.b GROUP BY 1, 2) SELECT a, b, tp, fp, (SELECT count(*) FROM s WHERE hit) - tp AS fn, round(tp::DOUBLE / nullif(tp + fp, 0), 9) AS precision, round(tp::DOUBLE / (SELECT count(*) FROM s WHERE hit), 9) AS recall FROM g")
def prec_rec_curve2d(v):
    s = _scored(v)
    out = evaluate.scores2d(evaluate.curve2d(s, "a", "b"), s.where("hit").count())
    return out.select("a", "b", "tp", "fp", "fn", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@_query("voxels", f"{_CURVE2D} SELECT u.a, w.b, count(*) FILTER (x.hit) AS fn FROM u CROSS JOIN w LEFT JOIN s x ON x.a < u.a AND x.b < w.b GROUP BY 1, 2")
def false_negative_grid(v):
    return evaluate.lower_grid(_scored(v), "a", "b")


@_query("voxels", "WITH r AS (SELECT (k + 1) / 100.0::DOUBLE AS recall FROM range(100) t(k)), c AS (SELECT recall, 0.6::DOUBLE * recall / (2.0::DOUBLE * recall - 0.6::DOUBLE) AS p FROM r) SELECT round(recall, 9) AS recall, round(p, 9) AS precision FROM c WHERE p >= 0 AND abs(2 * recall - 0.6::DOUBLE) > 1e-9")
def iso_f_curve(v):
    out = evaluate.iso_curve(v.sparkSession, 0.6)
    return out.where("abs(2 * recall - 0.6) > 1e-9").select(F.round("recall", 9).alias("recall"), F.round("precision", 9).alias("precision"))


@_query("voxels", """WITH h AS (SELECT CAST(least(floor((val - 0) * 20 / 200), 19) AS BIGINT) AS bin, count(*) FILTER (gt_id % 2 = 1) AS p, count(*) FILTER (gt_id % 2 = 0) AS n FROM voxels WHERE val >= 0 AND val <= 200 GROUP BY 1),
c AS (SELECT bin, sum(p) OVER (ORDER BY bin DESC) AS tp, sum(n) OVER (ORDER BY bin DESC) AS fp, sum(p) OVER () AS pos FROM h), f AS (SELECT bin, CASE WHEN tp = 0 THEN 0 ELSE 3.25::DOUBLE * (tp / (tp + fp)) * (tp / pos) / (2.25::DOUBLE * (tp / (tp + fp)) + tp / pos) END AS f FROM c) SELECT bin, round(f, 9) AS fscore FROM f ORDER BY f DESC, bin LIMIT 1""")
def best_voxel_threshold(v):
    counts = evaluate.threshold_counts(v.select("val", (F.col("gt_id") % 2 == 1).alias("l")), "val", "l", 20, 0, 200)
    return evaluate.best_threshold(counts, 1.5).select("bin", F.round("fscore", 9).alias("fscore"))


_GRID = """WITH s AS (SELECT cleft_segid % 200 AS cleft_segid, segid % 5 AS segid, max(pre) AS pre, max(post) AS post FROM seg_scores GROUP BY 1, 2), tp AS (SELECT unnest([60, 90, 120])::DOUBLE AS pre_t), tq AS (SELECT unnest([120, 200])::DOUBLE AS post_t),
r AS (SELECT *, row_number() OVER (PARTITION BY cleft_segid ORDER BY pre DESC, segid) AS k, max(pre) OVER (PARTITION BY cleft_segid) AS top FROM s),
d AS (SELECT pre_t, post_t, r.cleft_segid, r.segid AS presyn_segid, q.segid AS postsyn_segid FROM r, tp, tq JOIN s q ON true WHERE q.cleft_segid = r.cleft_segid AND (r.pre > pre_t OR (k = 1 AND top <= pre_t)) AND q.post > post_t),
t AS (SELECT cleft_segid, presyn_segid, postsyn_segid, count(*) AS m FROM edge_labels GROUP BY ALL), c AS (SELECT pre_t, post_t, CAST(sum(least(1, coalesce(m, 0))) AS BIGINT) AS tp, count(*) AS n_pred FROM d LEFT JOIN t USING (cleft_segid, presyn_segid, postsyn_segid) GROUP BY 1, 2),
f AS (SELECT pre_t, post_t, tp, n_pred, CASE WHEN tp = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (n_pred + (SELECT count(*) FROM edge_labels)) END AS f FROM c)"""


def _grid(s, t):
    scored = s.groupBy((F.col(SEGMENT) % 200).alias(SEGMENT), (F.col("segid") % 5).alias("segid")).agg(F.max("pre").alias("pre"), F.max("post").alias("post"))
    return evaluate.threshold_grid(scored, t, [60, 90, 120], [120, 200])


@_query("seg_scores edge_labels", f"{_GRID} SELECT pre_t, post_t, tp, n_pred, round(f, 9) AS fscore FROM f")
def threshold_grid(s, t):
    return _grid(s, t).select("pre_t", "post_t", "tp", "n_pred", F.round("fscore", 9).alias("fscore"))


@_query("seg_scores edge_labels", f"{_GRID} SELECT pre_t, post_t, round(f, 9) AS fscore FROM f ORDER BY round(f, 9) DESC, pre_t, post_t LIMIT 1")
def gridsearch(s, t):
    return evaluate.best_of(_grid(s, t).withColumn("fscore", F.round("fscore", 9)), ["pre_t", "post_t"]).select("pre_t", "post_t", "fscore")


@_query("voxels", f"{_COUNTS} SELECT DISTINCT seg_id AS row_id FROM voxels WHERE seg_id <> 0 AND seg_id NOT IN (SELECT row_id FROM o)")
def unmatched_segments(v):
    return evaluate.unmatched_ids(overlap_consolidate(v), v.where("seg_id != 0").select(F.col("seg_id").alias("row_id")), "row_id")


@_query("voxels", f"{_COUNTS}, {_ONE} SELECT DISTINCT gt_id AS col_id FROM voxels WHERE gt_id <> 0 AND gt_id NOT IN (SELECT col_id FROM two)")
def unmatched_labels(v):
    return evaluate.unmatched_ids(overlap_consolidate(v), v.where("gt_id != 0").select(F.col("gt_id").alias("col_id")), "col_id", "conservative")


@_query("voxels", f"""{_COUNTS}, pr AS (SELECT DISTINCT seg_id AS pre_id, 1 + seg_id % 50 AS post_id FROM voxels WHERE seg_id <> 0),
u AS (SELECT pre_id, post_id, col_id, vals FROM pr JOIN o ON row_id = pre_id UNION ALL SELECT pre_id, post_id, col_id, vals FROM pr JOIN o ON row_id = post_id), g AS (SELECT pre_id, post_id, col_id, sum(vals) AS n FROM u GROUP BY ALL)
SELECT pr.pre_id, pr.post_id, k.col_id FROM pr LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pre_id, post_id ORDER BY n DESC, col_id) AS r FROM g) WHERE r = 1) k USING (pre_id, post_id)""")
def max_cleft_overlaps(v):
    o = overlap_consolidate(v)
    pairs = v.where("seg_id != 0").select(F.col("seg_id").alias("pre_id"), (1 + F.col("seg_id") % 50).alias("post_id")).distinct()
    return evaluate.summed_overlaps(pairs, o, o)


@_query("voxels", f"""WITH o AS (SELECT z % 3 AS dset_id, seg_id AS row_id, gt_id AS col_id, count(*) AS vals FROM voxels WHERE seg_id <> 0 AND gt_id <> 0 GROUP BY 1, 2, 3), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dset_id, row_id ORDER BY vals DESC, col_id) AS r FROM o) WHERE r = 1), two AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dset_id, col_id ORDER BY vals DESC, row_id) AS q FROM one) WHERE q = 1)
SELECT dset_id, (SELECT count(*) FROM two t WHERE t.dset_id = d.dset_id) AS tp, count(DISTINCT seg_id) FILTER (seg_id <> 0) AS n_pred, count(DISTINCT gt_id) FILTER (gt_id <> 0) AS n_label FROM (SELECT *, z % 3 AS dset_id FROM voxels) d GROUP BY dset_id""")
def multi_volume_scores(v):
    return evaluate.dataset_scores(v.withColumn("dset_id", F.col("z") % 3), "dset_id", "seg_id", "gt_id").select("dset_id", "tp", "n_pred", "n_label")


# Boxes, vectors and chunks


@_query("seg_info", """WITH b AS (SELECT cleft_segid, centroid_x AS x, centroid_y AS y, centroid_z AS z FROM seg_info) SELECT cleft_segid, x - 5 + greatest(0, 5 - x) - greatest(0, x + 5 - 90) AS bx, x + 5 + greatest(0, 5 - x) - greatest(0, x + 5 - 90) AS ex, z - 1 + greatest(0, 1 - z) - greatest(0, z + 2 - 80) AS bz FROM b""")
def containing_boxes(s):
    b = G.containing_box(G.vec(*(F.col(c) for c in CENTROID)), G.vec(10, 10, 3), G.vec(90, 90, 80))
    return s.select(SEGMENT, b.alias("b")).select(SEGMENT, F.col("b.min.x").alias("bx"), F.col("b.max.x").alias("ex"), F.col("b.min.z").alias("bz"))


@_query("seg_info", "SELECT cleft_segid, (centroid_x - 40) % 7 + CASE WHEN (centroid_x - 40) % 7 < 0 THEN 7 ELSE 0 END AS modulo, CAST(floor((centroid_x - 40) / 7.0) AS BIGINT) AS quotient, CAST(pow(centroid_y, 2) AS BIGINT) AS square, centroid_y::DOUBLE / 4 AS share, centroid_z << 2 AS up, centroid_z >> 1 AS down, centroid_z & 12 AS both, centroid_z | 3 AS any, xor(centroid_z, 21) AS odd, bbox_ex - bbox_bx AS width FROM seg_info")
def vector_operators(s):
    c = G.vec(*(F.col(c) for c in CENTROID))
    moved = G.zip_vec(c, G.vec(40, 0, 0), lambda a, b: a - b)
    box = G.box(G.vec(*(F.col(f"bbox_b{a}") for a in "xyz")), G.vec(*(F.col(f"bbox_e{a}") for a in "xyz")))
    return s.select(SEGMENT, G.modulo(moved, 7)["x"].alias("modulo"), G.floor_divide(moved, 7)["x"].alias("quotient"), G.power(c, 2)["y"].cast("long").alias("square"), G.true_divide(c, 4)["y"].alias("share"), G.shift_left(c, 2)["z"].alias("up"), G.shift_right(c, 1)["z"].alias("down"), G.bit_and(c, 12)["z"].alias("both"), G.bit_or(c, 3)["z"].alias("any"), G.bit_xor(c, 21)["z"].alias("odd"), G.transpose(G.shape(box))["z"].alias("width"))


@_query("seg_info", "SELECT cleft_segid, CAST(round_even((centroid_x - 3) / 16.0::DOUBLE, 0) AS BIGINT) * 16 + 3 AS x FROM seg_info")
def closest_chunk_boundary(s):
    at = G.closest_chunk_boundary(G.vec(*(F.col(c) for c in CENTROID)), G.vec(3, 3, 0), G.vec(16, 16, 10))
    return s.select(SEGMENT, at["x"].cast("long").alias("x"))


@_query("seg_info", "SELECT cleft_segid, (greatest(1, CAST(ceil((centroid_x + 40) / 16.0) AS BIGINT)) - 1) * 3 * 2 + greatest(1, CAST(ceil((centroid_x + 40) / 16.0) AS BIGINT)) * (2 * 2 + 3 * 1) AS faces FROM seg_info")
def num_faces(s):
    return s.select(SEGMENT, G.num_faces(G.vec(F.col("centroid_x") + 40, 48, 20), G.vec(16, 16, 10)).alias("faces"))


@_query("seg_info", "SELECT cleft_segid, k.i AS i, greatest(5, k.i * 16) AS b, least(60 + centroid_x, k.i * 16 + 16) AS e FROM seg_info, range(0, 20) k(i) WHERE k.i * 16 < 60 + centroid_x")
def bounds_1d(s):
    spans = G.bounds_1d(60 + F.col("centroid_x"), 16, 5)
    return s.select(SEGMENT, F.posexplode(spans).alias("k", "s")).select(SEGMENT, F.col("k").cast("long").alias("i"), F.col("s.begin").cast("long").alias("b"), F.col("s.end").cast("long").alias("e"))


@_query("seg_info", "SELECT cleft_segid, concat(centroid_x, ',', centroid_y, ',', centroid_z) AS text, list_sort([centroid_x, centroid_y, centroid_z])[2] AS low, list_sort([centroid_x, centroid_y, centroid_z])[3] AS high, centroid_y AS second FROM seg_info")
def tuple_helpers(s):
    text = G.tuple_text(G.vec(*(F.col(c) for c in CENTROID)))
    face = G.max_face_shape(G.vec(*(F.col(c) for c in CENTROID)))
    return s.select(SEGMENT, text.alias("text"), face[0].alias("low"), face[1].alias("high"), G.parse_tuple(text)[1].alias("second"))


# Tasks


@_query("seg_info contin_graph", f"WITH n AS (SELECT graph_id1, graph_id1 - row_number() OVER (ORDER BY graph_id1) AS g FROM contin_graph), c AS (SELECT graph_id1 AS id, min(graph_id1) OVER (PARTITION BY g) AS lab FROM n UNION ALL SELECT max(graph_id1) + 1, min(graph_id1) FROM n GROUP BY g), m AS (SELECT cleft_segid AS src_id, coalesce(lab, cleft_segid) AS dst_id FROM seg_info LEFT JOIN c ON id = cleft_segid) SELECT src_id, dst_id, {_bucket_sql('CAST(dst_id AS VARCHAR)', 20)} AS dst_id_hash FROM m")
def graph_map_with_hash(s, g):
    m = segments.merge_map(g, s, SEGMENT)
    return m.withColumn("dst_id_hash", bucket([F.col("dst_id")], 20))


@_query("voxels id_map", None)
def edge_task(v, m):
    """The whole edge task: remapped segmentation, inference, sizes and hashes; its parts have SQL each."""
    from .plans.pipeline import edge_task as task

    return task(_patch_voxels(v), m, _network, SHAPE, VOLUME, 2, 16)


@_query("seg_info", "SELECT CAST(count(*) AS BIGINT) AS chunks, true AS complete FROM (SELECT DISTINCT centroid_x % 4 AS a, centroid_y % 3 AS b, centroid_z % 2 AS c FROM seg_info)")
def grid_completeness(s):
    from .sources.catalog import grid_check

    begin = s.select(*((F.col(c) % n).alias(f"begin_{a}") for a, c, n in zip("xyz", CENTROID, (4, 3, 2), strict=True))).distinct()
    return grid_check(begin).select("chunks", "complete")
