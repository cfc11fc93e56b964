"""Golden values and edge cases of helpers."""

import pytest
from pyspark.sql import functions as F

from voxloom import schema
from voxloom.functions import geometry as G
from voxloom.functions.hashing import bucket
from voxloom.operators import anchors, edges, evaluate, idmaps, inference, norm, segments, voxels
from voxloom.operators.graph import connected_components
from voxloom.plans.pipeline import Settings
from voxloom.sources import tables


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("values", "want"), [((17,), 379), ((12, 345), 863), ((17, 345), 10), ((0, 7), 27), ((256, 256, 128, 2), 673), ((0,), 556)])
def test_bucket_hash(spark, values, want):
    assert one(spark, bucket([F.lit(v) for v in values], 1000)) == want


def test_boxes(spark):
    b = G.box(G.vec(2, 10, 7), G.vec(6, 13, 9))
    for by, low, high in ((3, (5, 13, 10), (9, 16, 12)), (-4, (-2, 6, 3), (2, 9, 5))):
        moved = one(spark, G.translate(b, G.vec(by, by, by)))
        assert (tuple(moved["min"]), tuple(moved["max"])) == (low, high)
    assert one(spark, G.contains(b, G.vec(2, 10, 7))) and not one(spark, G.contains(b, G.vec(6, 10, 7)))
    assert tuple(one(spark, G.divide2d(G.box(G.vec(-5, 4, 4), G.vec(7, 6, 9)), 2))["min"]) == (-3, 2, 4)
    grown = one(spark, G.expand_within(G.box(G.vec(0, 0, 0), G.vec(3, 3, 3)), G.vec(7, 7, 7), G.vec(20, 20, 20)))
    assert (tuple(grown["min"]), tuple(grown["max"])) == ((0, 0, 0), (7, 7, 7))
    both = one(spark, G.hull(b, G.box(G.vec(0, 11, 8), G.vec(3, 20, 9))))
    assert (tuple(both["min"]), tuple(both["max"])) == ((0, 10, 7), (6, 20, 9))
    inner = one(spark, G.intersect(b, G.box(G.vec(0, 11, 8), G.vec(3, 20, 9))))
    assert (tuple(inner["min"]), tuple(inner["max"])) == ((2, 11, 8), (3, 13, 9))


def test_tags(spark):
    got = one(spark, G.parse_chunk_tag(F.lit("-3_0_4-5_6_7")))
    assert (tuple(got["min"]), tuple(got["max"])) == ((-3, 0, 4), (5, 6, 7))
    assert one(spark, G.parse_chunk_tag(F.lit("else")))["min"]["x"] is None
    assert tuple(one(spark, G.parse_face_tag(G.face_tag(F.lit(2), F.lit(True))))) == (2, True)


def test_components_on_chain_cycle_and_loop(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (51, 52), (52, 50), (60, 60), (None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in connected_components(e, "a", "b").collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 51: 50, 52: 50, 60: 60}
    assert connected_components(e.limit(0), "a", "b").count() == 0


def test_compose_is_idempotent_on_components(spark):
    m = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "src_id long, dst_id long")
    assert sorted(idmaps.compose(m, m, True).collect()) == sorted(m.collect())


def test_assign_golden(spark):
    s = spark.createDataFrame([(0, 0, 0, 0), (0, 1, 1, 0), (0, 2, 0, 1), (1, 0, 0, 0), (1, 1, 0, 1), (1, 2, 1, 0)], "cleft_segid long, segid long, pre long, post long")
    assert sorted(map(tuple, edges.assign_by_max(s).collect())) == [(0, 1, 2), (1, 2, 1)]
    assert edges.assign_by_threshold(s, 2).count() == 0


def test_scores_golden(spark):
    s = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (0, 2, 1.0)], "cleft_segid long, segid long, pre double")
    assert [r["pre"] for r in edges.normalize(s, "pre").orderBy("segid").collect()] == [0.25, 0.5, 0.25]
    assert [one(spark, edges.mix(F.lit(1.0), F.lit(2.0), a)) for a in (0.5, 1.0, 0.0)] == [1.5, 1.0, 2.0]


def test_empty_predictions_and_labels_score_one(spark):
    e = spark.createDataFrame([], "k long")
    got = evaluate.scores(evaluate.multiset_counts(e, e, ["k"])).first()
    assert (got["precision"], got["recall"], got["fscore"]) == (1.0, 1.0, 1.0)


def test_duplicate_predictions(spark):
    p, t = spark.createDataFrame([(1,), (1,), (2,)], "k long"), spark.createDataFrame([(1,)], "k long")
    assert evaluate.multiset_counts(p, t, ["k"]).first()[:] == (1, 3, 1)
    assert evaluate.multiset_counts(p, t, ["k"], penalize_duplicates=False).first()[:] == (1, 2, 1)


def test_merge_keeps_unmapped_centroid(spark):
    s = spark.createDataFrame([(1, 3, 1.5, 0.0, 0.0, 0, 0, 0, 1, 1, 1), (2, 1, 2.5, 0.0, 0.0, 5, 5, 5, 6, 6, 6), (3, 1, 7.5, 0.0, 0.0, 9, 9, 9, 10, 10, 10)], schema.SEGMENTS)
    got = {r["cleft_segid"]: r for r in segments.merge(s, spark.createDataFrame([(1, 1), (2, 1)], schema.ID_MAP)).collect()}
    assert (got[1]["size"], got[1]["centroid_x"], got[1]["bbox_ex"]) == (4, 1.0, 6) and got[3]["centroid_x"] == 7.5


def test_flat_histogram_passes_through(spark):
    h = spark.createDataFrame([(0, 0, 5)], "z int, level int, n long")
    assert norm.clamps(h, 0.1, 0.9).first()[:] == (0, 0, 0)
    v = spark.createDataFrame([(0, 0, 0, 9)], "x int, y int, z int, level long")
    assert norm.normalize(v, h, "level", 0.1, 0.9).first()["level"] == 9


def test_anchors(spark):
    c = spark.createDataFrame([(1, 4, 0, 0), (1, 6, 0, 0), (2, 9, 0, 0)], "cleft_segid long, x long, y long, z long")
    v = spark.createDataFrame([(7, 0, 0, 0), (7, 3, 0, 0), (8, 9, 1, 0), (8, 19, 0, 0)], "segid long, x long, y long, z long")
    e = spark.createDataFrame([(1, 7, 8), (2, None, 9)], "cleft_segid long, presyn_segid long, postsyn_segid long")
    got = {r[0]: r[1:] for r in map(tuple, anchors.place_anchors(c, v, e, (20, 20, 5), (2, 2, 2)).collect())}
    assert got == {1: (3, 0, 0, -2, -2, -2), 2: (-1, -1, -1, -2, -2, -2)}
    moved = {r[0]: r[1:] for r in map(tuple, anchors.offset_record(anchors.place_anchors(c, v, e, (20, 20, 5), (4, 4, 2)), (10, 0, 1)).collect())}
    assert moved == {1: (13, 0, 1, 19, 1, 1), 2: (-1, -1, -1, -2, -2, -2)}


def test_surfaces_of_a_sparse_volume(spark):
    v = spark.createDataFrame([(x, y, 0, 5) for x in range(5) for y in range(5)] + [(9, 9, 0, 6)], "x int, y int, z int, id long")
    assert voxels.surfaces(v, "id", "xy", ((0, 0, 0), (10, 10, 1))).count() == 9 + 1  # the sides towards the rest of the volume
    assert voxels.surfaces(v.where("id = 5"), "id", "xy").count() == 0  # its border is the volume's


def test_distances_at_the_threshold_count_as_near(spark):
    p, q = (spark.createDataFrame([(x, 0, 0)], "x int, y int, z int") for x in (0, 3))
    assert tuple(evaluate.distance_score(p, q, 12).first()) == (0, 0, 1) and tuple(evaluate.distance_score(p, q, 11).first()) == (1, 1, 0)


def test_running_sums_over_ranges(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(1).alias("n")).repartition(5)
    assert {r.k: r.n for r in evaluate.cumulative(rows, "k", ["n"]).collect()} == {k: 1000 - k for k in range(1000)}


def test_catalogue(spark, tmp_path):
    from voxloom.sources import catalog

    assert catalog.create_tables(spark, "own") == sorted(schema.TABLES)
    grid = G.chunk_grid(spark, (20, 20, 10), (10, 10, 10))
    catalog.fill_chunks(grid, "own")
    catalog.create_tables(spark, "own")
    assert spark.table("own.chunks").count() == 4 and catalog.grid_check(grid).first().complete
    assert not catalog.grid_check(grid.where("begin_x + begin_y > 0")).first().complete
    catalog.write_bucketed(spark.range(10), "own.numbers", 2, "id")
    assert spark.table("own.numbers").count() == 10
    spark.sql("DROP TABLE own.numbers")
    catalog.drop_tables(spark, "own")
    catalog.drop_tables(spark, "own")
    assert not spark.catalog.databaseExists("own")
    with pytest.raises(FileNotFoundError):
        catalog.read_together(spark, str(tmp_path / "none"), "a")
    for n in (3, 5):
        tables.write_together({"a": spark.range(n)}, str(tmp_path / "v"))
    spark.range(9).write.parquet(str(tmp_path / "v" / "v-unfinished" / "a"))
    assert catalog.read_together(spark, str(tmp_path / "v"), "a").count() == 5
    catalog.write_model(spark, abs, str(tmp_path / "m"))
    assert catalog.read_model(spark, str(tmp_path / "m"))(-3) == 3
    assert catalog.required_chunks((0, 0, 0), (5, 4, 4), (4, 4, 4), 1) == [(0, 0, 0, 0), (0, 1, 0, 0), (1, 0, 0, 0)]
    catalog.create_volume(spark, str(tmp_path / "vol"))
    tables.write_volume(spark.createDataFrame([(1, 1, 1, 9, "0_0_0-2_2_2")], "x long, y long, z long, val long, chunk_tag string"), str(tmp_path / "vol"))
    assert tables.read_volume(spark, str(tmp_path / "vol"), (0, 0, 0), (2, 2, 2)).count() == 1


def test_scorer_and_locations(spark):
    c = spark.createDataFrame([(1, 0.2), (2, 0.9)], "id long, v double")
    assert [r["id"] for r in inference.prune(c, lambda b: b["v"] * 2, 1.0).collect()] == [2]
    v = spark.createDataFrame([(1, i, 0, 0) for i in range(9)], "id long, x long, y long, z long")
    assert inference.random_locations(v, "id", 3).count() == 3


def test_tables_round_trip(spark, tmp_path):
    e = spark.createDataFrame([("1", "[1,2]", "5", 1), ("2", "3", "[6]", 0)], "id string, pre string, post string, ok int")
    e.write.csv(str(tmp_path / "e"), sep=";")
    assert sorted(map(tuple, tables.read_edge_csv(spark, str(tmp_path / "e")).collect())) == [(1, 1, 5), (1, 2, 5), (2, 3, 6)]
    assert tables.read_edge_csv(spark, str(tmp_path / "e"), True).count() == 2
    o = spark.createDataFrame([(1, 2, 3, "a"), (1, 2, 4, "b")], schema.TABLES["chunk_overlaps"])
    tables.write_table(o, str(tmp_path), "chunk_overlaps", "overwrite")
    tables.write_table(o.where("chunk_tag = 'a'").withColumn("vals", F.lit(9).cast("long")), str(tmp_path), "chunk_overlaps", "overwrite")
    assert sorted(r["vals"] for r in tables.read_table(spark, str(tmp_path), "chunk_overlaps").collect()) == [4, 9]
    assert tables.read_table(spark, str(tmp_path), "merged_segs").count() == 0
    tables.log_timing(spark, str(tmp_path), "t", "tag", 1.5)
    assert tables.read_table(spark, str(tmp_path), "timing_log").first()[:] == ("t", "tag", 1.5)
    assert tables.parse_uri("gs://b/k/x") == ("gs", "b", "k/x") and tables.is_database("postgresql+psycopg2://h/d")


def test_agglomeration(spark, tmp_path):
    import numpy as np
    import zstandard

    for mip, pairs in ((0, [(1, 2), (5, 6)]), (1, [(2, 3)])):
        (tmp_path / f"map_{mip}.zst").write_bytes(zstandard.ZstdCompressor().compress(np.array(pairs, "<u8").tobytes()))
    maps = tables.read_agglomeration(spark, str(tmp_path))
    v = spark.createDataFrame([(0, 0, 0, i) for i in (1, 2, 5, 9)], "x int, y int, z int, id long")
    assert sorted(r["id"] for r in tables.agglomerate(v, maps, "id", 1).collect()) == [3, 3, 6, 9]


def test_settings():
    s = Settings.read("[volume]\nvolume = 20, 20, 25\nchunk = 10,10,10\n[run]\nsize_threshold = 5")
    assert s.volume == (20, 20, 25) and s.size_threshold == 5
    with pytest.raises(ValueError):
        Settings((1, 1, 1), (0, 1, 1))
    for wrong in ({"block": (4, 5, 5)}, {"patch": (11, 5, 5)}):
        with pytest.raises(ValueError):
            Settings((20, 20, 20), (10, 10, 10), **wrong)


def test_stream_appends_once(spark, tmp_path):
    from voxloom.streaming import chunks

    row = (1, 2, 0.0, 0.0, 0.0, 0, 0, 0, 1, 1, 1, "c")
    spark.createDataFrame([row], schema.CHUNK_SEGMENTS).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        chunks.append_once(chunks.read_chunks(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        spark.createDataFrame([row], schema.CHUNK_SEGMENTS).write.mode("append").parquet(str(tmp_path / "in"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_euclidean_over_a_long_axis(spark):
    from voxloom.operators import proximity

    v = spark.range(3000).select(F.lit(0).alias("x"), F.lit(1).alias("y"), F.col("id").cast("int").alias("z"), (F.col("id") % 2000 == 7).alias("seed"))
    got = {r["z"]: r["d2"] for r in proximity.euclidean2(v, F.col("seed"), "d2").collect()}
    assert got == {z: 1600 * min((z - 7) ** 2, (z - 2007) ** 2) for z in range(3000)}  # beyond 32 bits
    boxes = spark.range(60).select(F.concat(F.lit("b"), F.col("id") % 3).alias("box"), *((F.floor(F.col("id") / 3) % 5).alias("x"), F.floor(F.col("id") / 15).alias("y"), F.lit(0).alias("z")), F.col("id").isin(0, 3, 37).alias("seed"))
    rows = proximity.euclidean2(boxes, F.col("seed"), "d2", keys=("box",)).collect()
    seeds = [r for r in rows if r["seed"]]
    assert len(rows) == 60 and all(r["d2"] == min((16 * ((r["x"] - s["x"]) ** 2 + (r["y"] - s["y"]) ** 2) for s in seeds if s["box"] == r["box"]), default=None) for r in rows)


def test_cremi_score_over_a_long_axis(spark):
    v = spark.range(2000).select(F.lit(0).alias("x"), F.lit(0).alias("y"), F.col("id").cast("int").alias("z"), (F.col("id") == 1900).cast("int").alias("p"), (F.col("id") == 0).cast("int").alias("l"))
    assert tuple(evaluate.cremi_score(v, "p", "l").first()) == (0, 1, 1, 76000.0, 76000.0, 1.0)


def test_manhattan_sums_no_frame_anew(spark):
    from voxloom.operators import proximity

    at = [(x, 0, 0, 7 if x == 3 else 5 if x == 9 else 0) for x in range(12)] + [(9, 0, 0, 4)]  # a voxel that comes twice
    rows = proximity.manhattan(spark.createDataFrame(at, "x int, y int, z int, id long"), "id", "xyz")
    assert "unboundedfollowing" not in rows._jdf.queryExecution().analyzed().toString().lower()
    assert {r["x"]: (r["id"], r["dist"]) for r in rows.collect()} == {x: (7, abs(x - 3)) if abs(x - 3) < abs(x - 9) else (4, abs(x - 9)) for x in range(12)} | {6: (4, 3)}


def test_covering_ends_at_a_voxel_outside_the_volume(spark):
    v = spark.createDataFrame([(1, 1, z, 4) for z in range(30)], "x long, y long, z long, seg long")
    rows = inference.covering_locations(v, "seg", (3, 3, 2), (20, 20, 30)).collect()
    begins = [min(max(r["z"] - 1, 0), 28) for r in rows]
    assert {z for b in begins for z in (b, b + 1)} == set(range(30)) and sorted(r["sample"] for r in rows) == list(range(1, len(rows) + 1))
    with pytest.raises(Exception, match="outside the volume"):  # went on without end
        inference.covering_locations(v, "seg", (3, 3, 2), (20, 20, 25)).collect()


def test_separation_of_all_pairs_meets_by_voxels_alone(spark):
    import random

    from voxloom import queries
    from voxloom.operators import candidates

    draw = random.Random(3)
    pre, post = ([(draw.randrange(9), draw.randrange(30), draw.randrange(30), draw.randrange(4)) for _ in range(200)] for _ in range(2))
    near = {}
    for (a, *p), (b, *q) in ((p, q) for p in pre for q in post):
        d2 = sum((u - v) ** 2 * r * r for u, v, r in zip(p, q, (4, 4, 40), strict=True))
        if d2 < 400:
            near[a, b] = min(near.get((a, b), (400,)), (d2, *p))
    schema = "id long, x int, y int, z int"
    got = {(r[0], r[1]): tuple(r)[2:] for r in candidates.by_separation(None, spark.createDataFrame(pre, schema), spark.createDataFrame(post, schema), 20).collect()}
    assert got == {k: v[1:] for k, v in near.items()}
    plan = queries.QUERIES["separation_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.strip(" :+-").startswith("Join") for line in plan.splitlines()) == 1  # no join of ids by columns of the volume


def _crowd(spark):
    import random

    draw = random.Random(5)
    rows = [(i, draw.randrange(2), draw.randrange(0, 4000), draw.randrange(0, 300), draw.randrange(0, 300)) for i in range(900)] + [(2000 + i, 0, 1, 1, 1) for i in range(900)]
    near = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and sum((u - v) ** 2 for u, v in zip(a[2:], b[2:], strict=True)) < 60 * 60}
    return spark.createDataFrame(rows, "id long, g long, x long, y long, z long"), near


def test_near_components_make_no_pairs(spark):
    rows, near = _crowd(spark)
    args = (rows, 60, ["g"], "id", ["x", "y", "z"], (1, 1, 1))  # several tiles, and 900 ids at one place
    up = {}

    def top(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in near:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    assert {r["id"]: r["component"] for r in edges.near_components(*args).collect()} == {i: top(i) for i in list(up)}


def test_split_pairs_are_the_near_pairs_of_two_labels(spark):
    rows, near = _crowd(spark)
    label = lambda i: i % 5 if i < 2000 else int(i == 2007)
    named = rows.withColumn("label", F.when(F.col("id") < 2000, F.col("id") % 5).otherwise((F.col("id") == 2007).cast("long")))
    got = edges.split_pairs(named, "label", 60, ["g"], "id", ["x", "y", "z"], (1, 1, 1)).collect()
    want = {(a, b) for a, b in near if label(a) != label(b)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_duplicate_map_joins_no_positions(spark):
    rows, _ = _crowd(spark)
    full = rows.select(F.col("id").alias("cleft_segid"), F.col("g").alias("presyn_segid"), F.col("g").alias("postsyn_segid"), *(F.col(a).cast("double").alias(f"centroid_{a}") for a in "xyz"))
    assert edges.duplicate_map(full, 60, resolution=(1, 1, 1)).where("src_id >= 2000").select("dst_id").distinct().count() == 1
    found = edges.near_components(full, 60, ["presyn_segid"], resolution=(1, 1, 1))
    assert "__a0" not in found._jdf.queryExecution().optimizedPlan().toString() and found.where("id >= 2000").count() == 900


def test_only_partners_travel_to_find_the_largest_edge(spark):
    from voxloom import queries

    rows = [(i % 3, (i * 7) % 4 or None, (i * 5) % 3, i % 2, i, -i, "c") for i in range(30)]  # equal sizes: partners decide
    e = spark.createDataFrame(rows, "cleft_segid long, presyn_segid long, postsyn_segid long, size long, presyn_x long, presyn_y long, chunk_tag string")
    s = spark.range(3).select(F.col("id").alias("cleft_segid"), F.lit(1).alias("size"), F.lit(0).alias("dst_id"), F.lit("c").alias("chunk_tag"))
    full = queries._full(s, e)
    want = edges.pick_largest(e).select("cleft_segid", "presyn_segid", "postsyn_segid").collect()
    assert set(full.select("cleft_segid", "presyn_segid", "postsyn_segid").collect()) == set(want)
    assert "b.presyn_x" not in full._jdf.queryExecution().toString() and "presyn_x AS presyn_x" not in full._jdf.queryExecution().analyzed().toString()
