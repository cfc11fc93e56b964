"""Volume, segment and edge tables derived from the driver's tables, by SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# name: (source, SQL over it)
SQL: dict[str, tuple[str, str]] = {
    "voxels": ("events", """SELECT CAST(event_id % 20 AS INT) AS x, CAST(CAST(floor(event_id/20) AS BIGINT) % 20 AS INT) AS y, CAST(floor(event_id/400) AS INT) AS z,
  value AS val, user_id % 8 AS base_id,
  CASE WHEN value > 20 THEN 1 + CAST(floor((event_id % 20)/4) AS BIGINT) + 5*CAST(floor((CAST(floor(event_id/20) AS BIGINT) % 20)/4) AS BIGINT) + 25*CAST(floor(event_id/2000) AS BIGINT) ELSE 0 END AS seg_id,
  CASE WHEN value > 30 THEN 1 + CAST(floor((event_id % 20 + 2)/5) AS BIGINT) + 5*CAST(floor((CAST(floor(event_id/20) AS BIGINT) % 20)/5) AS BIGINT) + 20*CAST(floor(event_id/4000) AS BIGINT) ELSE 0 END AS gt_id
FROM events"""),
    "seg_info": ("orders", """SELECT o_orderkey + 1 AS cleft_segid, 1 + CAST(floor(o_totalprice/1000) AS BIGINT) AS size, o_orderkey % 97 AS centroid_x, o_orderkey % 89 AS centroid_y, o_orderkey % 83 AS centroid_z,
  o_orderkey % 97 - 3 AS bbox_bx, o_orderkey % 89 - 2 AS bbox_by, o_orderkey % 83 - 1 AS bbox_bz, o_orderkey % 97 + 4 AS bbox_ex, o_orderkey % 89 + 3 AS bbox_ey, o_orderkey % 83 + 2 AS bbox_ez,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 1 + 4*CAST(floor(o_orderkey/4) AS BIGINT) END AS dst_id, concat('c', o_custkey % 6) AS chunk_tag
FROM orders"""),
    "contin_graph": ("orders", "SELECT o_orderkey + 1 AS graph_id1, o_orderkey + 2 AS graph_id2 FROM orders WHERE o_totalprice > 150000"),
    "chunk_edges": ("lineitem", """SELECT l_orderkey + 1 AS cleft_segid, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey % 40 + 1 END AS presyn_segid, l_partkey % 50 + 1 AS postsyn_segid, CAST(floor(l_quantity) AS BIGINT) AS size,
  l_partkey % 211 AS presyn_x, l_suppkey % 199 AS presyn_y, CAST(l_linenumber AS BIGINT) AS presyn_z, (l_partkey + 7*l_suppkey) % 211 AS postsyn_x, (l_suppkey + 3*l_partkey) % 199 AS postsyn_y, CAST(l_linenumber AS BIGINT) + 1 AS postsyn_z,
  concat(l_returnflag, l_linestatus) AS chunk_tag
FROM lineitem"""),
    "edge_preds": ("chunk_edges", "SELECT cleft_segid % 200 AS cleft_segid, presyn_segid % 5 AS presyn_segid, postsyn_segid % 5 AS postsyn_segid FROM chunk_edges WHERE size % 3 = 0 AND presyn_segid IS NOT NULL"),
    "edge_labels": ("chunk_edges", "SELECT cleft_segid % 200 AS cleft_segid, presyn_segid % 5 AS presyn_segid, postsyn_segid % 5 AS postsyn_segid FROM chunk_edges WHERE size % 3 = 1 AND presyn_segid IS NOT NULL"),
    "seg_scores": ("lineitem", "SELECT l_orderkey % 1000 AS cleft_segid, l_suppkey AS segid, CAST(sum(floor(l_quantity)) AS BIGINT) AS pre, CAST(sum(floor(l_discount*1000)) AS BIGINT) AS post, count(*) AS sz FROM lineitem GROUP BY 1, 2"),
    "histograms": ("voxels", "SELECT z, CAST(least(255, floor(val)) AS INT) AS level, count(*) AS n FROM voxels GROUP BY 1, 2"),
    "id_map": ("seg_info", "SELECT cleft_segid AS src_id, CASE WHEN size < 100 THEN 0 ELSE dst_id END AS dst_id FROM seg_info WHERE dst_id IS NOT NULL"),
}
DRIVER_TABLES = {"events", "orders", "lineitem"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table; in its SQL the source's name stands for the frame."""
    if name in DRIVER_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    source, sql = SQL[name]
    return spark.sql(sql.replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: table(spark, sf_dir, source)})


def with_tables(names: list[str], body: str, recursive: bool = False) -> str:
    """body under WITH for the derived tables that it needs."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name in SQL and name not in needed:
            need(SQL[name][0])
            needed.append(name)

    for n in names:
        need(n)
    body = body.strip()
    joined = ",\n".join(f"{n} AS (\n{SQL[n][1]})" for n in needed)
    rest = f",\n{body[5:]}" if body.startswith("WITH ") else f"\n{body}"
    return f"WITH {'RECURSIVE ' if recursive else ''}{joined}{rest}"
