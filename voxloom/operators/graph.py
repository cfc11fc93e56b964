"""Connected components of an undirected graph held as an edge table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import written


#: Links of a graph whose components one task finds; a larger graph takes the distributed rounds.
SMALL_GRAPH = 250_000


def _small(links: DataFrame) -> DataFrame:
    """Components of a bounded number of links (u, v), by joining trees."""
    kind = links.schema["u"].dataType.simpleString()

    def join(batches):
        up: dict = {}

        def top(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            for a, b in zip(batch["u"].tolist(), batch["v"].tolist(), strict=True):
                a, b = top(a), top(b)
                up[max(a, b)] = min(a, b)
        yield pd.DataFrame({"id": list(up), "component": [top(x) for x in up]}, dtype=None if up else object)

    return written(links.select("u", "v").coalesce(1).mapInPandas(join, f"id {kind}, component {kind}"), "components")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id seen in edges; component is the smallest id reachable.

    Large-star then small-star per round (Kiveris et al., 2014), each a grouped minimum and an
    equi-join, so a hub of any degree stays a partial aggregate and a splittable join side. A graph of
    up to SMALL_GRAPH links is solved in one task instead. Each
    round is written out: the plan stays short and a lost executor costs that round only. Rows with
    a null end are ignored; a self loop gives the id its own component.
    """
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    loops = ends.where(F.col(a) == F.col(b)).select(F.col(a).alias("id"))
    now = written(ends.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), "cc")
    state = _state(now)
    if state[0] <= SMALL_GRAPH:
        found = _small(now)
        alone = loops.distinct().join(found.select("id"), "id", "left_anti").withColumn("component", F.col("id"))
        return found.unionByName(alone)
    for _ in range(max_rounds):
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("m").alias("u"), F.col("y").alias("v")).where("u < v").distinct()
        root = large.groupBy("v").agg(F.min("u").alias("m"))
        hung = large.join(root, "v").where("u > m").select(F.col("m").alias("u"), F.col("u").alias("v"))
        now = written(hung.unionByName(root.select(F.col("m").alias("u"), "v")).distinct(), "cc")
        last, state = state, _state(now)
        if state == last:
            break
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    stars = now.select(F.col("v").alias("id"), F.col("u").alias("component"))
    roots = now.select(F.col("u").alias("id")).distinct().withColumn("component", F.col("id"))
    alone = loops.distinct().join(stars.select("id").unionByName(roots.select("id")), "id", "left_anti").withColumn("component", F.col("id"))
    return stars.unionByName(roots).unionByName(alone)
