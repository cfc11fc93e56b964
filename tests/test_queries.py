"""Every registered query of the volume operators against its SQL in DuckDB."""

import duckdb
import pytest

from voxloom import queries

SF = "/root/testdata/sf0.001"


def rows(frame):
    """Rows as text, columns by name, numbers as floats."""
    plain = lambda x: None if x is None or str(x) in ("nan", "<NA>", "None") else float(x) if hasattr(x, "__float__") and not isinstance(x, bool) else x
    return sorted(repr([plain(x) for x in r]) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("events", "orders", "lineitem"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_chunked_components_are_the_unchunked_ones(spark):
    from voxloom.operators import voxels

    v = queries.table(spark, SF, "voxels").select("x", "y", "z", "val")
    chunked = {(r.x, r.y, r.z): r.label for r in queries.QUERIES["chunked_components"](spark, SF).collect()}
    whole = {(r.x, r.y, r.z): r.label for r in voxels.components(voxels.threshold(v, 80)).collect()}
    groups, sizes = {}, {}
    for at, label in whole.items():
        sizes[label] = sizes.get(label, 0) + 1
    for at, label in chunked.items():
        groups.setdefault(label, set()).add(whole[at])
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)
    assert set(chunked) == {at for at, label in whole.items() if sizes[label] >= 2}


def test_anchors_are_those_of_a_search_over_arrays(spark):
    """The anchors of whole volumes held as arrays, box by box."""
    import numpy as np
    from voxloom import queries_more
    from voxloom.operators import anchors

    v, e = queries.table(spark, SF, "voxels"), queries.table(spark, SF, "chunk_edges")
    clefts, owned, pairs = queries_more._anchor_inputs(v, e)
    shape, width, scale = (20, 20, 3), np.array((6, 6, 2)), np.array((4.0, 4.0, 40.0))
    volume = {k: np.zeros(shape, np.int64) for k in ("cleft", "seg")}
    for k, rows, column in (("cleft", clefts, "cleft_segid"), ("seg", owned, "segid")):
        for r in rows.collect():
            volume[k][r.x, r.y, r.z] = r[column]
    got = {r.cleft_segid: tuple(r)[1:] for r in anchors.place_anchors(clefts, owned, pairs, shape, tuple(width)).collect()}
    seen = set()

    def nearest(points, at):
        return points[np.argmin((((points - at) * scale) ** 2).sum(1))]

    for r in pairs.collect():
        points = np.argwhere(volume["cleft"] == r.cleft_segid)
        if not len(points):
            continue
        low, high = points.min(0) - width, points.max(0) + 1 + width
        move = np.maximum(0, -low) - np.maximum(0, high - shape)
        low, high = np.maximum(0, low + move), np.minimum(shape, high + move)
        want = []
        for partner in (r.presyn_segid, r.postsyn_segid):
            if partner is None:
                want += [-1] * 3
                continue
            inside = np.zeros(shape, bool)
            inside[low[0] : high[0], low[1] : high[1], low[2] : high[2]] = True
            own = np.argwhere((volume["seg"] == partner) & inside)
            if not len(own):
                want += [-2] * 3
                continue
            a, b = points[0], own[0]
            while True:
                to = nearest(own, a)
                back = nearest(points, to)
                if (to == b).all() and (back == a).all():
                    break
                a, b = back, to
            begin = b - width // 2
            begin = begin + np.maximum(0, low - begin) - np.maximum(0, begin + width - high)
            local = own[((own >= begin) & (own < begin + width)).all(1)]
            want += list(nearest(local, local.mean(0)))
        seen.add(r.cleft_segid)
        assert got[r.cleft_segid] == tuple(want)
    assert seen == set(got) and any(-2 in w for w in got.values()) and any(min(w) >= 0 for w in got.values())


def test_terminal_candidates_are_those_of_loops(spark):
    rows = queries.table(spark, SF, "voxels").collect()
    size, seg = {}, {}
    for r in rows:
        seg[r.x, r.y, r.z] = r.gt_id
        size[r.gt_id] = size.get(r.gt_id, 0) + 1
    sides = []
    for low in (True, False):
        own = {}
        for r in rows:
            if r.val > 85 and r.base_id != 0 and (r.base_id < 4) == low and r.seg_id != 0:
                own.setdefault(r.seg_id, []).append((r.x, r.y, r.z))
        under = {t: seg[max(p)] for t, p in own.items()}
        sides.append({t: (p, under[t]) for t, p in own.items() if under[t] != 0 and size[under[t]] >= 3})
    far = lambda a, b: sum(((p - q) * k) ** 2 for p, q, k in zip(a, b, (4, 4, 40), strict=True))
    half = lambda x: int(x + 0.5)
    centre = lambda p: tuple(half(sum(q[k] for q in p) / len(p)) for k in range(3))
    want = {}
    for t, (p, s) in sides[0].items():
        for u, (q, w) in sides[1].items():
            if s != w and far(centre(p), centre(q)) < 3600:
                best = min((min(far(a, b) for b in q), a) for a in p)
                if best[0] < 900:
                    want[t, u] = (s, w, *best[1])
    got = {(r.pre_terminal, r.post_terminal): (r.presyn_segid, r.postsyn_segid, r.x, r.y, r.z) for r in queries.QUERIES["terminal_candidates"](spark, SF).collect()}
    assert got == want and len(want) > 5


def test_edge_task_is_its_parts(spark):
    got = queries.QUERIES["edge_task"](spark, SF).collect()
    assert len(got) == len({r.cleft_segid for r in got}) > 5 and all(0 <= r.partnerhash < 16 and 0 <= r.clefthash < 16 and r.size > 0 for r in got)
