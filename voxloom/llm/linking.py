"""Meeting of signatures: records that share a signature become candidates, without a row per signature.

The map side packs the signatures of many records into one blob per bucket, so that the exchange
moves about nine bytes a signature; the reduce side sorts one bucket with numpy. Buckets grow in
number with the input. A group of up to SMALL records gives its pairs; a larger one comes out as
membership rows (sig, rid), from which `resolve` gets stars and, once their links are known, compares
sketches across different components: all pairs of a large group are never made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import storage
from ..operators.graph import connected_components
from . import textkit as K

#: Records in a group that gives all its pairs.
SMALL = 6
#: Records of one signature in one flush from which the rest skip the bucket.
CROWD = 64
#: Signatures in a flush.
FLUSH = 600_000
#: Records of a large group that one task compares with as many others.
BLOCK = 8192
PAIR, MEMBER = 0, 1
_LOW = np.uint64((1 << 48) - 1)
BLOB = "bucket long, crowd boolean, blob binary"
_OUT = "kind int, a long, b long, n long, spare int"
#: Pairs of a group, or words of bitmaps, in one numpy step; pairs whose contents are compared at a time; rows of small groups that go together.
CELLS, PAIRS, ROWS = 1 << 18, 1 << 14, 1 << 14
Bound = Callable[[np.ndarray, np.ndarray], np.ndarray]
Settle = Callable[[list[str], list[str]], np.ndarray]
Signed = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # sig, record number, rid of each record, spare of each record


def _pack(rid: np.ndarray, spare: np.ndarray, counts: np.ndarray, sig: np.ndarray) -> bytes:
    return np.uint32(len(rid)).tobytes() + rid.astype("<i8").tobytes() + spare.astype("<u2").tobytes() + counts.astype("<u4").tobytes() + np.ascontiguousarray(sig.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    rid = np.frombuffer(blob, "<i8", n, 4)
    spare = np.frombuffer(blob, "<u2", n, 4 + 8 * n)
    counts = np.frombuffer(blob, "<u4", n, 4 + 10 * n)
    low = np.frombuffer(blob, np.uint8, offset=4 + 14 * n).reshape(-1, 6)
    sig = np.zeros((len(low), 8), np.uint8)
    sig[:, :6] = low
    return sig.view("<u8").ravel(), np.repeat(rid, counts), np.repeat(spare, counts)


def _blobs(parts: list[Signed], buckets: int) -> Iterator[tuple[int, bool, bytes]]:
    shift = np.cumsum([0, *(len(p[2]) for p in parts[:-1])])
    sig = np.concatenate([p[0] for p in parts])
    rec = np.concatenate([p[1] + s for p, s in zip(parts, shift, strict=True)])
    rid, spare = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
    bucket = ((sig >> np.uint64(48)) * np.uint64(buckets)) >> np.uint64(16)
    part = (sig >> np.uint64(44)).astype(np.int64)
    order = np.flatnonzero((np.bincount(part) > CROWD)[part])  # other signatures are no crowds
    order = order[np.argsort(sig[order], kind="stable")]
    s = sig[order]
    run = np.flatnonzero(np.concatenate([s[:1] == s[:1], s[1:] != s[:-1]]))
    size = np.diff(np.append(run, len(s)))
    hot = np.zeros(len(sig), bool)
    for a, n in zip(run[size > CROWD], size[size > CROWD], strict=True):
        hot[order[a + SMALL + 1 : a + n]] = True  # those left make the group a large one wherever it meets
    for crowd in (False, True):
        at = np.flatnonzero(hot == crowd)
        if not len(at):
            continue
        at = at[np.argsort(bucket[at].astype(np.uint16 if buckets <= 1 << 16 else np.uint32), kind="stable")]  # 16 bits sort in one go
        keys, first = np.unique(bucket[at], return_index=True)
        for k, a, b in zip(keys, first, np.append(first[1:], len(at)), strict=True):
            own = at[a:b]
            r, counts = np.unique(rec[own], return_counts=True)
            yield int(k), crowd, _pack(rid[r], spare[r], counts, sig[own[np.argsort(rec[own], kind="stable")]])


def _meet(table: pa.Table, spread: int | None) -> Iterator[tuple]:
    """(kind, a, b, n, spare) columns for one bucket."""
    high = np.uint64(table.column("bucket")[0].as_py()) << np.uint64(48)  # apart from other buckets' signatures
    crowd = table.column("crowd").to_numpy()
    got = [_unpack(x.as_buffer()) for x in table.column("blob")]
    for c, (sig, rid, spare) in zip(crowd, got, strict=True):
        if c:
            yield np.full(len(sig), MEMBER), (sig | high).view(np.int64), rid, np.full(len(sig), CROWD), spare if spread is None else np.zeros(len(sig), np.int64)
    got = [g for c, g in zip(crowd, got, strict=True) if not c]
    if not got:
        return
    sig, rid, spare = (np.concatenate(x) for x in zip(*got, strict=True))
    order = np.argsort(sig)
    s = sig[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    order = order[same[1:] | same[:-1]]  # signatures met more than once
    sig, rid, spare = sig[order], rid[order], spare[order]
    order = np.lexsort((rid, sig) if spread is None else (rid, spare, sig))
    sig, rid, spare = sig[order], rid[order], spare[order]
    keep = np.ones(len(sig), bool)
    keep[1:] = (sig[1:] != sig[:-1]) | (rid[1:] != rid[:-1])
    sig, rid, spare = sig[keep], rid[keep], spare[keep]
    if not len(sig):
        return
    edge = np.concatenate([[True], sig[1:] != sig[:-1]])
    name = sig | high
    if spread is not None:  # a gap of bands parts a group, but for those of which a crowd has gone ahead
        whole = [x[0] for c, x in zip(crowd, [_unpack(x.as_buffer()) for x in table.column("blob")], strict=True) if c]
        whole = np.isin(sig, np.unique(np.concatenate(whole))) if whole else np.zeros(len(sig), bool)
        gap = np.zeros(len(sig), bool)
        gap[1:] = (spare[1:].astype(np.int64) - spare[:-1] > spread) & ~whole[1:]
        edge |= gap
        begin = np.flatnonzero(edge)
        begin = np.repeat(begin, np.diff(np.append(begin, len(sig))))
        name = np.where(whole, name, K.mix(name + (spare[begin].astype(np.uint64) << np.uint64(48))))
    run = np.flatnonzero(edge)
    size = np.diff(np.append(run, len(sig)))
    n = np.repeat(size, size)
    big = n > SMALL
    group = np.repeat(np.arange(len(run)), size)
    if big.any():
        kept = spare[big] if spread is None else np.zeros(big.sum(), np.int64)
        yield np.full(big.sum(), MEMBER), name[big].view(np.int64), rid[big], n[big], kept
    group, rid, spare = group[~big], rid[~big], spare[~big].astype(np.int64)
    a, b = [], []
    for d in range(1, SMALL):
        at = np.flatnonzero((group[d:] == group[:-d]) & (np.abs(spare[d:] - spare[:-d]) <= (65535 if spread is None else spread)))
        a.append(np.minimum(rid[at], rid[at + d]))
        b.append(np.maximum(rid[at], rid[at + d]))
    a, b = np.concatenate(a), np.concatenate(b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b = a[new], b[new]
    yield np.full(len(a), PAIR), a, b, np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)


class Packer:
    """Packs the signatures of records into blobs, some hundred thousand in one go."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.size = buckets, [], 0

    def add(self, part: Signed) -> Iterator[pa.RecordBatch]:
        if len(part[0]):
            self.parts.append(part)
            self.size += len(part[0])
        if self.size >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            columns = list(zip(*_blobs(self.parts, self.buckets), strict=True)) or [(), (), ()]
            self.parts, self.size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.binary())], ["bucket", "crowd", "blob"])


def meet(df: DataFrame, sign: Callable[[Iterator[pa.RecordBatch]], Iterator[Signed]], buckets: int, name: str, spread: int | None = None) -> DataFrame:
    """met() of the records that sign() gives."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets)
        for part in sign(batches):
            yield from packer.add(part)
        yield from packer.flush()

    return met(df.mapInArrow(emit, BLOB), name, spread)


def met(blobs: DataFrame, name: str, spread: int | None = None) -> DataFrame:
    """Written table of candidate pairs (kind PAIR: a < b) and of members of larger groups (kind MEMBER: a = sig, b = rid, n = group size, spare).

    blobs: bucket, crowd, blob, of a Packer. With spread, the spare of a record is a band: only records up to spread bands
    apart meet, and a gap of more parts a group.
    """

    def one(table: pa.Table) -> pa.Table:
        found = list(_meet(table, spread)) or [tuple(np.zeros(0, np.int64) for _ in range(5))]
        columns = [np.concatenate(x) for x in zip(*found, strict=True)]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        return pa.table({c: pa.array(x.astype(np.int64), pa.int64()).cast(t) for c, x, t in zip(("kind", "a", "b", "n", "spare"), columns, types, strict=True)})

    return storage.written(blobs.groupBy("bucket").applyInArrow(one, _OUT), name)


def allocate(members: DataFrame) -> DataFrame:
    """Leave out each record's costliest signatures as far as its spare allows."""
    rank = F.row_number().over(Window.partitionBy("rid", "spare").orderBy(F.desc("n"), "sig"))
    return members.withColumn("rank", rank).where("rank > spare").drop("rank")


def stars(members: DataFrame) -> DataFrame:
    """Pairs of each group's smallest record with its others."""
    lead = members.groupBy("sig").agg(F.min("rid").alias("a"))
    return members.join(lead, "sig").where("rid != a").select("a", F.col("rid").alias("b"))


def sketches(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Parity bitmaps of sets of hashes: bit (h mod B) is flipped by each token, with B a power of two, 2 n at least.

    Two sets' bitmaps differ in at most as many bits as the sets differ in tokens, which rules out
    most pairs exactly at a thirtieth of the sets' bytes. Halves of a bitmap fold onto each other.
    """
    out = []
    for i in range(len(first) - 1):
        own = h[first[i] : first[i + 1]]
        size = max(64, 1 << int(2 * len(own) - 1).bit_length()) if len(own) else 64
        flips = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
        out.append(np.packbits(flips.astype(np.uint8), bitorder="little").tobytes())
    return out


def _fold(rows: np.ndarray, words: int) -> np.ndarray:
    while rows.shape[1] > words:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def _by_width(sketch: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, bitmaps as rows of 64-bit words) for each width."""
    raw = sketch.cast(pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    data, width = np.frombuffer(raw.buffers()[2], np.uint8), np.diff(bounds)
    out = []
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out.append((at, np.stack([data[bounds[i] : bounds[i] + w] for i in at]).view(np.uint64)))
    return out


def _marks(classes: DataFrame) -> DataFrame:
    return classes if "mark" in classes.columns else classes.withColumn("mark", F.lit(None).cast("long"))


def _apart(x: np.ndarray, has_x, y: np.ndarray, has_y) -> np.ndarray:
    """Bits between marks; 0 where one is missing."""
    return np.where(has_x & has_y, np.bitwise_count((x ^ y).view(np.uint64)), 0)


def may_link(pairs: DataFrame, classes: DataFrame, bound: Bound, apart: int = 64) -> DataFrame:
    """The pairs (a, b) that their sketches and marks don't rule out. classes: rid, n, sketch, and mark (64 bits or null) where marks of linked records are up to apart bits apart."""
    classes = _marks(classes)
    side = lambda x: classes.select(F.col("rid").alias(x), F.struct("n", "sketch", "mark").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.col("sa.n").alias("na"), F.col("sb.n").alias("nb"), F.col("sa.sketch").alias("xa"), F.col("sb.sketch").alias("xb"), F.col("sa.mark").alias("ma"), F.col("sb.mark").alias("mb"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            most = bound(batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            good = np.zeros(len(batch), bool)
            left, right = _by_width(batch.column("xa")), _by_width(batch.column("xb"))
            for at, x in left:
                for bt, y in right:
                    both, i, j = np.intersect1d(at, bt, assume_unique=True, return_indices=True)
                    if len(both):
                        w = min(x.shape[1], y.shape[1])
                        good[both] = np.bitwise_count(_fold(x[i], w) ^ _fold(y[j], w)).sum(1) <= most[both]
            ma, mb = batch.column("ma"), batch.column("mb")
            good &= _apart(ma.fill_null(0).to_numpy(), ma.is_valid().to_numpy(zero_copy_only=False), mb.fill_null(0).to_numpy(), mb.is_valid().to_numpy(zero_copy_only=False)) <= apart
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return both.mapInArrow(test, "a long, b long")


def _bits_apart(parts: list[tuple[np.ndarray, np.ndarray]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits between the bitmaps of rows i and j; the wider one is folded."""
    out, size = np.zeros(len(i), np.int64), sum(len(at) for at, _ in parts)
    width, place = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for k, (at, _) in enumerate(parts):
        width[at], place[at] = k, np.arange(len(at))
    kind = width[i] * len(parts) + width[j]
    for both in np.unique(kind):
        (_, x), (_, y) = parts[both // len(parts)], parts[both % len(parts)]
        own = np.flatnonzero(kind == both)
        w = min(x.shape[1], y.shape[1])
        step = max(1, CELLS // max(x.shape[1], y.shape[1]))
        for c in range(0, len(own), step):
            few = own[c : c + step]
            out[few] = np.bitwise_count(_fold(x[place[i[few]]], w) ^ _fold(y[place[j[few]]], w)).sum(1)
    return out


def _gathered(chunks: Iterator[tuple[np.ndarray, ...]], least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The chunks, as many in one as have least rows together."""
    held, size = [], 0
    for chunk in chunks:
        held.append(chunk)
        size += len(chunk[0])
        if size >= least:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _whole(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of ROWS rows or more (but for the last) that hold whole groups, from batches in which the rows of a group are in a row."""
    held, size = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += len(batch)
        if size < ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        edge = _edges(table, keys)
        if edge[-1]:
            yield table.slice(0, edge[-1])
        held = table.slice(edge[-1]).to_batches()
        size = sum(map(len, held))
    if held:
        yield pa.Table.from_batches(held)


def _edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The first row of each group."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for k in keys:
        x = table.column(k).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _joined(component: np.ndarray, chunks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], text: list[str], settle: Settle) -> Iterator[tuple[int, int]]:
    """Of the pairs (i, j, bits apart) in chunks, links that join the components as all links do: a pair inside what is joined already is not compared."""
    root, name = np.unique(component, return_inverse=True)
    root = np.arange(len(root))
    for i, j, far in chunks:
        order = np.lexsort((far, i))
        nearest = np.zeros(len(i), bool)
        nearest[order[np.concatenate([[True], i[order][1:] != i[order][:-1]])]] = True  # of each row, which joins most
        order = np.lexsort((far, ~nearest))
        count, at = int(nearest.sum()), 0
        while at < len(order):
            own = order[at : (count if at < count else at) + (0 if at < count else PAIRS)]
            at += len(own)
            own = own[root[name[i[own]]] != root[name[j[own]]]]
            good = settle([text[k] for k in i[own]], [text[k] for k in j[own]])
            for u, v in zip(i[own[good]].tolist(), j[own[good]].tolist(), strict=True):
                p, q = root[name[u]], root[name[v]]
                if p != q:
                    root[root == p] = q
                    yield u, v


def across(members: DataFrame, labels: DataFrame, classes: DataFrame, bound: Bound, nearest: bool, apart: int = 64, settle: Settle | None = None) -> DataFrame:
    """Pairs (a < b) of one group whose ends lie in different components and that their sketches and marks (see may_link) don't rule out.

    Groups with the same smallest record, their lead, are compared as one, and a pair that meets under
    several leads is given under the least. Of two such ends one at least is a stray, outside the
    lead's component. A group of more than BLOCK records is dealt out in blocks of strays by blocks
    of records, and small groups go together. nearest: only the closest record of another component for each stray, which leaves
    no pair if and only if there is none. settle: compares the contents of the pairs in the task, so
    that links come out, and only those that join components: fewer than the group has records.
    """
    named = members.join(labels.select(F.col("id").alias("rid"), "component"), "rid", "left").select("sig", "rid", F.coalesce("component", "rid").alias("component"))
    mixed = named.groupBy("sig").agg(F.min("rid").alias("lead"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 != c1")
    rows = storage.written(named.join(mixed.select("sig", "lead"), "sig").select("lead", "rid", "component").distinct(), "mixed")
    size = rows.groupBy("lead").agg(F.count("*").alias("size"), F.max(F.when(F.col("rid") == F.col("lead"), F.col("component"))).alias("main"))
    known = ["rid", "n", "sketch", "mark", *(["content"] if settle else [])]
    leads = rows.groupBy("rid").agg(F.collect_set("lead").alias("leads")).join(_marks(classes).select(known), "rid")
    rows = rows.join(size, "lead").join(leads, "rid").withColumn("stray", F.col("component") != F.col("main"))
    blocks = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("rid"), blocks).cast("long")
    deal = F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)
    one = rows.where(blocks <= 1).withColumns({"i": F.lit(0).cast("long"), "j": F.lit(0).cast("long"), "role": F.when(F.col("stray"), 3).otherwise(2)})
    many = rows.where(blocks > 1)
    left = many.where("stray").withColumns({"i": own, "j": F.explode(deal), "role": F.lit(1)})
    right = many.withColumns({"j": own, "i": F.explode(deal), "role": F.lit(2)})
    group = ["lead", "i", "j"]
    columns = [*group, "role", "stray", "component", "leads", *known]

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rid, component, n, role = (table.column(c).to_numpy() for c in ("rid", "component", "n", "role"))
        stray, lead, leads = table.column("stray").to_numpy(), table.column("lead").to_numpy(), table.column("leads").to_pylist()
        marked, mark = table.column("mark").is_valid().to_numpy(), table.column("mark").fill_null(0).to_numpy()
        parts, begin = _by_width(table.column("sketch").combine_chunks()), _edges(table, group)
        sets: dict[int, set[int]] = {}

        def least(k: int) -> set[int]:
            if k not in sets:
                sets[k] = set(leads[k])
            return sets[k]

        def may_meet() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for u, v in zip(begin, np.append(begin[1:], len(table)), strict=True):
                lefts, rights = u + np.flatnonzero(role[u:v] & 1), u + np.flatnonzero(role[u:v] & 2)
                step = max(1, CELLS // max(1, len(rights)))
                for k in range(0, len(lefts), step):
                    x, y = lefts[k : k + step, None], rights[None]
                    most = bound(n[x], n[y])
                    good = (most >= 0) & (component[x] != component[y])
                    if not nearest:
                        good &= ~stray[y] | (rid[x] < rid[y])  # two strays meet both ways
                    if apart < 64:
                        good &= _apart(mark[x], marked[x], mark[y], marked[y]) <= apart
                    i, j = np.nonzero(good)
                    yield lefts[k + i], rights[j], most[i, j]

        def chunks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for i, j, most in _gathered(may_meet(), CELLS):
                far = _bits_apart(parts, i, j)
                good = far <= most
                i, j, far = i[good], j[good], far[good]
                if not nearest:
                    good = np.fromiter((min(least(u) & least(v)) == lead[u] for u, v in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))
                    i, j, far = i[good], j[good], far[good]
                if len(i):
                    yield i, j, far

        if settle:
            pairs = np.array(list(_joined(component, _gathered(chunks(), PAIRS), table.column("content").to_pylist(), settle)), np.int64).reshape(-1, 2)
            i, j = pairs[:, 0], pairs[:, 1]
        else:
            found = [(begin[:0], begin[:0])]
            for i, j, far in chunks():
                if nearest:
                    order = np.lexsort((rid[j], far, i))
                    order = order[np.concatenate([[True], i[order][1:] != i[order][:-1]])]
                    i, j = i[order], j[order]
                found.append((i, j))
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"a": np.minimum(rid[i], rid[j]), "b": np.maximum(rid[i], rid[j])})

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, group):
            yield from compare(table).to_batches()

    rows = one.select(columns).unionByName(left.select(columns)).unionByName(right.select(columns))
    if settle:  # contents are compared best when those of many groups go together
        return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(together, "a long, b long").distinct()
    return rows.groupBy(*group).applyInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of the ends of edges (a, b); component is the smallest id reachable."""
    return connected_components(edges, "a", "b")


def resolve(met: DataFrame, classes: DataFrame, bound: Bound, verify: Callable[[DataFrame], DataFrame], apart: int = 64, settle: Settle | None = None) -> DataFrame:
    """(id, component) of all records with a link, from meet()'s table.

    classes: rid, n, sketch of every record, and mark (see may_link). bound: most bits in which linked records' sketches
    differ, from both n. verify: pairs (a, b) to those that are links; settle: the same from the contents of both ends, which
    classes then hold (content); the spare of members has to be 0 then. A pair of a large group is left out only if both ends are in one component already, or if
    bound or apart rules it out.
    """
    members = met.where(F.col("kind") == MEMBER).select(F.col("a").alias("sig"), F.col("b").alias("rid"), "n", "spare")
    if not settle:  # with settle no record may spare a signature
        members = storage.written(allocate(members), "members")
    pairs = met.where(F.col("kind") == PAIR).select("a", "b").unionByName(stars(members)).distinct()
    edges = storage.written(verify(storage.written(may_link(pairs, classes, bound, apart), "pairs")), "links")
    labels = components(edges)
    if settle:
        more = storage.written(across(members, labels, classes, bound, False, apart, settle), "links")
        return labels if more.isEmpty() else components(edges.unionByName(more))
    for nearest in (True, False):  # the first round joins most components that belong together
        more = storage.written(across(members, labels, classes, bound, nearest, apart), "pairs")
        if more.isEmpty():
            break
        edges = edges.unionByName(storage.written(verify(more), "links"))
        labels = components(edges)
    return labels
