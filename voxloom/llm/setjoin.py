"""N-gram Jaccard join by universe partition.

A document is the set of its five-word shingles. Sets are grouped in size bands; in a band's layout
the token universe is hashed into m segments, so the sets of a linked pair, which differ in at most
a quarter of the smaller one's tokens, must agree on one segment at least (pigeonhole). The first q
segments also give their one-deletion neighbourhoods, which find segments that differ by one token
and so count twice. m and q are chosen per band by cost. A set skips segments in which it has no
token as far as the count of agreeing segments allows, and its most common signatures as far as
half of what is then spare allows. Candidates are ruled out by parity bitmaps or verified exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from . import linking
from . import textkit as K

WORDS, SIMILARITY = 5, 80  # words in a shingle; least percentage of the union that is shared
BAND = 1.5


class Layouts:
    """Bands of set sizes and the segments of each, for a similarity of percent / 100."""

    def __init__(self, percent: int):
        self.percent = percent
        lo, bounds = self.least(), []
        while lo < 1 << 40:
            bounds.append(lo)
            lo = max(lo + 1, math.ceil(lo * BAND))
        self.lo = np.array(bounds)
        self.hi = np.append(self.lo[1:] - 1, 1 << 40)
        plans = [self._plan(int(h)) for h in self.hi if h < 1 << 30]
        self.m = np.array([p[0] for p in plans])
        self.q = np.array([p[1] for p in plans])

    def apart(self, n):
        """Tokens in which a linked pair differs at most, if its smaller set has n."""
        return (n * 100) // self.percent - n

    def least(self) -> int:
        """The least size of a set that can be linked to a different one."""
        n = 1
        while self.apart(n) < 1:
            n += 1
        return n

    def _plan(self, top: int) -> tuple[int, int]:
        need, usual = self.apart(top) + 1, 0.82 * top
        best = (math.inf, 1, 0)
        for m in sorted({max(1, round(need * f / 20)) for f in range(10, 31)} | {need, need + 1, need + 2}):
            mean = usual / m
            empty = m * math.exp(-mean)
            q = max(0, math.ceil(need + 1.5 * empty + (2 * (2 + 0.03 * m) if m > 20 else 0)) - m)
            if q <= m:
                rare = math.exp(-mean) * (1 + mean)  # segments of at most one token, often met
                best = min(best, (m + q * mean + 3 * m * rare, m, q))
        return best[1:]

    def sign(self, h: np.ndarray, first: np.ndarray, keys: np.ndarray) -> linking.Signed:
        """Signatures of sets (sorted hashes h, bounds first, set keys)."""
        n = np.diff(first)
        sets = np.flatnonzero(n >= self.lo[0])
        own = np.searchsorted(self.lo, n[sets], "right") - 1
        floor = -(-n[sets] * self.percent // 100)
        lower = (own > 0) & (self.hi[np.maximum(own - 1, 0)] >= floor)
        rec_set, rec_band = np.concatenate([sets, sets[lower]]), np.concatenate([own, own[lower] - 1])
        size, m, q = n[rec_set], self.m[rec_band], self.q[rec_band]
        base = np.concatenate([[0], np.cumsum(m)])
        rec = np.repeat(np.arange(len(rec_set)), size)
        token = h[np.arange(len(rec)) - np.repeat(np.cumsum(size) - size, size) + first[rec_set][rec]]
        token = K.mix(token ^ np.uint64(0x5851F42D4C957F2D))
        seg = ((token >> np.uint64(32)) * m[rec].astype(np.uint64)) >> np.uint64(32)
        cell = base[rec] + seg.astype(np.int64)
        total, count = np.zeros(base[-1], np.uint64), np.bincount(cell, minlength=base[-1])
        np.add.at(total, cell, token)
        cell_rec = np.repeat(np.arange(len(rec_set)), m)
        cell_seg = np.arange(base[-1]) - base[:-1][cell_rec]
        place = K.mix((rec_band[cell_rec].astype(np.uint64) << np.uint64(40)) + cell_seg.astype(np.uint64) + np.uint64(1))
        twice = cell_seg < q[cell_rec]
        units = np.where(count == 0, 0, np.where(twice & (count > 1), 2, 1))
        sure = np.add.reduceat(units, base[:-1]) if len(rec_set) else np.zeros(0, np.int64)
        spare = sure - (self.apart(np.minimum(size, self.hi[rec_band])) + 1)
        full = (count > 0) | (spare < 0)[cell_rec]
        sig, owner = [K.mix(total[full] + place[full])], [cell_rec[full]]
        near = twice[cell] & ((count[cell] > 1) | (spare < 0)[rec])
        sig.append(K.mix(total[cell[near]] - token[near] + place[cell[near]]))
        owner.append(rec[near])
        sig, owner = np.concatenate(sig), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        spare = np.minimum(np.maximum(spare, 0) // np.where(q > 0, 4, 2), 65535)
        return sig[order], owner[order], keys[rec_set].view(np.int64), spare


@lru_cache(maxsize=4)
def layouts(percent: int) -> Layouts:
    return Layouts(percent)


def set_keys(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set; equal sets, equal keys."""
    return K.mix(K.sums(K.mix(h), first) + np.diff(first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _sets(batches: Iterator[pa.RecordBatch], words: int):
    for batch in batches:
        for rows, texts in K.Texts.of(batch.column(batch.schema.get_field_index("text"))).chunks():
            h, first = K.shingles(texts, words)
            yield batch, rows, h, first, set_keys(h, first)


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = SIMILARITY) -> DataFrame:
    """Each document with the size of its shingle set and the smallest id that links reach.

    Two documents link when 100 * shared >= percent * union. Documents of equal sets are one record
    (a 64-bit key of the set) throughout and share its component. A null or empty text has the empty
    set and only itself. A row with a null id is returned with a null component_id and takes no part.
    Rows of a repeated id are returned each. Returns doc_id, n_shingles, component_id, set_key, text_key (a hash of the text).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def measure(batches):
        for batch, part, h, first, keys in _sets(batches, words):
            own = [batch.column(c).slice(part.start, part.stop - part.start) for c in ("doc_id", "text_key")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(first), pa.int64()), pa.array(keys.view(np.int64)), pa.array(linking.sketches(h, first), pa.binary())], ["doc_id", "text_key", "n_shingles", "rid", "sketch"])

    def sign(batches):
        seen: set[int] = set()  # sets of this partition: copies are signed once
        for _, _, h, first, keys in _sets(batches, words):
            new = np.zeros(len(keys), bool)
            for i in np.unique(keys, return_index=True)[1]:
                if (k := int(keys[i])) not in seen:
                    seen.add(k)
                    new[i] = True
            n = np.where(new, np.diff(first), 0)
            yield layouts(percent).sign(h[np.repeat(new, np.diff(first))], np.concatenate([[0], np.cumsum(n)]), keys)

    base = storage.written(rows.mapInArrow(measure, f"doc_id {kind}, text_key long, n_shingles long, rid long, sketch binary"), "sets")
    known = rows.where(F.col("doc_id").isNotNull())
    buckets = min(1 << 16, max(16, storage.scan_partitions(docs)))
    met = linking.meet(known, sign, buckets, "met")
    classes = base.where("doc_id is not null and n_shingles > 0").groupBy("rid").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = storage.written(classes, "classes")

    def keep(batches):
        for batch, part, h, first, keys in _sets(batches, words):
            rid = batch.column(batch.schema.get_field_index("rid")).to_numpy()[part].view(np.uint64)
            at = np.flatnonzero(keys == rid)
            yield pa.RecordBatch.from_arrays([pa.array(rid[at].view(np.int64)), pa.array([h[first[i] : first[i + 1]].tobytes() for i in at], pa.binary())], ["rid", "tokens"])

    def compare(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        """Exactly, on the sets of all records in a pair, made from the text of one document of each."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
        source = classes.select("rid", "doc_id").join(wanted, "rid")
        sets = storage.written(known.join(source, "doc_id").select("rid", "text").mapInArrow(keep, "rid long, tokens binary"), "tokens")
        both = pairs.join(sets.select(F.col("rid").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("rid").alias("b"), F.col("tokens").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long").distinct()

    def bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return layouts(percent).apart(np.minimum(x, y))

    labels = linking.resolve(met, classes, bound, verify)
    rooted = base.drop("sketch").join(labels.select(F.col("id").alias("rid"), F.col("component").alias("root")), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    smallest = rooted.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    out = rooted.join(smallest, "root", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("smallest"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("rid").alias("set_key"), "text_key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents, one of each linked group: the one with the smallest id, in the columns of docs.

    Rows with a null id, and texts without a word, stay. Rows that repeat both id and text stay or go
    together; of one id with several texts each is judged by its own links. An empty table gives an
    empty result.
    """
    own_id, key = K.unused(docs.columns, "id", "key")
    gone = link(docs, id_col, text_col).where("doc_id != component_id").select(F.col("doc_id").alias(own_id), F.col("text_key").alias(key)).distinct()
    on = (docs[id_col] == gone[own_id]) & (F.xxhash64(docs[text_col].cast("string")) == gone[key])
    return docs.join(gone, on, "left_anti").select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
