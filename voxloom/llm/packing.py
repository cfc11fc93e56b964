"""Best-fit packing: plan over the length histogram, then documents take planned slots by rank within length."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage
from . import bpe
from . import textkit as K

MAX_TOKENS = 2048
LARGE = 2 << 20  # bytes that one call encodes
_PIECES = "piece int, start long, length long, ids_crc32 long"


def plan_best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths.

    Rows (length, rank, n, sequence, offset): pieces of that length with ranks rank .. rank + n - 1
    go to sequences sequence, sequence + 1, ... at that offset. Bins of one history are one entry
    with a count, so that time and rows follow the number of lengths, not the number of pieces.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free room: (first sequence, how many)
    rooms, sequence = 0, 0  # rooms: bit r is set if a bin has room r
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            fitting = rooms >> length
            if fitting:
                room = length + (fitting & -fitting).bit_length() - 1
                first, n = bins[room].pop()
                if not bins[room]:
                    rooms &= ~(1 << room)
            else:
                room, first, n = capacity, sequence, -(-left // (capacity // length))
                sequence += n
            each = min(room // length, left)
            used = min(n, left // each)
            for j in range(each):
                plan.append((length, rank, used, first, capacity - room + j * length))
                rank += used
            left -= used * each
            for where, at, many in ((room - each * length, first, used), (room, first + used, n - used)):
                if many and where:
                    bins[where].append((at, many))
                    rooms |= 1 << where
    return plan


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str | None, max_tokens: int, separator: int, keep_ids: bool = False) -> DataFrame:
    """One row per piece of each document's ids plus the separator."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, {_PIECES}" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = bpe.encoder(path or bpe.default_path())
        for batch in batches:
            for rows, texts in K.Texts.of(batch.column(1)).chunks(LARGE):
                ids, first = tool.encode(texts)
                out: list[tuple] = []
                arrays = []
                for i in range(len(texts)):
                    own = np.append(ids[first[i] : first[i + 1]], np.uint32(separator)).astype("<u4")
                    head = len(own) % max_tokens or max_tokens
                    begins = [0, *range(head, len(own), max_tokens)]
                    for k, (a, b) in enumerate(zip(begins, [*begins[1:], len(own)], strict=True)):
                        out.append((rows.start + i, k, a, b - a, zlib.crc32(own[a:b].tobytes())))
                        if keep_ids:
                            arrays.append(own[a:b].astype(np.int32))
                at, piece, start, length, crc = (np.array(x) for x in zip(*out, strict=True))
                columns = [batch.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if keep_ids:
                    columns.append(pa.array(arrays, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, max_tokens: int = MAX_TOKENS, separator: int = 0, keep_ids: bool = False) -> DataFrame:
    """Pack documents into sequences of at most max_tokens tokens.

    A document is its ids and the separator, so an empty or null text takes one token. A document
    longer than a sequence is cut into full pieces from its end; its first piece may be shorter.
    Repeated rows are packed each; a null id is kept. An empty table gives an empty result. Returns
    doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids with keep_ids).

    The driver sees the histogram only (max_tokens rows). Ranks within a length come from two
    levels (counts by bucket and length, then row numbers inside one), so a length that holds a
    third of all pieces is still dealt over all buckets.
    """
    spark = docs.sparkSession
    cut = storage.written(pieces(docs, id_col, text_col, path, max_tokens, separator, keep_ids), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    plan = np.array(plan_best_fit(counts, max_tokens) or np.zeros((0, 5)), np.int64)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    keys = (plan[:, 0] << 44) | plan[:, 1]

    buckets = 4 * storage.scan_partitions(docs)
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = cut.groupBy("bucket", "length").count()
    before = sizes.select("bucket", "length", (F.sum("count").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    ranked = cut.withColumn("within", F.row_number().over(Window.partitionBy("bucket", "length").orderBy("doc_id", "piece")))
    ranked = ranked.join(before, ["bucket", "length"]).withColumn("rank", F.coalesce("before", F.lit(0)) + F.col("within") - 1).drop("bucket", "before", "within")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            row = plan[np.searchsorted(keys, (length << 44) | rank, "right") - 1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])], [*names, "sequence_id", "offset"])

    kinds = {f.name: f.dataType.simpleString() for f in cut.schema}
    return ranked.select(*names, "rank").mapInArrow(place, ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token sequences themselves (from pack(..., keep_ids=True)): sequence_id, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
