"""Sharding by sampled splitters, in DataFrame functions only.

Keys are text hashes, so equal texts lie side by side. A size-weighted sample of keys gives quantile
boundaries of fine ranges; ranges that come out overfull (a hot text, a long run of one key) are
subdivided by a hash of the id; exact running bytes over the fine ranges then place each record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage

SHARDS = 16
RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 64
ROWS_PER_RANGE = 1 << 20


def _draw(weight: Column, rate: float) -> Column:
    """Whether a record is drawn: with odds weight * rate, by a hash of its id and key."""
    u = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id", "key"), 11).cast("double") * F.lit(2.0**-53)
    return u < weight * F.lit(rate)


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of boundaries at or below key, by binary search."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds]) if len(bounds) < 64 else F.from_json(F.lit(str(bounds)), "array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & (F.coalesce(F.try_element_at(table, at + step), F.lit(0)) <= key), at + step).otherwise(at))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal all rows into shards 0 .. shards - 1 of nearly equal bytes.

    A record's size is its text's UTF-8 bytes plus one; a null text counts as empty. Equal texts lie
    in one shard, or in neighbouring ones where a boundary falls among them or they fill a subdivided
    range. Order within a shard is by range, subdivision, text hash, id; slot numbers it from 0
    without gaps. Repeated rows and null ids get slots of their own. An empty table gives an empty
    result. Returns doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The driver sees the boundaries and the totals. Ranges grow in number with bytes, so that one
    task orders a bounded part.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key"))
    base = storage.written(base, "sized")
    rows, total = base.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(shards * RANGES_PER_SHARD, -(-rows // ROWS_PER_RANGE))
    rate = ranges * SAMPLES_PER_RANGE / max(1, total)
    cuts = [k / ranges for k in range(1, ranges)]
    drawn = base.where(_draw(F.col("size"), rate)).agg(F.percentile_approx("key", cuts, 100 * ranges).alias("cuts")).first()["cuts"]
    bounds = sorted(set(drawn or []))

    ranged = base.withColumn("range", range_of(F.col("key"), bounds))
    full = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    parts = F.greatest(F.ceil(F.col("bytes") * F.lit(ranges / max(1, total)) / 2), F.ceil(F.col("n") / ROWS_PER_RANGE), F.lit(1))
    over = full.withColumn("parts", parts.cast("int")).where("parts > 1").select("range", "parts").collect()
    ranged = ranged.withColumn("parts", _lookup("range", [(r["range"], r["parts"]) for r in over], 1))
    ranged = ranged.withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("doc_id"), F.col("parts"))).otherwise(F.lit(0)).cast("int")).drop("parts")

    fine = ranged.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    order = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = fine.select("range", "part", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("rows_before"))
    within = Window.partitionBy("range", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("bytes_in", F.coalesce(F.sum("size").over(within), F.lit(0))).withColumn("rows_in", F.row_number().over(Window.partitionBy("range", "part").orderBy("key", "doc_id", "size")) - 1)
    placed = placed.join(before, ["range", "part"])
    middle = (F.col("bytes_before") + F.col("bytes_in")) * 2 + F.col("size")
    share = F.least(F.floor(middle.cast("double") * F.lit(shards / (2 * max(1, total)))), F.lit(shards - 1)).cast("int")
    placed = storage.written(placed.select("doc_id", "size", "text_crc32", share.alias("shard"), (F.col("rows_before") + F.col("rows_in")).alias("at")), "placed")
    starts = {r["shard"]: r["at"] for r in placed.groupBy("shard").agg(F.min("at").alias("at")).collect()}
    slot = F.col("at") - _lookup("shard", sorted(starts.items()), 0).cast("long")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _lookup(name: str, pairs: list[tuple[int, int]], default: int) -> Column:
    """The value paired with a column's value; at most one pair a range or shard."""
    if not pairs:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for p in pairs for x in p])
    return F.coalesce(F.try_element_at(table, F.col(name)), F.lit(default))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
