"""An extension: segment tables that arrive chunk by chunk as a stream, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schema import CHUNK_SEGMENTS


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CHUNK_SEGMENTS).parquet(path)


def append_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends new (chunk_tag, cleft_segid) rows; what a batch delivers again is dropped. Runs until the input at hand is used up."""

    def add(batch: DataFrame, _: int) -> None:
        new = batch.dropDuplicates(["chunk_tag", "cleft_segid"])
        try:
            new = new.join(batch.sparkSession.read.schema(CHUNK_SEGMENTS).parquet(path), ["chunk_tag", "cleft_segid"], "left_anti").select(CHUNK_SEGMENTS.fieldNames())
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        new.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
