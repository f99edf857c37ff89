"""Offset high-water marks for the batch event path.

Marks are one row per (topic, partition): their size is bounded by the
partition count of the topic, so broadcasting them is safe.  The streaming
path uses Structured Streaming's own checkpoint instead (streaming/).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import batch_id_label

MARK_KEYS = ["_kafka_topic", "_kafka_partition"]


def new_rows(df: DataFrame, marks: DataFrame | None) -> DataFrame:
    """Rows beyond the mark of their partition; first run (no marks) takes
    everything; a missing mark counts as -1.  Rows without an offset have no
    mark to be compared with: they always pass, and the quality rules send them
    to quarantine (``missing_kafka_offset``) instead of losing them (X10)."""
    if marks is None:
        return df
    m = F.broadcast(marks.select(*MARK_KEYS, F.col("_kafka_offset").alias("__mark")))  # a row per topic partition
    offset = F.col("_kafka_offset")
    return (df.join(m, MARK_KEYS, "left")
              .where(offset.isNull() | (offset > F.coalesce(F.col("__mark"), F.lit(-1))))
              .drop("__mark"))


def advance_marks(marks: DataFrame | None, processed: DataFrame) -> DataFrame:
    """New mark = max(old mark, max processed offset) per partition."""
    cur = processed.where(F.col("_kafka_offset").isNotNull()).groupBy(*MARK_KEYS).agg(F.max("_kafka_offset").alias("_kafka_offset"))
    if marks is None:
        return cur
    return (marks.select(*MARK_KEYS, "_kafka_offset").unionByName(cur)
                 .groupBy(*MARK_KEYS).agg(F.max("_kafka_offset").alias("_kafka_offset")))


def batch_bounds(df: DataFrame) -> DataFrame:
    """One row with the offset range and the ``b_<lo>_<hi>`` id.  With
    several partitions the id also carries a digest of the per-partition ranges
    so that two different runs cannot produce the same id (X5)."""
    per_part = df.groupBy(*MARK_KEYS).agg(F.min("_kafka_offset").alias("lo"), F.max("_kafka_offset").alias("hi"))
    spec = F.concat_ws(";", F.sort_array(F.collect_list(
        F.concat_ws(":", "_kafka_topic", F.col("_kafka_partition").cast("string"),
                    F.col("lo").cast("string"), F.col("hi").cast("string")))))
    agg = per_part.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("parts"),
                       spec.alias("spec"))
    return agg.select("lo", "hi", F.when(F.col("parts") <= 1, batch_id_label("lo", "hi"))
                      .otherwise(F.concat(batch_id_label("lo", "hi"), F.lit("_"),
                                          F.sha1(F.col("spec")))).alias("batch_id"))


def partition_bounds(df: DataFrame) -> DataFrame:
    """I3/F8 per topic partition: offset range and ``b_<lo>_<hi>`` id of the
    rows each partition contributes (one aggregate row per partition)."""
    per = df.groupBy(*MARK_KEYS).agg(F.min("_kafka_offset").alias("lo"), F.max("_kafka_offset").alias("hi"))
    return per.withColumn("batch_id", batch_id_label("lo", "hi"))


def load_marks(store) -> DataFrame | None:
    """I1/I2 batch variant: the committed marks of a versioned store (None on
    the first run)."""
    if "offset_marks" not in store.manifest()["tables"]:
        return None
    return store.read("offset_marks")


def save_marks(store, marks: DataFrame, expected_version: int | None = None, meta: dict | None = None) -> int:
    """Publish new marks as one atomic store commit.  Call it only after
    the batch's data write succeeded; a crash before it leaves the old marks,
    so the next run re-reads the same rows (and overwrites the same batch)."""
    return store.commit({"offset_marks": marks.select(*MARK_KEYS, "_kafka_offset")}, meta=meta or {},
                        expected_version=expected_version)
