"""Contiguous surrogate keys at scale.

A global ``row_number() over (order by k)`` moves every row into one task.
Instead: range-partition on the key, sort inside each partition, count rows
per partition (a frame with one row per partition), turn the counts into
prefix offsets, broadcast them (size bound: the partition count) and add the
in-partition position.  The result equals ``start + row_number() - 1`` over
the key order, with no single-partition exchange.
"""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _partitions_for(df: DataFrame) -> int:
    # the session's shuffle width is what the cluster sized for its data
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def assign_surrogate(df: DataFrame, order_by: str, out: str = "transaction_sk", start: int | Column = 1,
                     num_partitions: int | None = None) -> DataFrame:
    # An explicit partition count pins the exchange: AQE does not coalesce a
    # repartition-by-number, so partition ids agree between the count branch
    # and the main branch (which reuse the same exchange).
    n = num_partitions or _partitions_for(df)
    ranged = df.repartitionByRange(n, order_by).sortWithinPartitions(order_by)
    tagged = (ranged.withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition index << 33) + position in partition
    tagged = tagged.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    # Pin (_pid, _pos) in a reliable checkpoint (spark.checkpoint.dir): the
    # count branch and the numbering branch must see the very same positions,
    # and a lost executor must not renumber rows on recompute.
    ensure_checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (tagged.join(F.broadcast(offsets), "_pid", "inner")
                  .withColumn(out, (start_col + F.col("_off") + F.col("_pos")).cast("bigint"))
                  .drop("_pid", "_mid", "_pos", "_off"))


def positions(df: DataFrame, order_by: str, num_partitions: int | None = None,
              pid: str = "_sk_pid", pos: str = "_sk_pos") -> DataFrame:
    """Tag rows with (range partition, position in partition) of ``order_by``
    in one pass.  Within one job the tags are deterministic, also when tasks or
    stages are retried: the range bounds are fixed when the exchange is
    planned and each partition is sorted by a unique key.  The partition
    offsets are computed afterwards from what was written (``offsets_of``)."""
    n = num_partitions or _partitions_for(df)
    ranged = df.repartitionByRange(n, order_by).sortWithinPartitions(order_by)
    tagged = ranged.withColumn(pid, F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id())
    return tagged.withColumn(pos, F.col("__mid") - F.shiftleft(F.col(pid).cast("bigint"), 33)).drop("__mid")


def offsets_of(written: DataFrame, pid: str = "_sk_pid") -> tuple[list[int], int]:
    """Prefix offsets per partition id and the row total, from written rows
    (one row per partition id comes back to the driver: bounded by the
    partition count)."""
    counts = {r[pid]: r["n"] for r in written.where(F.col(pid).isNotNull())
              .groupBy(pid).agg(F.count(F.lit(1)).alias("n")).collect()}
    out, acc = [], 0
    for p in range(max(counts) + 1 if counts else 0):
        out.append(acc)
        acc += counts.get(p, 0)
    return out, acc


def positional_key(offsets: list[int], start: int, pid: str = "_sk_pid", pos: str = "_sk_pos") -> Column:
    """start + offset[pid] + pos: the surrogate key of a positionally tagged row.
    The offsets are one binary literal of 8 bytes each, so the expression is as
    small for 50,000 partitions as for 8."""
    packed = F.lit(struct.pack(f">{len(offsets)}q", *offsets))
    offset = F.conv(F.hex(F.substring(packed, F.col(pid) * 8 + 1, F.lit(8))), 16, 10).cast("bigint")
    return (F.lit(start).cast("bigint") + offset + F.col(pos)).cast("bigint")
