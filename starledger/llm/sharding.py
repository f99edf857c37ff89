"""Operator 3: sharding by a consistent-hash ring with bounded loads.

Every shard owns ``vnodes`` points of a 64-bit ring; a key belongs to the arc
that ends at the next point clockwise.  A shard takes no more rows than its
capacity, and keys that find it full continue clockwise to the next point whose
shard has room.  With ``slack`` 0 the capacities add up to the number of rows,
so shard sizes differ by one at most; a larger slack moves fewer rows when a
shard is added.

The work is three narrow passes: counts by arc and stretch (``shards * vnodes *
STRETCHES`` numbers at most, the only thing the driver sees), a plan over the
counts by arc, and one ranking of the rows by stretch.  A stretch is a share of
an arc by the hash of the whole row, so rows that all have one id, or none, are
ranked by many tasks.  Text never leaves the scan.

Cases: a null id hashes like any other value; a null text has size 1 and
checksum 0; the rows of an arc are ordered by stretch, place on the ring, id, size and checksum, so only
identical rows are interchangeable; repeated rows each get a slot; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import few_rows, written

SHARDS = 8
VNODES = 128
#: shares of an arc that are ranked apart
STRETCHES = 32


def ring(shards: int, vnodes: int = VNODES) -> tuple[np.ndarray, np.ndarray]:
    """Sorted signed ring positions and the shard that owns each.  A shard's
    points don't depend on how many shards there are."""
    points = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards) for v in range(vnodes))
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int32)


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [int(np.ceil(rows * (1 + slack) / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def plan(counts: dict[int, int], owner: np.ndarray, capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) pieces.

    Round by round, every arc offers what it still holds to the point it has
    reached; what a full shard can't take moves on clockwise.  Only the counts
    matter, never the order in which rows arrive."""
    points = len(owner)
    free, used = list(capacity), [0] * len(capacity)
    waiting = [[arc, arc, 0, n] for arc, n in sorted(counts.items()) if n]  # arc, point reached, placed, left
    pieces = []
    while waiting:
        for w in waiting:
            shard = int(owner[w[1]])
            if n := min(w[3], free[shard]):
                pieces.append((w[0], w[2], w[2] + n, shard, used[shard]))
                w[2] += n
                w[3] -= n
                free[shard] -= n
                used[shard] += n
            w[1] = (w[1] + 1) % points
        waiting = [w for w in waiting if w[3]]
    return pieces


def shard(docs: DataFrame, shards: int = SHARDS, *, id_col: str = "doc_id", text_col: str = "text",
          vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0), overflowed."""
    spark = docs.sparkSession
    positions, owner = ring(shards, vnodes)

    @F.arrow_udf("int")
    def arc_of(h: pa.Array) -> pa.Array:
        return pa.array((np.searchsorted(positions, h.to_numpy(zero_copy_only=False)) % len(positions)).astype(np.int32))

    at = F.xxhash64(F.col(id_col))
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        at.alias("at"), arc_of(at).alias("arc"))
        .withColumn("stretch", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(STRETCHES)).cast("int")),
        "shard-rows")
    counts: dict[int, int] = {}
    starts = []
    for r in sorted(rows.groupBy("arc", "stretch").agg(F.count(F.lit(1)).alias("n")).collect()):
        starts.append((r["arc"], r["stretch"], counts.get(r["arc"], 0)))
        counts[r["arc"]] = counts.get(r["arc"], 0) + r["n"]
    pieces = plan(counts, owner, capacities(sum(counts.values()), shards, slack))
    placed = few_rows(spark, pieces, "arc int, first_rank long, end_rank long, shard int, first_slot long")
    begun = few_rows(spark, starts, "arc int, stretch int, before long")
    order = Window.partitionBy("arc", "stretch").orderBy("at", "doc_id", "size", "text_crc32")
    owners = few_rows(spark, list(enumerate(owner.tolist())), "arc int, home int")
    # the small sides are bounded: shards * vnodes * STRETCHES rows here, shards * vnodes * shards below
    ranked = (rows.withColumn("nth", F.row_number().over(order)).join(F.broadcast(begun), ["arc", "stretch"])
              .withColumn("rank", F.col("before") + F.col("nth") - 1))
    return (ranked.join(F.broadcast(placed), "arc")
            .where("rank >= first_rank AND rank < end_rank")
            .join(F.broadcast(owners), "arc")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first_slot") + F.col("rank") - F.col("first_rank")).alias("slot"),
                    (F.col("shard") != F.col("home")).alias("overflowed")))
