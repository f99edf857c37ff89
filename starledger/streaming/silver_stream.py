"""Event stream -> bronze / dead letters / silver / quarantine.

One Structured Streaming query with ``foreachBatch``:

* the source is Kafka (``startingOffsets=earliest``) or, offline, a file
  source of message records; its checkpoint replaces the hand-kept offset
  high-water mark (I1, I2) and the commit log gives at-least-once delivery
  into an idempotent sink (I9);
* each micro-batch is persisted once, split into dead letters and envelopes,
  conformed, flagged by the data-quality rules and de-duplicated;
* the batch id names the offset ranges of the batch, so a replay of the same
  offsets overwrites the same ``silver_batch_id`` partitions, and after a lost
  checkpoint new ranges never land on old batches (I3, I4, X5);
* with ``remember``, ids that an earlier micro-batch passed on are known from
  the state store and go to quarantine (I22);
* ``trigger(availableNow=True)`` processes what is there and stops (I5).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import FACT_TRANSACTIONS, LINEAGE_SCHEMA
from ..operators.conform import conform, with_batch_metadata
from ..operators.incremental import batch_bounds
from ..operators.validate import flag_quality, split_flagged
from ..sources.events import flatten_envelope, read_events, split_dead_letters
from ..sources.batches import publish, write_attempt
from .seen import SEEN, flag_seen, quarantine_seen


@dataclass
class BatchSummary:
    batch_id: str
    messages: int
    dead_letters: int
    silver_rows: int
    quarantine_rows: int

    @property
    def reconciled(self) -> bool:
        """I8: every decodable message landed in silver or quarantine."""
        return self.silver_rows + self.quarantine_rows + self.dead_letters == self.messages


def _utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds").replace("+00:00", "Z")


def offset_batch_id(messages: DataFrame) -> str:
    """The batch id of a message frame, from its offset ranges; without
    any offset, a digest of the messages."""
    lineage = messages.select(F.col("topic").alias("_kafka_topic"), F.col("partition").alias("_kafka_partition"),
                              F.col("offset").alias("_kafka_offset"))
    bounds = batch_bounds(lineage.where(F.col("_kafka_offset").isNotNull())).first()
    if bounds is not None and bounds["lo"] is not None:
        return bounds["batch_id"]
    digest = messages.agg(F.sum(F.xxhash64("key", "value").cast("decimal(38,0)")).alias("d"), F.count(F.lit(1)).alias("n")).first()
    return f"x_{digest['n']}_{str(digest['d'] or 0).replace('-', 'm')}"


def process_batch(batch: DataFrame, batch_id: str | None, roots: dict[str, str]) -> BatchSummary:
    """The per-micro-batch body (also usable on a static frame); without a
    ``batch_id`` the id comes from the offsets."""
    consumed_at = _utc_now()
    batch = batch.persist()
    try:
        batch_id = batch_id or offset_batch_id(batch)
        good, dlq = split_dead_letters(batch, consumed_at)
        good = good.persist()
        written = {"dlq": dlq}
        if "bronze" in roots:
            written["bronze"] = good
        types = {f.name: f.dataType for f in LINEAGE_SCHEMA.fields}
        events = conform(flatten_envelope(good), FACT_TRANSACTIONS, list(types), types)
        events = with_batch_metadata(events, batch_id, consumed_at)
        flagged = flag_quality(events).persist()        # one dedupe per batch, two sinks
        clean, quarantine = split_flagged(flagged)
        if SEEN in batch.columns:
            clean, quarantine = quarantine_seen(clean, quarantine, batch)
        # all sinks are written before any is published, silver last: the loader
        # starts from it, so it never meets a batch whose other sinks are older
        written |= {"quarantine": quarantine, "silver": clean}
        attempt = uuid.uuid4().hex
        done = {sink: write_attempt(df, roots[sink], batch_id, attempt) for sink, df in written.items()}
        for sink, info in done.items():
            publish(batch.sparkSession, roots[sink], info)
        n = batch.count()
        flagged.unpersist()
        good.unpersist()
        return BatchSummary(batch_id, n, done["dlq"]["rows"], done["silver"]["rows"], done["quarantine"]["rows"])
    finally:
        batch.unpersist()


def run_silver_stream(spark: SparkSession, source_path: str | None, roots: dict[str, str], checkpoint: str,
                      fmt: str = "json", options: dict | None = None,
                      remember: dt.timedelta | None = None) -> list[BatchSummary]:
    """Process all available messages, then stop; returns per-batch summaries.
    ``roots`` needs ``silver``, ``quarantine``, ``dlq`` (and optional ``bronze``).
    ``remember``: how long an id is known after it was last seen; unset, copies
    in later batches are left to the upsert."""
    messages = read_events(spark, fmt=fmt, options=options, streaming=True, path=source_path)
    if remember is not None:
        messages = flag_seen(messages, remember)
    summaries: list[BatchSummary] = []

    def body(df: DataFrame, epoch_id: int) -> None:
        summaries.append(process_batch(df, None, roots))

    q = (messages.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return summaries
