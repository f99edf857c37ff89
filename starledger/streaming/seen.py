"""Duplicates across micro-batches from the state store.

Each valid ``transaction_id`` that a stream has passed on is kept as a row of
its state; a message that brings it again in a later micro-batch is marked, and
``process_batch`` sends it to quarantine.  An id is forgotten ``remember`` after
it was last seen, so the state holds the ids of that stretch of time and no
more; later copies collapse at the upsert.  Copies within one micro-batch are
the business of ``flag_quality``.

Only ids of rows that pass the quality rules count: a faulty first copy doesn't
keep a repaired one out.  Messages without such an id hold no state and are
dealt out by a salt.  One id's messages stream through its task in chunks.  With
``remember`` a changed replay (I21) is quarantined as well: leave it unset where
corrections arrive under their old id.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..contracts import FACT_TRANSACTIONS
from ..operators.conform import conform
from ..operators.validate import DUPLICATE_REASON, first_failing, silver_rules
from ..sources.events import classify_value, payload_schema, value_text

SEEN = "seen_id"
SALTS = 1024


def _keyed(messages: DataFrame) -> DataFrame:
    """The messages with _id (of valid rows) and _salt (of the others)."""
    text = value_text(messages)
    flat = messages.select(
        F.struct(*messages.columns).alias("_message"), classify_value(text).alias("_error"),
        F.from_json(text, payload_schema()).alias("_payload"), F.col("offset").cast("long").alias("_kafka_offset"))
    rows = conform(flat.select("_payload.*", "_message", "_error", "_kafka_offset"), FACT_TRANSACTIONS,
                   ["_message", "_error", "_kafka_offset"])
    valid = F.col("_error").isNull() & first_failing(silver_rules()).isNull()
    salt = F.pmod(F.xxhash64("_message.partition", "_message.offset", "_message.value"), F.lit(SALTS)).cast("int")
    return (rows.withColumn("_id", F.when(valid, F.col("transaction_id")))
            .withColumn("_salt", F.when(F.col("_id").isNull(), salt).otherwise(0)).select("_message.*", "_id", "_salt"))


def flag_seen(messages: DataFrame, remember: dt.timedelta) -> DataFrame:
    """The streamed messages and ``seen_id``: the id if an earlier micro-batch
    passed it on, else null."""
    names = messages.columns
    millis = int(remember.total_seconds() * 1000)
    # whole numbers and times travel as text: pandas has no null for them
    plain = {f.name: f.dataType for f in messages.schema.fields if not isinstance(f.dataType, (T.StringType, T.BinaryType))}
    out = T.StructType([T.StructField(f.name, T.StringType() if f.name in plain else f.dataType)
                        for f in messages.schema.fields] + [T.StructField(SEEN, T.StringType())])

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        name, again = key[0], state.exists
        for f in frames:
            yield f[names].assign(**{SEEN: pd.Series([name if again else None] * len(f), index=f.index, dtype=object)})
        if name is not None:
            if not again:
                state.update((True,))
            state.setTimeoutDuration(millis)

    texts = _keyed(messages).withColumns({c: F.col(c).cast("string") for c in plain})
    flagged = texts.groupBy("_id", "_salt").applyInPandasWithState(
        judge, out, "seen boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return flagged.withColumns({c: F.col(c).cast(t) for c, t in plain.items()})


def quarantine_seen(clean: DataFrame, quarantine: DataFrame, batch: DataFrame,
                    reason_col: str = "_dq_reason") -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine) after the rows of ids seen in earlier micro-batches
    have moved over.  Clean rows have an id each."""
    seen = batch.where(F.col(SEEN).isNotNull()).select(F.col(SEEN).alias("transaction_id")).distinct()
    moved = clean.join(seen, "transaction_id", "left_semi").withColumn(reason_col, F.lit(DUPLICATE_REASON))
    return clean.join(seen, "transaction_id", "left_anti"), quarantine.unionByName(moved)
